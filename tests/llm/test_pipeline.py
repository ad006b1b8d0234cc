import random

import pytest
import test_decontaminate as one
import test_perplexity as two
import test_runlength as seven
import test_simhash as four
from helpers import docs, rows
from tokenizers import Tokenizer

import corpus_pipeline as p
from rollkeeper.llm import perplexity
from rollkeeper.llm.packing import public_path
from rollkeeper.session import written


def corpus(tmp_path):
    r = random.Random(5)
    vocabulary = ["".join(r.choices("abcdeé", k=r.randrange(2, 8))) for _ in range(300)]
    said = lambda n: " ".join(r.choices(vocabulary, k=n))
    items = [(i, said(r.choice([8, 20, 40]))) for i in range(6)]
    shared = [said(60) for _ in range(3)]
    texts = [None, "", "few words only", "again " * 50, "#" * 300]
    for _ in range(70):
        text = said(r.choice([15, 80, 300]))
        if r.random() < 0.3:
            text += " " + r.choice(shared)
        if r.random() < 0.3:
            text = r.choice(items)[1] + " " + text
        texts.append(text)
    texts += [texts[7]] * 5 + [texts[8] + " more"]
    bench = ({"item_id": [i for i, _ in items], "text": [t for _, t in items]}, one.ITEM)
    return docs(tmp_path, texts, benchmark=bench), items


def test_every_stage_on_its_own_input(spark, tmp_path):
    folder, items = corpus(tmp_path)
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns = frame.columns
    by_name = dict(p.STAGES)
    assert [name for name, _ in p.STAGES][1:] == ["simhash near-dedup", "suffix-array dedup", "benchmark decontamination", "best-fit packing"]
    before = frame
    for name in list(by_name)[:-1]:
        after = written(by_name[name](spark, before, folder))
        assert after.columns == columns and after.schema == before.schema
        old, new = ({x["doc_id"]: x["text"] for x in rows(f)} for f in (before, after))
        if name == "quality rules":
            kept = {x["doc_id"] for x in rows(perplexity.judged(before, ["doc_id"], "q")) if x["q"]["kept"]}
            assert new.keys() == kept and kept <= {i for i, t in old.items() if not two.base(t)[5]}
        elif name == "simhash near-dedup":
            fps = {i: four.fingerprint(t) for i, t in old.items()}
            root = four.classes(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 4)
            least = {}
            for i, f in fps.items():
                least[root(f)] = min(i, least.get(root(f), i))
            assert sorted(new) == sorted(least.values()) and len(new) < len(old)
        elif name == "suffix-array dedup":
            left = dict(zip(old, seven.brute(list(old.values())), strict=True))
            assert new.keys() == old.keys() and any(x[1] for x in left.values())
            for i, (size, gone, _, _) in left.items():
                assert 0 <= size - gone - len(new[i].encode()) <= 6  # pieces of a character go too
                assert gone or new[i] == old[i]
            assert all(x["n_chars"] == len(x["text"]) for x in rows(after))
        else:
            bad = {i for (i, _), x in zip(old.items(), one.brute(old.values(), items), strict=True) if x[-1]}
            assert bad and new.keys() == old.keys() - bad
        before = after
    packed = rows(by_name["best-fit packing"](spark, before, folder))
    plain = Tokenizer.from_file(public_path())
    lengths = {x["doc_id"]: len(plain.encode(x["text"], add_special_tokens=False).ids) + 1 for x in rows(before)}
    got = {}
    for x in packed:
        got[x["doc_id"]] = got.get(x["doc_id"], 0) + x["length"]
    assert got == lengths


@pytest.mark.parametrize("empty", [False, True])
def test_run(spark, tmp_path, empty):
    if empty:
        folder = docs(tmp_path, [], benchmark=({"item_id": [], "text": []}, one.ITEM))
        assert p.run(spark, folder).collect() == []
    else:
        folder, _ = corpus(tmp_path)
        out = rows(p.run(spark, folder))
        assert out and max(x["offset"] + x["length"] for x in out) <= 4096
