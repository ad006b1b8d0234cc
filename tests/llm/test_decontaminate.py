import hashlib
import random

import pyarrow as pa
import pytest
from helpers import ALNUM, docs, rows, small
from pyspark.sql import functions as F

from rollkeeper.llm import decontaminate as d

ITEM = {"item_id": pa.int64(), "text": pa.string()}


def brute(texts, items):
    out = []
    for text in texts:
        words = ALNUM.findall(small(text))
        hit, ids = set(), set()
        for item_id, item in items:
            own = ALNUM.findall(small(item))
            size = min(len(own), 13)
            windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
            for i in range(len(words) - size + 1) if own else ():
                if tuple(words[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    ids.add(item_id)
        ids = sorted(str(i) for i in ids if i is not None)
        sha = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((len(words), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(words)))
    return out


def case(seed):
    r = random.Random(seed)
    vocabulary = ["a", "b", "Ä", "É1", "cc", "d9"]
    said = lambda n: "".join(r.choice(vocabulary) + r.choice([" ", ", ", "\n", "- "]) for _ in range(n))
    items = [(i, said(r.choice([2, 5, 13, 14, 40, 60]))) for i in range(8)]
    items += [(8, items[4][1]), (9, ""), (10, None), (11, "?!"), (None, said(20)), (7, said(15)), (12, "zz")]
    texts = [None, "", "...", "a", said(3000)]
    for _ in range(25):
        parts = [said(r.choice([0, 3, 30, 200]))]
        for _ in range(r.choice([0, 1, 3])):
            item = r.choice(items)[1] or ""
            cut = r.randrange(0, max(1, len(item) // 3))
            parts += [item[cut:].upper() if r.random() < 0.5 else item[cut:], said(r.choice([0, 2]))]
        texts.append("".join(parts))
    return texts + [texts[7]] * 3, items


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, tmp_path, seed):
    texts, items = case(seed)
    bench = ({"item_id": [i for i, _ in items], "text": [t for _, t in items]}, ITEM)
    path = docs(tmp_path, texts, benchmark=bench)
    got = d.op1_decontamination(spark, path).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(texts, items)


def test_blocks_of_items_add_up_and_places_are_right(spark, tmp_path):
    texts, items = case(5)
    path = docs(tmp_path, texts)
    frame = spark.read.parquet(f"{path}/documents.parquet").withColumn("n_hit", F.lit(7))
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = rows(d.scan(frame, bench, "_found").orderBy("doc_id"))
    many = rows(d.scan(frame, bench, "_found", item_block_bytes=50).orderBy("doc_id"))
    key = lambda m: (m["item_id"] or "", m["item_word"], m["doc_word"], m["words"])
    said = {}
    for i, t in items:
        said.setdefault(str(i), []).append(ALNUM.findall(small(t)))
    for a, b in zip(one, many, strict=True):
        assert (a["_found"]["n_words"], a["_found"]["n_hit"]) == (b["_found"]["n_words"], b["_found"]["n_hit"])
        assert sorted(map(key, a["_found"]["matches"])) == sorted(map(key, b["_found"]["matches"]))
        words = ALNUM.findall(small(a["text"]))
        for m in a["_found"]["matches"]:
            if m["item_id"] is None:
                continue
            there = words[m["doc_word"] : m["doc_word"] + m["words"]]
            assert any(there == own[m["item_word"] : m["item_word"] + m["words"]] for own in said[m["item_id"]])


def test_empty_tables_and_kept_columns(spark, tmp_path):
    path = docs(tmp_path, [], benchmark=({"item_id": [], "text": []}, ITEM))
    assert d.op1_decontamination(spark, path).collect() == []
    frame = spark.createDataFrame([(1, "x y", 5), (2, None, None)], "doc_id long, text string, _found int")
    out = d.decontaminate(frame, spark.createDataFrame([], "item_id long, text string"))
    assert out.columns == frame.columns and sorted(out.collect()) == sorted(frame.collect())


def test_items_stay_out_of_the_driver_and_blocks_are_bounded(spark, tmp_path, monkeypatch):
    texts, items = case(6)
    path = docs(tmp_path, texts)
    frame = spark.read.parquet(f"{path}/documents.parquet")
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    monkeypatch.setattr(type(bench), "toLocalIterator", None)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", None)
    limit = 200
    blocks, deep = d.item_blocks(bench, "item_id", "text", limit)
    held = [d.Items(b, 13) for b in blocks]
    assert len(held) > 1 and sum(len(h.ids) for h in held) == len(items)
    size = {None if i is None else str(i): [] for i, _ in items}
    for i, t in items:
        size[None if i is None else str(i)].append(len((t or "").encode()) + 16)
    assert all(len(h.ids) == 1 or sum(min(size[i]) for i in h.ids) <= limit for h in held)
    assert deep == max(len(ALNUM.findall(small(t))) for _, t in items)
    found = d.scan(frame, bench, "_found", item_block_bytes=limit).orderBy("doc_id").collect()
    assert [(r["_found"]["n_words"], r["_found"]["n_hit"]) for r in found] == [x[:2] for x in brute(texts, items)]
