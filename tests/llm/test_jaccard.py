import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import GRAPH, docs, rows, small
from pyspark.sql import functions as F

from rollkeeper.llm import jaccard
from rollkeeper.llm.common import documents
from rollkeeper.llm.jaccard import jaccard_components, may_link, missing, op12_jaccard, shingle_sets


def shingles(text, k=4):
    words = GRAPH.findall(small(text))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(texts, ids=None, least=85, k=4):
    ids = list(range(len(texts))) if ids is None else ids
    sets = [shingles(t, k) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= least * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    out = []
    for i, a in enumerate(sets):
        own = [ids[j] for j in range(len(sets)) if find(j) == find(i) and ids[j] is not None]
        out.append((ids[i], len(a), min(own, default=None)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(df)), key=repr)


def corpus(seed, n=220):
    """Texts with near copies of many degrees, shared passages and short ones."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["Ä", "é", "the", "The"]
    passage = [r.choice(words) for _ in range(30)]
    bases = [[r.choice(words) for _ in range(r.choice([5, 12, 40, 120]))] for _ in range(12)]
    out = []
    for _ in range(n):
        kind = r.random()
        text = list(r.choice(bases))
        if kind < 0.6:
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                text[r.randrange(len(text))] = r.choice(words)
        elif kind < 0.8:
            at = r.randrange(len(text))
            text = text[:at] + passage + [r.choice(words) for _ in range(r.randrange(30))]
        else:
            text = [r.choice(words) for _ in range(r.randrange(9))]
        out.append(r.choice([" ", "\n", "\t "]).join(text))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_as_by_brute_force(spark, tmp_path, seed):
    texts = corpus(seed)
    assert found(op12_jaccard(spark, docs(tmp_path, texts))) == brute(texts)


def test_sql_agrees(spark, tmp_path):
    texts = corpus(11, 120) + [None, "", "one", "ONE", "a\x1cb c d", "\u00a0x y\x0bz w"]
    path = docs(tmp_path, texts)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    assert sorted(con.execute(jaccard.SQL["op12_jaccard"]).fetchall(), key=repr) == found(op12_jaccard(spark, path)) == brute(texts)


@pytest.mark.parametrize(("least", "k", "counted", "rounds"), [(50, 2, 0, 1), (80, 5, 8, 3), (100, 3, 3, 1)])
def test_other_parameters(spark, tmp_path, monkeypatch, least, k, counted, rounds):
    """Also with no shingle sampled, and with all of them."""
    monkeypatch.setattr(jaccard, "SAMPLED", counted)
    texts = corpus(7, 120)
    table = documents(spark, docs(tmp_path, texts))
    got = jaccard_components(table, ["doc_id"], least, k).groupBy("root", "n").agg(F.collect_list("doc_id").alias("ids"))
    groups = {}
    for r in rows(got):
        groups.setdefault(r["root"] if r["n"] else ("none", r["ids"][0]), []).extend(r["ids"])
    wanted = {}
    for i, n, c in brute(texts, least=least, k=k):
        wanted.setdefault(c if n else ("none", i), []).append(i)
    empty = {i for i, n, _ in brute(texts, least=least, k=k) if not n}
    assert sorted(sorted(x) for x in groups.values() if not set(x) & empty) == sorted(sorted(x) for x in wanted.values() if not set(x) & empty)


def test_the_limit_is_exact(spark, tmp_path):
    """17 of 20 shingles are linked, 16 of 19 aren't; one side or both may lack some."""
    words = [f"a{k}" for k in range(40)]
    texts = [" ".join(words[:23]), " ".join(words[:20]), " ".join(["x", *words[:20], "y", "z"])]
    other = [f"b{k}" for k in range(40)]
    texts += [" ".join(other[:22]), " ".join(other[:19])]
    got = found(op12_jaccard(spark, docs(tmp_path, texts)))
    assert got == brute(texts)
    assert [c for _, _, c in got] == [0, 0, 0, 3, 4]


def test_filters_keep_every_linked_pair(spark):
    """For random sets in a common order, the first shared element passes the filters whenever the pair is linked."""
    r = random.Random(3)
    made, linked = [], []
    for _ in range(600):
        base = r.sample(range(1 << 20), r.choice([1, 2, 7, 20, 90]))
        a = sorted(base)
        b = sorted(set(r.sample(base, r.randint(max(1, len(base) * 7 // 10), len(base))) + r.sample(range(1 << 20), r.choice([0, 0, 1, 3]))))
        both = set(a) & set(b)
        row = {}
        for name, x in (("1", a), ("2", b)):
            at = x.index(min(both))
            behind = jaccard.suffixes(np.array(x, np.uint64), at + 1)[at].tolist()
            row |= {f"n{name}": len(x), f"pos{name}": at}
            row |= {f"{c}{name}": v for c, v in zip(jaccard._SIZES + jaccard._PARITIES, behind, strict=True)}
            assert at <= missing(len(x)) or 100 * len(both) < 85 * len(set(a) | set(b))
        made.append(row)
        linked.append(100 * len(both) >= 85 * len(set(a) | set(b)))
    df = spark.createDataFrame([(k, *row.values()) for k, row in enumerate(made)], ["k", *made[0]])
    passed = {x["k"] for x in rows(df.filter(may_link("1", "2", 85)))}
    assert {k for k, x in enumerate(linked) if x} <= passed
    assert 0 < sum(linked) <= len(passed) < 600


def test_a_large_group_makes_few_pairs(spark, tmp_path):
    """Near copies of one text are held against one another by rounds, not by all pairs."""
    r = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for k in range(400):
        words = list(base)
        words[r.randrange(150)] = f"own{k}"
        texts.append(" ".join(words))
    seen = []
    real = jaccard.verified

    def counted(pairs, whole, least):
        seen.append(pairs.count())
        return real(pairs, whole, least)

    jaccard.verified = counted
    try:
        got = found(op12_jaccard(spark, docs(tmp_path, texts)))
    finally:
        jaccard.verified = real
    assert {c for _, _, c in got} == {0}
    assert sum(seen) < 400 * 40  # all pairs are 79,800


def test_a_large_group_in_parts_makes_few_pairs(spark, tmp_path):
    """Copies are linked if they were changed at the same place, and there are few places; some have own words at the end."""
    r = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(240):
        words = list(base)
        words[[10, 25, 40][k % 3]] = f"own{k}"
        texts.append(" ".join(words + [f"more{k}-{i}" for i in range(r.choice([0, 0, 0, 1, 2, 5]))]))
    seen = []
    real = jaccard.verified

    def counted(pairs, whole, least):
        seen.append(pairs.count())
        return real(pairs, whole, least)

    jaccard.verified = counted
    try:
        got = found(op12_jaccard(spark, docs(tmp_path, texts)))
    finally:
        jaccard.verified = real
    assert got == brute(texts)
    assert sum(seen) < 240  # linked pairs are thousands
    assert len({c for _, _, c in got}) >= 3


def test_awkward_rows(spark, tmp_path):
    texts = [None, "", " \n\t", "one", "ONE", "one two three", "one two three four", "One  two\nthree four", None, "same words here again", "same words here again", "\x1c a b c", "a b c d e"]
    ids = [5, 6, 7, None, 9, 10, 11, 12, None, 13, 13, 14, 15]
    got = found(op12_jaccard(spark, docs(tmp_path, texts, ids)))
    assert got == brute(texts, ids)
    assert (5, 0, 5) in got and (None, 0, None) in got and (None, 1, 9) in got and (12, 1, 11) in got and got.count((13, 1, 13)) == 2


def test_very_long_texts(spark, tmp_path):
    r = random.Random(9)
    long = [f"w{r.randrange(5000)}" for _ in range(120_000)]
    other = list(long)
    for k in range(0, 120_000, 400):
        other[k] = "changed"
    third = [f"w{r.randrange(5000)}" for _ in range(120_000)]
    texts = [" ".join(third), " ".join(long), " ".join(other), "short"]
    assert [c for _, _, c in found(op12_jaccard(spark, docs(tmp_path, texts)))] == [0, 1, 1, 3]


def test_empty_table(spark, tmp_path):
    assert rows(op12_jaccard(spark, docs(tmp_path, []))) == []


def test_clashing_columns(spark, tmp_path):
    texts = corpus(4, 60)
    df = documents(spark, docs(tmp_path, texts))
    for name in ("_place", "sid", "tokens", "n", "m", "root", "a", "b", "_body", "token"):
        df = df.withColumn(name, F.lit(name))
    df.write.parquet(str(tmp_path / "wide"))
    got = jaccard_components(spark.read.parquet(str(tmp_path / "wide")), ["doc_id"])
    ids = got.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("c"), F.collect_list("doc_id").alias("ids"))
    assert sorted((i, r["c"]) for r in rows(ids) for i in r["ids"]) == [(i, c) for i, n, c in sorted(brute(texts)) if n]


def test_sets_do_not_depend_on_blocks():
    texts = pa.array(corpus(6, 40), pa.large_string())
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    hashes, counts = shingle_sets(data, offsets)
    edges = np.concatenate([[0], np.cumsum(counts)])
    for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        own, n = shingle_sets(data[a:b], np.array([0, b - a]))
        assert (own == hashes[edges[k] : edges[k + 1]]).all() and n[0] == counts[k] == len(shingles(texts[k].as_py()))
