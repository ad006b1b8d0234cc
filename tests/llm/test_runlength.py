import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import docs, rows
from pyspark.sql import functions as F

from rollkeeper.llm import decontaminate as d
from rollkeeper.llm import runlength as x
from rollkeeper.llm.suffixes import suffix_array


def brute(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    n = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if n[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def case(seed):
    r = random.Random(seed)
    said = lambda n, a="abcd é": "".join(r.choice(a) for _ in range(n))
    shared = [said(n) for n in (199, 200, 201, 260, 700)]
    texts = [None, "", "x", "a" * 199, "b" * 200, "c" * 201, "c" * 5000 + "d", "ab" * 400, said(150) + "ab" * 130, "z" + "c" * 199 + "y"]
    for _ in range(25):
        parts = []
        for _ in range(r.choice([1, 2, 4])):
            one = r.choice(shared)
            cut = r.choice([0, 0, 1, 30])
            parts += [said(r.choice([0, 1, 90, 400])), one[cut : len(one) - r.choice([0, 0, 1, 30])]]
        texts.append("".join(parts) + said(r.choice([0, 3, 300])))
    texts += [texts[12]] * 3 + [texts[13] + "!"] + ["short copy"] * 2
    edited = list(texts[14])
    for k in range(100, len(edited), 300):
        edited[k] = "#"
    texts += ["".join(edited), "\0" * 300 + "\1", "\0" * 250]
    if seed > 1:  # repeats of a text within itself, which no other text holds
        texts += ["Of Of " * 100 + said(300), "q" * 240, said(99, "xyz") * 5, (said(130, "xyz") + said(40)) * 2 + said(90)]
        one = said(230, "uvw")
        texts.append(said(300) + one + said(50) + one + said(400))
    return texts


def test_a_text_that_only_repeats_itself(spark, tmp_path):
    r = random.Random(9)
    said = lambda n: "".join(r.choices("abcdefgh", k=n))
    one = said(210)
    texts = ["ab" * 150 + said(50), "k" * 201, "l" * 200, one + said(20) + one, said(120) * 3, said(900)]
    got = sorted(tuple(x)[1:] for x in x.op7_repeats(spark, docs(tmp_path, texts)).collect())
    assert got == sorted(brute(texts)) and sum(g[1] > 0 for g in got) == 4


@pytest.mark.parametrize(("seed", "most"), [(1, 4096), (2, 4096), (3, 2)])
def test_against_brute_force(spark, tmp_path, monkeypatch, seed, most):
    if most != 4096:
        whole = x.marks
        monkeypatch.setattr(x, "marks", lambda *a, **k: whole(*a, **k, most=most))
        monkeypatch.setattr(x, "INDEX_BYTES", 2000)
    texts = case(seed)
    path = docs(tmp_path, texts, ids=[7] * len(texts) if seed == 1 else None)
    got = [tuple(r)[1:] for r in x.op7_repeats(spark, path).collect()]
    assert sorted(got) == sorted(brute(texts))


def test_stage_keeps_columns_and_cuts_text(spark, tmp_path):
    same = "ab é " * 60
    texts = [None, "", "left " + same + "right", same + "é", "clean text"]
    frame = spark.read.parquet(docs(tmp_path, texts) + "/documents.parquet").withColumn("_body", F.lit(1)).withColumn("spans", F.lit(2))
    out = x.without_repeats(frame)
    assert out.columns == frame.columns
    got = {r["doc_id"]: r["text"] for r in rows(out)}
    assert got[0] is None and got[1] == "" and got[4] == "clean text"
    assert got[2] == "leftright" and got[3] == "é"
    assert rows(x.op7_repeats(spark, docs(tmp_path, []))) == []


@pytest.mark.parametrize("seed", range(3))
def test_index(seed):
    r = random.Random(seed)
    contents = [bytes(r.choices(b"ab\0\xff", k=r.randrange(1, 60))) for _ in range(30)]
    contents += [contents[0] + b"x", b"aaaa" * 20, b"aaaa" * 25, b"y" + contents[1]]
    index = x.RunLengthIndex(contents)
    assert len(index.sizes) < len(index.stop) == index.sizes.sum()
    ms = index.matching_statistics()
    whole = b"".join(contents)
    places = [(k, i) for k, c in enumerate(contents) for i in range(len(c))]
    want = {}
    for k, i in places:
        best = 0
        for m, j in places:
            if (m, j) != (k, i):
                a, b, n = contents[k][i:], contents[m][j:], 0
                while n < min(len(a), len(b)) and a[n] == b[n]:
                    n += 1
                best = max(best, n)
        want[k, i] = best
    assert len(whole) == len(want)
    assert {(k, i): int(ms[index.first[k] + i]) for k, i in places} == want


def test_suffix_array_is_sorted():
    r = np.random.default_rng(1)
    sizes = np.array([0, 1, 50, 50, 7])
    texts = [r.integers(1, 3, n) for n in sizes]
    texts[3] = texts[2]
    rank = np.concatenate([np.append(t, 0) for t in texts])
    stops = np.cumsum(sizes + 1) - 1
    stop = np.repeat(stops, sizes + 1)
    order = suffix_array(rank, stop, 64, settle=True)
    key = [(tuple(rank[p : stop[p]]), p) for p in order]
    assert sorted(key) == key and len(set(order.tolist())) == len(rank)
    assert d.suffix_array is suffix_array


def test_least_in_windows_and_cut():
    r = np.random.default_rng(2)
    values = r.integers(0, 50, 300).astype(np.uint64)
    for span in (1, 2, 5, 64, 169):
        assert x.least_in_windows(values, span).tolist() == [values[i : i + span].min() for i in range(300 - span + 1)]
    data = r.integers(0, 3, 2000).astype(np.uint8)
    offsets = np.array([0, 0, 30, 500, 700, 899, 2000, 2000])
    row, at, wins, _, _ = x.cut(data, offsets, 200, 32)
    covered = sorted((int(k), int(i)) for k, a, w in zip(row, at, wins, strict=True) for i in range(a, a + w))
    assert covered == [(k, i) for k in range(7) for i in range(offsets[k], offsets[k + 1] - 199)]


def test_few_but_long_contents_are_counted_in_slices(spark, tmp_path, monkeypatch):
    r = random.Random(4)
    said = lambda n: "".join(r.choices("abcdefgh", k=n))
    texts = [said(300) + "xy" * n + said(300) for n in (900, 1500, 2000)] + ["z" * 3000 + said(50), said(400)]
    whole, indexed, sizes = x.marks, x.indexed_marks, []

    def seen(rows, length):
        sizes.extend(r[1] for r in rows.groupBy("value").agg(F.sum(F.octet_length("body"))).collect())
        return indexed(rows, length)

    monkeypatch.setattr(x, "marks", lambda *a, **k: whole(*a, **k, most_bytes=1000))
    monkeypatch.setattr(x, "indexed_marks", seen)
    monkeypatch.setattr(x, "SLICE_BITS", 6)
    got = sorted(tuple(r)[1:] for r in x.op7_repeats(spark, docs(tmp_path, texts)).collect())
    assert got == sorted(brute(texts)) and sum(g[1] > 0 for g in got) == 4
    assert max(sizes, default=0) <= 1000


def test_slices():
    assert list(x.slices(np.array([5, 5, 50, 1, 1, 1]), rows=2, limit=10)) == [(0, 2), (2, 3), (3, 5), (5, 6)]
    parts = list(x.window_slices(1, 2, 3, bytes(range(100)), 20, bits=5))
    assert [p.num_rows for p in parts] == [32, 32, 17]
    assert [i for p in parts for i in p.column("at").to_pylist()] == list(range(81))
