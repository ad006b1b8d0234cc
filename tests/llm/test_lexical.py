import math
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import ALNUM, docs, rows, small
from pyspark.sql import functions as F

from rollkeeper.llm import lexical
from rollkeeper.llm.common import text_blocks
from rollkeeper.llm.decontaminate import words_of
from rollkeeper.llm.lexical import Index, Wanted, op13_lexical, ranked, weight

ITEMS = {"item_id": pa.string(), "text": pa.string()}


def terms(text):
    return ALNUM.findall(small(text))


def brute(texts, items, ids=None, top=20):
    ids = list(range(len(texts))) if ids is None else ids
    counted = [Counter(terms(t)) for t in texts]
    n_docs, n_terms = sum(1 for c in counted if c), sum(sum(c.values()) for c in counted)
    held = Counter(t for c in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for i, c in zip(ids, counted, strict=True):
            norm = 75 + 25 * sum(c.values()) * n_docs // max(1, n_terms)
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * norm))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        scored.sort(key=lambda r: r[:3])
        out += [(item_id, k, r[3], -r[0]) for k, r in enumerate(scored[:top], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows(df)), key=repr)


def place(tmp_path, texts, items, ids=None):
    columns = {"item_id": [i for i, _ in items], "text": [t for _, t in items]}
    return docs(tmp_path, texts, ids, benchmark=(columns, ITEMS))


def corpus(seed, n=150, k=12):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    odds = [1 / (i + 1) for i in range(300)]
    texts = [" ".join(r.choices(words, odds, k=r.choice([1, 8, 60, 200]))) for _ in range(n)]
    return texts, [(f"i{j}", " ".join(r.choices(words, k=r.choice([1, 3, 12, 40])))) for j in range(k)]


@pytest.mark.parametrize("seed", [1, 2])
def test_as_by_brute_force(spark, tmp_path, seed):
    texts, items = corpus(seed)
    assert found(op13_lexical(spark, place(tmp_path, texts, items))) == brute(texts, items)


def test_blocks_of_items_and_texts_change_nothing(spark, tmp_path, monkeypatch):
    texts, items = corpus(3)
    real, asked = text_blocks, []
    monkeypatch.setattr(lexical, "text_blocks", lambda column, limit=900: real(column, limit))
    blocks = lexical.item_blocks
    monkeypatch.setattr(lexical, "item_blocks", lambda *a: asked.append(blocks(*a, 400)) or asked[-1])
    where = place(tmp_path, texts, items)
    df = spark.read.parquet(f"{where}/documents.parquet").repartition(3)
    got = ranked(df, spark.read.parquet(f"{where}/benchmark.parquet"), top=7)
    assert found(got) == brute(texts, items, top=7)
    assert len(asked[0][0]) > 2


def test_sql_agrees(spark, tmp_path):
    texts, items = corpus(4, 80, 8)
    texts += [None, "", "W1 w1 W2!", "naïve café ÄÖ x_y"]
    items += [("z", "NAÏVE café x y naïve"), ("none", "..."), ("null", None)]
    where = place(tmp_path, texts, items)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{where}/{name}.parquet'")
    theirs = sorted(con.execute(lexical.SQL["op13_lexical"]).fetchall(), key=repr)
    assert found(op13_lexical(spark, where)) == theirs == brute(texts, items)


class _Items:
    def __init__(self, texts):
        column = pa.array(texts, pa.large_string())
        (_, _, data, offsets), = text_blocks(column)
        self.words, self.first = words_of(data, offsets)
        self.ids = list(range(len(texts)))
        self.item = np.repeat(np.arange(len(texts)), np.diff(self.first))


def _index(texts, asked):
    items = _Items(asked)
    (_, _, data, offsets), = text_blocks(pa.array(texts, pa.large_string()))
    hashes, first = words_of(data, offsets)
    held = Counter(h for a, b in zip(first[:-1], first[1:], strict=True) for h in set(hashes[a:b].tolist()))
    known = np.array(sorted(set(items.words.tolist()) & set(held)), np.uint64)
    wanted = Wanted(items, known, np.array([weight(held[t], len(texts)) for t in known.tolist()], np.int64))
    return Index(hashes, first, wanted, len(texts), len(hashes)), wanted


def test_bounds_hold_and_pairs_tighten_them(monkeypatch):
    """No document's sum over an item's first terms exceeds the bound, and pairs make bounds smaller than single maxima do."""
    monkeypatch.setattr(lexical, "PAIR_SHARE", 1)
    texts, items = corpus(5, 120, 10)
    index, wanted = _index(texts, [t for _, t in items])
    tighter = 0
    for item in range(len(items)):
        low, high = int(wanted.first[item]), int(wanted.first[item + 1])
        bound, score = index.bounds(low, high), np.zeros(index.size, np.int64)
        for i in range(low, high):
            held, impact = index.posting(wanted.term[i])
            score[held] += wanted.factor[i] * impact
            assert score.max() <= bound[i - low + 1] <= index.most[low : i + 1].sum()
        tighter += bound[-1] < index.most[low:high].sum()
    assert tighter >= 5


def test_search_gives_all_from_the_least_score_on():
    texts, items = corpus(6, 120, 10)
    index, wanted = _index(texts, [t for _, t in items])
    for item in range(len(items)):
        whole, scores = index.search(wanted, item, 1)
        for least in sorted(set(scores.tolist()))[:: max(1, len(scores) // 7)]:
            some, got = index.search(wanted, item, least)
            assert some.tolist() == whole[scores >= least].tolist() and got.tolist() == scores[scores >= least].tolist()


def test_awkward_rows(spark, tmp_path):
    texts = [None, "", "...", "a b", "A, b", "a b", "b " * 5000 + "a", "c", "é É a1 1a", "a b"]
    ids = [1, 2, 3, 4, 4, None, 6, 7, 8, None]
    items = [("x", "a b a"), ("x", "a b a"), (None, "b"), ("y", ""), ("z", None), ("n", "nowhere"), ("é", "É é 1A")]
    where = place(tmp_path, texts, items, ids)
    got = found(op13_lexical(spark, where))
    assert got == brute(texts, items, ids)
    assert [r[2] for r in sorted(got, key=lambda r: r[1]) if r[0] is None] == [6, 4, 4, None, None]


def test_ties_by_doc_id(spark, tmp_path):
    texts, ids = ["a b c"] * 50 + ["d"] * 20, [*range(50, 0, -1), *range(51, 71)]
    got = found(op13_lexical(spark, place(tmp_path, texts, [("i", "a c")], ids)))
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(1, 21))


def test_terms_in_every_document_have_little_weight(spark, tmp_path):
    """A weight of zero gives no score, so such documents aren't found."""
    texts = ["a"] * 1200
    assert weight(1200, 1200) == 0
    assert rows(op13_lexical(spark, place(tmp_path, texts, [("i", "a")]))) == []


def test_empty_tables(spark, tmp_path):
    for k, (texts, items) in enumerate([([], [("i", "a")]), (["a"], []), ([], []), ([None, ""], [("i", "a")]), (["a"], [("i", None)])]):
        (tmp_path / str(k)).mkdir()
        df = op13_lexical(spark, place(tmp_path / str(k), texts, items))
        assert rows(df) == [] and df.columns == ["item_id", "rank", "doc_id", "score"]


def test_clashing_columns(spark, tmp_path):
    texts, items = corpus(8, 60, 5)
    where = place(tmp_path, texts, items)
    tables = []
    for name in ("documents", "benchmark"):
        df = spark.read.parquet(f"{where}/{name}.parquet")
        for c in ("place", "score", "rank", "term", "docs", "terms"):
            df = df.withColumn(c, F.lit("x"))
        df.write.parquet(f"{where}/wide-{name}")
        tables.append(spark.read.parquet(f"{where}/wide-{name}"))
    assert found(ranked(*tables)) == brute(texts, items)
