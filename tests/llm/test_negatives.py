import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import folder, rows
from pyspark.sql import functions as F

from rollkeeper.llm import negatives
from rollkeeper.llm.negatives import Tables, bit_planes, hard_negatives, integers, op11_negatives

VECTORS = {"vec_id": pa.int64(), "embedding": pa.list_(pa.float32()), "label": pa.int32()}


def brute(ids, vectors, labels, k=5, m=5):
    """Row by row, as the docstring says; repeated ids fold for anchors only."""
    usable = []
    for i, v, g in zip(ids, vectors, labels, strict=True):
        if g is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [math.floor(256 * float(np.float32(c))) for c in v]
        usable.append((i, x, (g + 1) % 10 if i is not None and i % 7 == 0 else g))
    anchors = {}
    for i, x, g in usable:
        if i is not None and i % 100 == 0:
            anchors[i] = min(anchors.get(i, (g, x)), (g, x))
    out = []
    for i, (g, x) in anchors.items():
        scored = [(-sum(a * b for a, b in zip(x, y, strict=False)), j is None, j or 0, h, j) for j, y, h in usable if j != i]
        scored.sort(key=lambda r: r[:3])
        near, far = [r for r in scored if r[3] == g][:k], [r for r in scored if r[3] != g]
        for s, _, _, _, j in near:
            band = [r for r in far if -80 * s <= -100 * r[0] <= -100 * s][:m]
            out += [(i, j, n, r[4], -s, -r[0]) for n, r in enumerate(band, 1)]
    return out


def found(df):
    return sorted((tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in rows(df)), key=repr)


def vectors(tmp_path, ids, values, labels):
    return folder(tmp_path, embeddings=({"vec_id": ids, "embedding": values, "label": labels}, VECTORS))


def some(n, width, seed, labels=3):
    r = random.Random(seed)
    centres = [[r.gauss(0, 0.2) for _ in range(width)] for _ in range(labels)]
    ids = list(range(n))
    marks = [r.randrange(labels) for _ in ids]
    return ids, [[c + r.gauss(0, 0.1) for c in centres[r.randrange(labels)]] for _ in ids], marks


@pytest.mark.parametrize("width", [1, 8, 13, 64])
def test_scores_are_inner_products(width):
    r = np.random.default_rng(width)
    for size in (3, 300, 1 << 40 if width < 13 else 1 << 20):
        a, c = r.integers(-size, size, (7, width)), r.integers(-size, size, (11, width))
        if size >= 1 << 40:
            a = a % 5 - 2
        planes = bit_planes(c)
        assert (Tables(a, len(planes)).scores(planes) == c @ a.T).all()


def test_scores_beyond_64_bits_are_an_error():
    with pytest.raises(ValueError, match="64 bits"):
        Tables(np.full((1, 8), 1 << 40), 40)


def test_integers_are_floors_of_doubles():
    whole, x = integers(pa.array([[0.1, -0.1], None, [1.0], [None, 1.0], [float("nan")], [float("inf")], []], pa.list_(pa.float32())))
    assert whole.tolist() == [True, False, True, False, False, False, True]
    assert x.tolist() == [[25, -26], [256, 0], [0, 0]]


def test_as_by_brute_force(spark, tmp_path):
    ids, values, labels = some(450, 16, 1)
    got = found(op11_negatives(spark, vectors(tmp_path, ids, values, labels)))
    assert got == sorted(brute(ids, values, labels), key=repr) and len(got) > 20


def test_small_blocks_and_tables_change_nothing(spark, tmp_path, monkeypatch):
    ids, values, labels = some(450, 16, 2)
    place = vectors(tmp_path, ids, values, labels)
    monkeypatch.setattr(negatives, "TABLE_BYTES", 1)
    monkeypatch.setattr(negatives, "_SCORES", 64)
    df = spark.read.parquet(f"{place}/embeddings.parquet").repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives(df, F.col("vec_id") % 100 == 0, label=label, block_bytes=300)
    assert found(got) == sorted(brute(ids, values, labels), key=repr)


def test_sql_agrees(spark, tmp_path):
    ids, values, labels = some(350, 12, 3)
    values[5] = None
    values[17][3] = None
    labels[9] = None
    values[30][0] = float("nan")
    place = vectors(tmp_path, ids, values, labels)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{place}/embeddings.parquet'")
    theirs = con.execute(negatives.SQL["op11_negatives"])
    assert found(op11_negatives(spark, place)) == sorted(theirs.fetchall(), key=repr) == sorted(brute(ids, values, labels), key=repr)


def test_awkward_rows(spark, tmp_path):
    ids, values, labels = some(320, 9, 4)
    for k in range(40, 90):  # one vector, many rows: ties by id
        values[k] = values[100]
    ids[120] = ids[121] = None
    ids[130] = ids[131] = 129
    values[140] = values[140][:4]  # as if zeros followed
    values[141] = []
    values[142] = [float("inf")] * 9
    values[143] = None
    values[144] = [None] * 9
    labels[145] = None
    ids[146], values[146] = 200, values[3]  # a second row with an anchor's id
    place = vectors(tmp_path, ids, values, labels)
    got = found(op11_negatives(spark, place))
    assert got == sorted(brute(ids, values, labels), key=repr) and got


def test_empty_table_and_no_anchor(spark, tmp_path):
    assert rows(op11_negatives(spark, vectors(tmp_path, [], [], []))) == []
    (tmp_path / "b").mkdir()
    ids, values, labels = some(30, 4, 5)
    assert rows(op11_negatives(spark, vectors(tmp_path / "b", [i + 1 for i in ids], values, labels))) == []


def test_only_empty_vectors(spark, tmp_path):
    got = found(op11_negatives(spark, vectors(tmp_path, [0, 1, 2, 3], [[], [], [], []], [1, 1, 2, 2])))
    # 0 is divisible by 7, so its label is 2; all scores are 0
    assert got == [(0, 2, 1, 1, 0, 0), (0, 3, 1, 1, 0, 0)]


def test_clashing_columns(spark, tmp_path):
    ids, values, labels = some(220, 8, 6)
    df = spark.read.parquet(vectors(tmp_path, ids, values, labels) + "/embeddings.parquet")
    df = df.withColumn("id", F.lit("x")).withColumn("x", F.lit(1)).withColumn("rank", F.lit(None)).withColumn("score", F.lit(2)).withColumn("_row", F.lit(0))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    assert found(hard_negatives(df, F.col("vec_id") % 100 == 0, label=label)) == sorted(brute(ids, values, labels), key=repr)
