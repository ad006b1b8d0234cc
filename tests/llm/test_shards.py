import zlib
from collections import Counter

import xxhash
from helpers import docs
from pyspark.sql import functions as F

from rollkeeper.llm.shards import op5_sharding, place, rendezvous


def test_digest_slots_and_growth(spark, tmp_path):
    texts = [None, "", "é", "x" * 100_000, *(f"t {i % 7}" for i in range(3000))]
    ids = [None, 1, 1, 1, *range(2, 2998), 2997, 2997, None, 5]
    path = docs(tmp_path, texts, ids)
    got = op5_sharding(spark, path).collect()
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted(
        (i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts, strict=True)
    )
    by = {}
    for r in got:
        assert r.law == "key" and r.grown_shard in (r.shard, 8)
        assert by.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
    for shard, n in Counter(r.shard for r in got).items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
        assert 0 <= shard < 8 and 250 < n < 520
    assert 200 < sum(r.grown_shard == 8 for r in got) < 480


def test_weights_and_stability(spark):
    df = spark.range(20_000).select(rendezvous(F.col("id"), [1, 3, 4]).alias("s"), rendezvous(F.col("id"), [1, 3, 4, 2]).alias("t"))
    rows = df.collect()
    share = Counter(r.s for r in rows)
    assert abs(share[0] / 20_000 - 1 / 8) < 0.02 and abs(share[2] / 20_000 - 1 / 2) < 0.02
    assert all(r.t in (r.s, 3) for r in rows)
    key = spark.range(1).select(F.xxhash64(F.lit("17")).alias("h")).first().h & (2**64 - 1)
    assert key == xxhash.xxh64_intdigest(b"17", 42)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, 2, 3), (4, 5, 6)], "k long, _block int, _place int")
    out = place(df, "k", [1.0])
    assert sorted(r.slot for r in out.collect()) == [0, 1]
    assert set(df.columns) <= set(out.columns)
    assert place(df.limit(0), "k", [1.0, 2.0], [1.0, 2.0, 3.0]).collect() == []
