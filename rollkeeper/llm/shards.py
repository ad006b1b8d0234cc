"""Sharding by weighted rendezvous hashing of stable record keys (DataFrame functions only).

Every shard k of weight w gets a score ``-ln(u) / w`` for a key, ``u`` being a number
between 0 and 1 from the hash of (key, k); the smallest score wins, ties go to the
smaller shard. A key's scores for the old shards do not depend on how many there are,
so one more shard can only take keys to itself: about its share of the weight moves.

Null keys: all go to the shard that the null hash picks. Repeated keys share a shard.
Null text: size 1 and crc32 0. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeeper.llm.common import documents, fresh, numbered
from rollkeeper.session import written


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0, 1, ...) of a key among shards with these positive weights."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    scores = []
    for k, weight in enumerate(weights):
        bits = F.shiftrightunsigned(F.xxhash64(key.cast("string"), F.lit(k)), 11)
        u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        scores.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("score"), F.lit(k).alias("shard")))
    if len(scores) == 1:
        return F.lit(0)
    return F.array_min(F.array(*scores))["shard"]


def place(df: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float] | None = None) -> DataFrame:
    """``df`` with ``shard``, ``slot`` (gapless from 0 in each shard) and, if asked, ``grown_shard``.

    The rows are written once, so that slots don't change if a task runs again. Columns
    of these names that ``df`` has already are replaced.
    """
    out = df.withColumn("shard", rendezvous(F.col(key), weights))
    if grown:
        out = out.withColumn("grown_shard", rendezvous(F.col(key), grown))
    at = fresh(out, "_place")
    out = written(out.withColumn(at, F.monotonically_increasing_id()), "placed")
    return numbered(out, ["shard"], "slot", at).drop(at)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 by key, and where a ninth shard would take them."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return place(rows, "doc_id", [1.0] * 8, [1.0] * 9).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
