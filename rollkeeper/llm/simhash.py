"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints at most ``bits`` apart are linked. A fingerprint is cut into bits // 2 + 1
segments, so that of two linked ones some segment differs in at most one bit. Each
fingerprint is indexed under every segment with one bit left out (a wildcard); linked ones
meet under an equal variant, and the distance of those that meet is verified.

Equal fingerprints are folded first. A variant shared by very many fingerprints isn't
expanded into pairs: first each is held against the least one of the variant only, and
the links so found are closed to components. Then only variants that still hold several
components are joined, all but their largest component with the others; a pair that is
left out lies in one component already, so the components are exact.

No words, null included: fingerprint zero, linked like any other. A component's id is its
smallest doc_id (null if it has none). Repeated rows share fingerprint and component. A very
long text is one fingerprint like any other. An empty table gives an empty result. Other
columns pass through ``keep_one``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeeper.llm.common import documents, fresh, mapped, text_blocks
from rollkeeper.llm.components import components
from rollkeeper.session import written

SHINGLE = 4
BITS = 4
SEED = 42
_CHUNK = 1 << 15


def _bits_over_half(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For runs of hashes the number whose bits are set in over half of them."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    # column j of a row of bits is bit 63 - j
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64)
    first = (np.cumsum(counts) - counts)[some]
    sums = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    out[some] = np.packbits(2 * sums > counts[some][:, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(raw: bytes, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints (unsigned) of a block of texts whose ASCII capitals are lowered."""
    from xxhash import xxh64_digest

    out = np.zeros(len(offsets) - 1, np.uint64)
    begun, counts, digests = 0, [], []

    def close(upto: int):
        nonlocal begun, counts, digests
        out[begun:upto] = _bits_over_half(np.frombuffer(b"".join(digests), ">u8"), np.array(counts, np.int64))
        begun, counts, digests = upto, [], []

    for k, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        words = raw[low:high].split()
        joined = b" ".join(words)
        n = len(words)
        if n > shingle:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
            starts = np.concatenate([[0], ends[: n - shingle] + 1]).tolist()
            digests += [xxh64_digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
            counts.append(n - shingle + 1)
        elif n:
            digests.append(xxh64_digest(joined, SEED))
            counts.append(1)
        else:
            counts.append(0)
        if len(digests) >= _CHUNK:
            close(k + 1)
    close(len(out))
    return out


def with_fingerprint(docs: DataFrame, keep: list[str], name: str, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns and the fingerprint, as a signed long."""
    fields = [docs.schema[c] for c in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{name}` bigint"])

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for low, high, data, offsets in text_blocks(texts):
                raw = data.tobytes().lower()  # of bytes: A-Z only
                found = fingerprints(raw, offsets, shingle).view(np.int64)
                columns = [batch.column(i).slice(low, high - low) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], names=[*keep, name])

    return docs.select(*keep, F.col(text_col).alias(fresh(docs, "_body"))).transform(mapped, run, schema)


def segments(bits: int, width: int = 64) -> list[tuple[int, int]]:
    """(first bit, bits) of as few segments as make one differ by at most one bit."""
    n = bits // 2 + 1
    edges = [width * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def variants(fp: Column, bits: int) -> Column:
    """All one-wildcard variants of a fingerprint's segments: the segment without the bit, and which bit that is."""
    out = []
    for low, size in segments(bits):
        body = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << size) - 1))
        for p in range(size):
            left_out = body.bitwiseAND(F.lit(((1 << size) - 1) & ~(1 << p)))
            out.append(F.shiftleft(left_out, 6).bitwiseOR(F.lit(low + p).cast("long")) if size <= 57 else F.xxhash64(left_out, F.lit(low + p)))
    return F.array(*out)


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _index(rows: DataFrame, bits: int) -> DataFrame:
    """The rows of ``rows`` (fp, ...) under each of their variants, dealt out before they get so many more."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "fp").withColumn("key", F.explode(variants(F.col("fp"), bits)))


def link_components(distinct: DataFrame, bits: int) -> DataFrame:
    """``distinct`` (fp, stored): for each fingerprint but the least of its component (a, b), b being the least.

    A variant of two fingerprints is settled where it is counted: they are its least and
    its greatest. Larger ones are joined, first with their least fingerprint, then, as far
    as they still hold several components, all but their largest component with the rest.
    """
    index = _index(distinct, bits)
    heads = index.groupBy("key").agg(F.min("fp").alias("head"), F.max("fp").alias("last"), F.count(F.lit(1)).alias("n"))
    heads = written(heads.filter("n > 1"), "heads")
    met = index.join(heads.filter("n > 2").select("key", "head").hint("merge"), "key").filter(F.col("fp") != F.col("head"))
    met = met.filter(_apart("fp", "head") <= bits).select(F.col("fp").alias("a"), F.col("head").alias("b"))
    pairs = heads.filter("n = 2").filter(_apart("head", "last") <= bits).select(F.col("last").alias("a"), F.col("head").alias("b"))
    roots = components(written(met.unionByName(pairs).distinct(), "first-links"))

    sizes = written(roots.groupBy("b").agg((F.count(F.lit(1)) + 1).alias("size")), "sizes")
    held = distinct.join(roots, distinct.fp == roots.a, "left").select("fp", F.coalesce("b", "fp").alias("root"))
    held = held.join(sizes, held.root == sizes.b, "left").select("fp", "root", F.coalesce("size", F.lit(1)).alias("size"))
    index = _index(written(held, "rooted"), bits)
    mixed = index.groupBy("key").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi"), F.count(F.lit(1)).alias("n"))
    mixed = written(mixed.filter("n > 2 and _lo < _hi").select("key"), "mixed")  # two were settled above
    weight = F.struct("size", "root").alias("weight")
    rest = written(index.join(mixed.hint("merge"), "key").select("key", "fp", "root", weight), "mixed-index")
    tops = written(rest.groupBy("key").agg(F.max("weight").alias("top")), "tops")
    one = rest.join(tops, "key").filter("weight < top").select("key", *(F.col(c).alias(f"{c}1") for c in ("fp", "root", "weight")))
    two = rest.select("key", *(F.col(c).alias(f"{c}2") for c in ("fp", "root", "weight")))
    met = one.join(two, "key").filter(F.col("weight1") < F.col("weight2")).filter(_apart("fp1", "fp2") <= bits)
    more = written(met.select(F.col("root1").alias("a"), F.col("root2").alias("b")).distinct(), "more-links")
    if more.isEmpty():
        return roots
    return components(roots.unionByName(more))


def near_duplicates(docs: DataFrame, keep: list[str], bits: int = BITS, shingle: int = SHINGLE, text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, ``fp`` and ``root`` (equal for all rows of a component); stored before the last join."""
    rows = written(with_fingerprint(docs, keep, "fp", text_col, shingle), "fingerprints")
    distinct = written(rows.select("fp").distinct(), "distinct")
    roots = link_components(distinct, bits)
    return rows.join(roots, rows.fp == roots.a, "left").select(*keep, "fp", F.coalesce("b", "fp").alias("root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """One row of each component with its columns: that of the smallest id (null ids last), the first of its ties.

    ``docs`` must be a stored table, so that a row keeps its place from scan to scan.
    """
    place = fresh(docs, "_place")
    placed = docs.withColumn(place, F.monotonically_increasing_id())
    rows = near_duplicates(placed, [id_col, place], bits, shingle)
    best = rows.groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull(), id_col, place)).alias("_best"))
    kept = written(best.select(F.col("_best")[place].alias(place)), "kept")
    return placed.join(kept, place, "left_semi").drop(place)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(documents(spark, sf_dir), ["doc_id"])
    rows = written(rows, "rooted")
    ids = written(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "component-ids")
    return rows.join(ids, "root").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
