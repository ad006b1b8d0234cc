"""Helpers shared by the corpus operators: names, tables, Arrow text blocks, words as hashes."""

from __future__ import annotations

import functools
import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import rollkeeper
from rollkeeper.llm.files import located, new_folder

#: Bytes of text that a task turns into arrays at once.
BLOCK_BYTES = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words `[^\x20\x09-\x0D]+`: all but ASCII white space.
GRAPH = np.ones(256, bool)
GRAPH[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`: digits, small letters, non-ASCII.
ALNUM = np.ones(256, bool)
ALNUM[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session, so that tasks can import it wherever the driver found it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(rollkeeper.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent).as_posix())
    place = f"{new_folder(spark, 'code')}/rollkeeper.zip"
    store, path = located(place)
    with store.open_output_stream(path, compression=None) as stream:
        stream.write(packed.getvalue())
    context.addPyFile(place)
    _SHIPPED.add(context.applicationId)


def mapped(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package at hand; for ``DataFrame.transform``."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_column_type(df: DataFrame, name: str, ddl: str) -> str:
    """The schema of ``df`` with one more column, as text for ``mapInArrow``."""
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return ", ".join([*fields, f"`{name}` {ddl}"])


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, row after the last, bytes, offsets.

    Null counts as empty. A text longer than the limit makes a block of its own.
    """
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        high = min(high, n)
        own = offsets[low : high + 1]
        yield low, high, data[own[0] : own[-1]], own - own[0]
        low = high


def word_bounds(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words, and for each text the index of its first word."""
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = word[data]
    full = offsets[:-1] < offsets[1:]
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    edge[offsets[:-1][full]] = True
    at = np.flatnonzero(edge)
    after = np.append(at[1:], len(data))
    kept = inside[at]
    starts, ends = at[kept], after[kept]
    return starts, ends, np.searchsorted(starts, offsets)


@functools.lru_cache(4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes; it depends on nothing but these."""
    if not len(starts):
        return np.empty(0, np.uint64)
    size = 1 << max(12, int(len(data) - 1).bit_length())
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(size, _BASE)[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * _powers(size, _BASE_INVERSE)[starts]
    return mixed(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    return np.arange(total) + np.repeat(np.asarray(starts, np.int64) - (np.cumsum(counts) - counts), counts)


def lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """A list column of which row i holds the next ``counts[i]`` values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def numbered(df: DataFrame, group: list[str], slot: str, place: str, block_bits: int = 13) -> DataFrame:
    """``df`` with ``slot``: gapless numbers from 0 within each group, however large the group.

    ``place`` is a unique long column made by ``monotonically_increasing_id`` and stored
    with the rows. Rows are numbered inside blocks of 2**block_bits places, so a hot
    group is spread over many windows; the blocks' counts give each its first number.
    """
    from pyspark.sql import Window

    block, n, base = fresh(df, "_block"), fresh(df, "_count"), fresh(df, "_base")
    rows = df.withColumn(block, F.shiftright(place, block_bits))
    running = Window.partitionBy(*group).orderBy(block)
    bases = (
        rows.groupBy(*group, block)
        .agg(F.count(F.lit(1)).alias(n))
        .withColumn(base, F.sum(n).over(running) - F.col(n))
        .drop(n)
    )
    inside = Window.partitionBy(*group, block).orderBy(place)
    return (
        rows.withColumn(slot, F.row_number().over(inside))
        .join(bases, [*group, block])
        .withColumn(slot, F.col(slot).cast("long") - 1 + F.col(base))
        .drop(block, base)
    )
