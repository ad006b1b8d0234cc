"""Token ids in canonical length-limited Huffman code, in files of independent blocks.

Ids are counted over the whole corpus; package-merge gives code lengths of at most
``limit`` bits; codes are canonical, so a file needs no more than the lengths. A
document's code starts at a byte; every ``EVERY`` ids its bit offset is kept as a
checkpoint. A block holds whole documents (one, if that is long) with their ids, counts
and checkpoints, and can be decoded without any other. The decoder looks the next bits up
in a table of 2**limit rows and runs from all checkpoints of a block at once.

Files are ranges of documents in ascending id order, null ids first; their sizes give
each file its first position. Ties of an id are kept in the order they were read in.
Null or empty text: the end id alone. An empty table makes no file and no row. A very long text
is one document with checkpoints. Other columns are not read, whatever their names.

A file: ``RKHC``, then numbers as little-endian: version and limit (bytes), length of the
packed code lengths (4 bytes), these (zlib; a byte for each id from 0), then blocks. A
block: documents, checkpoints, code bytes (8 bytes each), has-id flags (a byte each),
document ids (8), counts (8), code bytes of each document (8), checkpoints (8, bits from
the document's start), code.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollkeeper.llm.common import documents, mapped, ranges, text_blocks
from rollkeeper.llm.files import located, new_folder, own_name, spread_files
from rollkeeper.llm.packing import public_path
from rollkeeper.llm.tokens import crc32s, encoder

END_ID = 2
LIMIT = 18
EVERY = 512
#: Code bytes after which a block ends.
BLOCK_CODE_BYTES = 1 << 20
MAGIC = b"RKHC"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 for ids that don't occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} ids don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    level, leaf = weight, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weight, pairs])
        by = np.argsort(both, kind="stable")
        level = both[by]
        leaf.append(by < n)
    take = 2 * n - 2
    depth = np.zeros(n, np.int64)
    for is_leaf in reversed(leaf):  # the first `take` of a level: leaves, and packages of the level below
        own = int(is_leaf[:take].sum())
        depth[:own] += 1
        take = 2 * (take - own)
    lengths[order] = depth
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The codes that belong to these lengths: by length, then id, counted upwards."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        size = lengths[order].astype(np.int64)
        longest = int(size.max())
        width = np.left_shift(1, longest - size)
        codes[order] = (np.concatenate([[0], np.cumsum(width)[:-1]]) >> (longest - size)).astype(np.uint64)
    return codes


def encode(ids: np.ndarray, counts: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code of documents (runs of ``counts`` ids, none empty): bytes, bytes of each document, bit offset of each id in its document."""
    size = lengths[ids].astype(np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    first = np.cumsum(counts) - counts
    begun = total[first]
    bits = total[np.cumsum(counts)] - begun
    n_bytes = (bits + 7) >> 3
    base = (np.cumsum(n_bytes) - n_bytes) * 8
    inside = total[:-1] - np.repeat(begun, counts)
    at = inside + np.repeat(base, counts)
    word, shift = at >> 6, 64 - (at & 63) - size
    code = codes[ids]
    over = shift < 0
    left = np.where(over, code >> np.where(over, -shift, 0).astype(np.uint64), code << np.where(over, 0, shift).astype(np.uint64))
    out = np.zeros(int(n_bytes.sum() + 7) // 8 + 1, np.uint64)
    heads = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[heads]] = np.add.reduceat(left, heads)
    out[word[over] + 1] += code[over] << (64 + shift[over]).astype(np.uint64)
    return out.astype(">u8").view(np.uint8)[: int(n_bytes.sum())], n_bytes, inside


def table(lengths: np.ndarray, limit: int) -> np.ndarray:
    """For every ``limit`` bits the id they start with and its length, as id * 32 + length."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    size = lengths[order].astype(np.int64)
    out = np.zeros(1 << limit, np.int64)
    filled = np.repeat((order << 5) | size, np.left_shift(1, limit - size))
    out[: len(filled)] = filled
    return out


def decode(code: np.ndarray, starts: np.ndarray, counts: np.ndarray, look: np.ndarray, limit: int) -> np.ndarray:
    """Ids of runs that start at these bits and have these counts, all runs side by side."""
    padded = np.concatenate([code, np.zeros(8, np.uint8)]).astype(np.int64)
    window = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
    by = np.argsort(-counts, kind="stable")
    at, left = starts[by].astype(np.int64), counts[by]
    first = (np.cumsum(counts) - counts)[by]
    out = np.empty(int(counts.sum()), np.uint32)
    mask, n = (1 << limit) - 1, len(by)
    for step in range(int(counts.max(initial=0))):
        n = int(np.searchsorted(-left[:n], -step, "left"))  # runs with more than `step` ids
        now = at[:n]
        entry = look[(window[now >> 3] >> (32 - limit - (now & 7))) & mask]
        out[first[:n] + step] = entry >> 5
        now += entry & 31
    return out



def token_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END_ID) -> tuple[DataFrame, DataFrame]:
    """Each document's ids as 16- or 32-bit numbers, stored: doc_id, place, ids (binary), wide (boolean);
    and from the same pass how often each id occurs in each task's share (see ``id_counts``)."""

    def run(batches):
        words = encoder(path)
        total = np.zeros(0, np.int64)
        for batch in batches:
            for low, high, data, offsets in text_blocks(batch.column(1)):
                ids, counts = words.block(data, offsets, end)
                own = np.bincount(ids)
                if len(own) > len(total):
                    own, total = total, own.astype(np.int64)
                total[: len(own)] += own
                wide = len(total) > 1 << 16 and int(ids.max(initial=0)) >= 1 << 16
                raw = ids.astype("<u4" if wide else "<u2").tobytes()
                ends = (np.cumsum(counts) * (4 if wide else 2)).tolist()
                blobs = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                columns = [batch.column(0).slice(low, high - low).cast(pa.int64()), pa.array(blobs, pa.binary()), pa.array([wide] * (high - low))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "wide"])
        some = np.flatnonzero(total)
        if len(some):  # the one row of this task that is no document: wide is null
            share = np.concatenate([some, total[some]]).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([share], pa.binary()), pa.array([None], pa.bool_())], names=["doc_id", "ids", "wide"])

    spark = docs.sparkSession
    made = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).transform(mapped, run, "doc_id bigint, ids binary, wide boolean")
    made = made.withColumn("place", F.monotonically_increasing_id())
    folder = new_folder(spark, "token-ids")
    made.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    stored = spark.read.schema(made.schema).parquet(folder)
    return stored.filter("wide is not null"), stored.filter("wide is null")


def _numbers(batch) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a batch of ``token_table``, and how many each row has."""
    names = batch.schema.names
    parts, counts = [], []
    for raw, wide in zip(batch.column(names.index("ids")).to_pylist(), batch.column(names.index("wide")).to_pylist(), strict=True):
        parts.append(np.frombuffer(raw, "<u4" if wide else "<u2"))
        counts.append(len(parts[-1]))
    return np.concatenate(parts).astype(np.int64), np.array(counts, np.int64)


def _slices(batch, rows: int = 1000):
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def id_counts(shares: DataFrame) -> np.ndarray:
    """How often each id occurs in the whole corpus; the driver gets a row for each id of the vocabulary."""

    def run(batches):
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                ids, n = np.frombuffer(raw, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["id", "n"])

    rows = shares.select("ids").transform(mapped, run, "id bigint, n bigint")
    rows = rows.groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.id for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r.id] = r.n
    return counts


def encoded(tokens: DataFrame, lengths: np.ndarray) -> DataFrame:
    """doc_id, place, n, code (bytes) and checkpoints (bit offsets, 8 bytes each) of each document."""
    shared = tokens.sparkSession.sparkContext.broadcast((lengths, canonical(lengths)))

    def run(batches):
        lengths, codes = shared.value
        for batch in batches:
            for part in _slices(batch):
                ids, counts = _numbers(part)
                code, n_bytes, inside = encode(ids, counts, codes, lengths)
                raw, ends = code.tobytes(), np.cumsum(n_bytes).tolist()
                n_marks = (counts - 1) // EVERY
                first = np.cumsum(counts) - counts
                nth = ranges(np.ones(len(counts)), n_marks)
                marks = inside[np.repeat(first, n_marks) + nth * EVERY].astype("<i8").tobytes()
                marks_end = (np.cumsum(n_marks) * 8).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.names.index("doc_id")),
                        part.column(part.schema.names.index("place")),
                        pa.array(counts),
                        pa.array([raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], pa.binary()),
                        pa.array([marks[a:b] for a, b in zip([0, *marks_end], marks_end, strict=False)], pa.binary()),
                    ],
                    names=["doc_id", "place", "n", "code", "marks"],
                )

    return tokens.transform(mapped, run, "doc_id bigint, place bigint, n bigint, code binary, marks binary")


def block_bytes(rows: list[tuple]) -> bytes:
    """A block of (doc_id, n, code, marks) rows."""
    ids, counts, codes, marks = zip(*rows, strict=True)
    numbers = [[i or 0 for i in ids], counts, list(map(len, codes))]
    head = struct.pack("<QQQ", len(rows), sum(map(len, marks)) // 8, sum(map(len, codes)))
    return b"".join([head, bytes(i is not None for i in ids), *(np.array(x, "<i8").tobytes() for x in numbers), *marks, *codes])


def write_files(codes: DataFrame, lengths: np.ndarray, limit: int, folder: str) -> DataFrame:
    """Writes ranges of documents as files below ``folder``; returns the stored table of them: part, path, n."""
    packed = zlib.compress(lengths.tobytes())

    def run(batches):
        stream, total, rows, size = None, 0, [], 0
        part = TaskContext.get().partitionId()
        path = own_name(folder, 0, ".rkhc")
        for batch in batches:
            for row in zip(*(batch.column(batch.schema.names.index(c)).to_pylist() for c in ("doc_id", "n", "code", "marks")), strict=True):
                if stream is None:
                    store, place = located(path)
                    stream = store.open_output_stream(place, compression=None)
                    stream.write(MAGIC + struct.pack("<BBI", 1, limit, len(packed)) + packed)
                rows.append(row)
                size += len(row[2])
                total += row[1]
                if size >= BLOCK_CODE_BYTES:
                    stream.write(block_bytes(rows))
                    rows, size = [], 0
        if stream is not None:
            if rows:
                stream.write(block_bytes(rows))
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([path]), pa.array([total])], names=["part", "path", "n"])

    spark = codes.sparkSession
    made = codes.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
    made = made.transform(mapped, run, "part bigint, path string, n bigint")
    where = f"{folder}/manifest"
    made.write.parquet(where)
    return spark.read.schema(made.schema).parquet(where)


def _exactly(stream, n: int) -> bytes:
    raw = stream.read(n)
    if len(raw) != n:
        raise ValueError("the file ends too early")
    return raw


def read_blocks(stream) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Document ids, counts and ids of each block of a file."""
    head = _exactly(stream, 10)
    version, limit, size = struct.unpack("<BBI", head[4:])
    if head[:4] != MAGIC or version != 1:
        raise ValueError("not such a file")
    look = table(np.frombuffer(zlib.decompress(_exactly(stream, size)), np.uint8), limit)
    while head := stream.read(24):
        docs, marks, n_code = struct.unpack("<QQQ", head)
        flags = np.frombuffer(_exactly(stream, docs), np.uint8)
        ids, counts, n_bytes = np.frombuffer(_exactly(stream, docs * 24), "<i8").reshape(3, -1)
        offsets = np.frombuffer(_exactly(stream, marks * 8), "<i8")
        code = np.frombuffer(_exactly(stream, n_code), np.uint8)
        runs = (counts - 1) // EVERY + 1
        first = np.cumsum(runs) - runs
        starts = np.zeros(int(runs.sum()), np.int64)
        later = np.ones(len(starts), bool)
        later[first] = False
        starts[later] = offsets
        starts += np.repeat((np.cumsum(n_bytes) - n_bytes) * 8, runs)
        sizes = np.full(len(starts), EVERY)
        sizes[first + runs - 1] = counts - (runs - 1) * EVERY
        yield [int(i) if f else None for i, f in zip(ids, flags, strict=True)], counts, decode(code, starts, sizes, look, limit)


def read_files(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32 and, if asked, ids (32-bit)."""

    def run(batches):
        for batch in batches:
            for base, path in zip(batch.column("base").to_pylist(), batch.column("path").to_pylist(), strict=True):
                store, place = located(path)
                done = base
                with store.open_input_stream(place, compression=None, buffer_size=1 << 20) as stream:
                    for docs, counts, ids in read_blocks(stream):
                        columns = [
                            pa.array(docs, pa.int64()),
                            pa.array(done + np.cumsum(counts) - counts),
                            pa.array(counts),
                            pa.array(crc32s(ids, counts), pa.int64()),
                        ]
                        if with_ids:
                            raw, ends = ids.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
                            columns.append(pa.array([raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], pa.binary()))
                        done += int(counts.sum())
                        yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    base = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    return spread_files(files.select("path", base.alias("base"))).transform(mapped, run, schema)


def write_corpus(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Tokenises, counts, encodes and writes all of ``docs``; returns the table of the files."""
    tokens, shares = token_table(docs, path)
    counts = id_counts(shares)
    limit = max(limit, int(np.count_nonzero(counts)).bit_length())
    lengths = code_lengths(counts, limit)
    return write_files(encoded(tokens, lengths), lengths, limit, new_folder(docs.sparkSession, "huffman"))


def op6_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written in the file format, and what reading the files gives."""
    files = write_corpus(documents(spark, sf_dir), public_path())
    return read_files(files).select("doc_id", "start", "n_tokens", "ids_crc32")
