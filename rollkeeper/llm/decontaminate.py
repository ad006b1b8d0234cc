"""Benchmark decontamination with suffix arrays of the training text.

Every block of documents (a shard of whole texts, some megabytes) gets a suffix array
over its words. Every suffix of every benchmark item is searched in it, word by word,
by binary search inside the interval that the words before have left; the interval of
the window length holds all places of that window. Windows that follow each other on
one diagonal are one longest verbatim match (item, first word there, first word in the
document, words). Suffixes are ordered as deep as the longest item, since no search
looks further. Documents never move: no shuffle, and a hot source is cut like any other.

Benchmark items never come to the driver: tasks write them as hashes into files of bounded
size in the shared folder, and the driver holds the files' names. For each shard a task
opens one block of files after the other, so it holds one block and one shard at a time.

Null text: no words, no hits. Items of fewer words than a window count as one window;
items without words match nothing. Rows that repeat are judged one by one. An item_id
that repeats, or is null, hits words as usual; ids count once, null ids not at all. A text
longer than a shard is a shard of its own. An empty table of documents gives an empty result,
and without items nothing is hit. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeeper.llm.common import (
    ALNUM,
    documents,
    fresh,
    lists,
    LOWER,
    mapped,
    ranges,
    text_blocks,
    with_column_type,
    word_bounds,
    word_hashes,
)
from rollkeeper.llm.files import located, new_folder, own_name
from rollkeeper.llm.suffixes import suffix_array
from rollkeeper.session import _RUNS, written

WINDOW = 13
#: Benchmark text that a task holds at once, with 16 bytes an item; a larger item is a block of its own.
ITEM_BLOCK_BYTES = 8 << 20
#: Text of one shard; hashing and sorting hold some fifty bytes for each of it.
SHARD_BYTES = 2 << 20

MATCH = pa.struct(
    [("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("words", pa.int64())]
)
FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("matches", pa.list_(MATCH))])
FOUND_DDL = (
    "struct<n_words:bigint,n_hit:bigint,matches:array<struct<item_id:string,item_word:bigint,"
    "doc_word:bigint,words:bigint>>>"
)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and each text's first word."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, ALNUM)
    return word_hashes(data, starts, ends), first


class Items:
    """A block of benchmark items as word hashes, one text after the other."""

    def __init__(self, paths: list[str], window: int):
        tables = [_read(path) for path in paths]
        self.ids = [i for t in tables for i in t.column("id").to_pylist()]
        raw = [w for t in tables for w in t.column("words").to_pylist()]
        self.words = np.frombuffer(b"".join(raw), "<u8")
        counts = np.array([len(w) // 8 for w in raw], np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        # every suffix: its item, first word, words left, and the words of its window
        self.item = np.repeat(np.arange(len(raw)), counts)
        self.left = np.repeat(self.first[1:], counts) - np.arange(len(self.words))
        self.need = np.repeat(np.minimum(counts, window), counts)


def _read(path: str) -> pa.Table:
    store, place = located(path)
    with store.open_input_file(place) as stream:
        return pa.ipc.open_file(stream).read_all()


def _bound(value, low: np.ndarray, high: np.ndarray, target: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of all targets at once, each between its own bounds."""
    low, high = low.copy(), high.copy()
    live = np.flatnonzero(low < high)
    while len(live):
        mid = (low[live] + high[live]) >> 1
        seen = value(mid, live)
        less = seen <= target[live] if right else seen < target[live]
        low[live[less]] = mid[less] + 1
        high[live[~less]] = mid[~less]
        live = live[low[live] < high[live]]
    return low


def search(order: np.ndarray, rank: np.ndarray, word: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each benchmark suffix its longest match (words), and the interval of its window (empty if none)."""
    n = len(items.words)
    longest, from_, to = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    at = np.arange(n)
    low, high = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    depth = 0
    while len(at):
        target = word[at + depth]
        known = target > 0
        at, low, high, target = at[known], low[known], high[known], target[known]
        d = depth

        def value(mid, live):
            return rank[order[mid] + d]

        start = _bound(value, low, high, target, False)
        end = _bound(value, start, high, target, True)
        found = start < end
        at, low, high = at[found], start[found], end[found]
        depth += 1
        longest[at] = depth
        whole = items.need[at] == depth
        from_[at[whole]], to[at[whole]] = low[whole], high[whole]
        more = items.left[at] > depth
        at, low, high = at[more], low[more], high[more]
    return longest, from_, to


class Shard:
    """Some documents' words as ranks, and their suffix array, ordered ``deep`` words deep."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray, deep: int):
        self.known, rank0 = np.unique(hashes, return_inverse=True)
        counts = np.diff(first)
        n = len(hashes) + len(counts)
        self.first, self.stops = first, first[1:] + np.arange(len(counts))
        self.rank = np.zeros(n, np.int32)  # a shard has fewer words than bytes
        inside = np.ones(n, bool)
        inside[self.stops] = False
        self.rank[inside] = rank0 + 1
        self.order = suffix_array(self.rank, np.repeat(self.stops, counts + 1), deep).astype(np.int32)


def matches(shard: Shard, items: Items) -> tuple[np.ndarray, ...]:
    """Document row, item, first word in the item, first word in the document, words of the longest matches."""
    none = (np.empty(0, np.int64),) * 5
    known, first, order = shard.known, shard.first, shard.order
    if not len(known) or not len(items.words):
        return none
    at = np.searchsorted(known, items.words)
    word = np.where(known[np.minimum(at, len(known) - 1)] == items.words, at + 1, 0)
    _, from_, to = search(order, shard.rank, word, items)
    # a window starts where the item has as many words left, or at the start of a short item
    size = to - from_
    size[items.left < items.need] = 0
    suffix = np.repeat(np.arange(len(size)), size)
    if not len(suffix):
        return none
    place = order[ranges(from_, size)]
    row = np.searchsorted(shard.stops, place)
    item = items.item[suffix]
    item_word = suffix - items.first[item]
    doc_word = place - (first[row] + row)
    by = np.lexsort((doc_word, doc_word - item_word, item, row))
    row, item, item_word, doc_word = row[by], item[by], item_word[by], doc_word[by]
    need = items.need[suffix[by]]
    new = np.ones(len(row), bool)
    new[1:] = (
        (row[1:] != row[:-1]) | (item[1:] != item[:-1])
        | (np.diff(doc_word - item_word) != 0) | (np.diff(doc_word) != 1)
    )
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(row)) - 1
    return row[head], item[head], item_word[head], doc_word[head], doc_word[tail] - doc_word[head] + need[tail]


def covered(row: np.ndarray, start: np.ndarray, length: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each row, how many of its words lie in at least one match."""
    base = np.concatenate([[0], np.cumsum(counts + 1)])
    change = np.zeros(int(base[-1]) + 1, np.int64)
    np.add.at(change, base[row] + start, 1)
    np.add.at(change, base[row] + start + length, -1)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(change) > 0)])
    return hit[base[1:]] - hit[base[:-1]]


def _found(texts: pa.Array, blocks: list[list[str]], deep: int, opened) -> pa.Array:
    parts = []
    for low, high, data, offsets in text_blocks(texts, SHARD_BYTES):
        hashes, first = words_of(data, offsets)
        counts = np.diff(first)
        ids, found = [], [(np.empty(0, np.int64),) * 4]
        shard = Shard(hashes, first, deep) if blocks and len(hashes) else None
        for paths in blocks if shard else ():
            items = opened(paths)
            row, item, *places = matches(shard, items)
            ids += [items.ids[i] for i in item]
            found.append((row, *places))
        row, item_word, doc_word, words = (np.concatenate(x) for x in zip(*found, strict=True))
        by = np.argsort(row, kind="stable")
        row, item_word, doc_word, words = row[by], item_word[by], doc_word[by], words[by]
        n_hit = covered(row, doc_word, words, counts)
        values = pa.StructArray.from_arrays(
            [pa.array([ids[i] for i in by], pa.string()), pa.array(item_word), pa.array(doc_word), pa.array(words)], fields=list(MATCH)
        )
        found = lists(values, np.bincount(row, minlength=high - low))
        parts.append(
            pa.StructArray.from_arrays([pa.array(counts.astype(np.int64)), pa.array(n_hit.astype(np.int64)), found], fields=list(FOUND))
        )
    return pa.concat_arrays(parts) if parts else pa.array([], FOUND)


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int = ITEM_BLOCK_BYTES) -> tuple[list[list[str]], int]:
    """Lists of files that hold about ``limit`` bytes of items together, and the words of the longest item."""
    folder = new_folder(benchmark.sparkSession, "items")
    if _RUNS:
        _RUNS[-1].append(folder)

    def run(batches):
        number = 0

        def flush(ids, words, size):
            nonlocal number
            path = own_name(folder, number, ".arrow")
            number += 1
            store, place = located(path)
            table = pa.table({"id": pa.array(ids, pa.string()), "words": pa.array(words, pa.large_binary())})
            with store.open_output_stream(place, compression=None) as stream, pa.ipc.new_file(stream, table.schema) as out:
                out.write_table(table)
            longest = max(len(w) // 8 for w in words)
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size]), pa.array([longest])], names=["path", "size", "longest"])

        ids, words, size = [], [], 0
        for batch in batches:
            names = batch.column(0)
            for low, high, data, offsets in text_blocks(batch.column(1), min(limit, SHARD_BYTES)):
                hashes, first = words_of(data, offsets)
                raw = hashes.astype("<u8").tobytes()
                for k in range(high - low):
                    own = int(offsets[k + 1] - offsets[k]) + 16
                    if ids and size + own > limit:
                        yield flush(ids, words, size)
                        ids, words, size = [], [], 0
                    ids.append(names[low + k].as_py())
                    words.append(raw[first[k] * 8 : first[k + 1] * 8])
                    size += own
        if ids:
            yield flush(ids, words, size)

    rows = benchmark.select(F.col(id_col).cast("string"), text_col).transform(mapped, run, "path string, size bigint, longest bigint")
    blocks, room, deep = [], 0, 0
    for r in written(rows, "item-files").orderBy("path").collect():
        if r["size"] > room:
            blocks.append([])
            room = limit
        blocks[-1].append(r["path"])
        room -= r["size"]
        deep = max(deep, r["longest"])
    return blocks, deep


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    found: str,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    item_block_bytes: int = ITEM_BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``found``: n_words, n_hit, matches (the longest, with their places)."""
    schema = with_column_type(docs, found, FOUND_DDL)
    blocks, deep = item_blocks(benchmark, item_id_col, item_text_col, item_block_bytes)

    def run(batches):
        last = None
        pa.default_memory_pool().release_unused()  # what this worker holds from the stages before

        def opened(paths):
            nonlocal last
            if last is None or last[0] != paths:
                last = None  # the old block goes before the new one comes
                last = paths, Items(paths, window)
            return last[1]

        for batch in batches:
            names = batch.schema.names
            result = _found(batch.column(names.index(text_col)), blocks, deep, opened)
            yield pa.RecordBatch.from_arrays([*batch.columns, result], names=[*names, found])

    return docs.transform(mapped, run, schema)


def contaminated(found: Column) -> Column:
    """The contract's rule: some word is hit, and at least a twentieth of the words."""
    return (found["n_hit"] > 0) & (found["n_hit"] * 20 >= found["n_words"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns they came with."""
    found = fresh(docs, "_found")
    return scan(docs, benchmark, found, text_col).filter(~contaminated(F.col(found))).drop(found)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = scan(documents(spark, sf_dir).select("doc_id", "text"), benchmark, "_found")
    found = F.col("_found")
    items = F.array_sort(F.array_distinct(F.filter(found["matches"]["item_id"], lambda i: i.isNotNull())))
    return out.select(
        "doc_id",
        found["n_words"].alias("n_words"),
        found["n_hit"].alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(found).alias("contaminated"),
    )
