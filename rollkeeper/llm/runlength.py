"""Removal of long repeats with a run-length index (run-compressed Burrows-Wheeler transform).

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else in the
corpus. Repeated strings are found in buckets: every window of ``length`` bytes has a least
hash among its grams of ``GRAM`` bytes; equal windows have the same one, so all places of a
window meet under that value. Neighbouring windows of a text with one value form a segment.

1. Segments are counted by value. A value seen once holds no repeat, unless its gram stands
   at several places of the one segment, which may then repeat within itself.
2. If all segments of a value are equal, they are repeats as a whole.
3. Else its different contents, each once and with its count, go to an index: the transform
   of their concatenation is cut into runs; for the first and last suffix of each run the
   common length with the suffix before and behind is sampled; within a run that length
   falls by one from byte to byte. So streaming the contents past the samples gives, for
   every byte, how long it matches elsewhere: the matching statistics. Where that is
   ``length`` or more, or the content itself has a count above one, the window is marked.
   An index holds whole values up to some megabytes.
4. A value with more than ``MOST_CONTENTS`` contents or ``MOST_BYTES`` of them (a passage that
   very many texts share, each going on differently; long periodic texts) can't be one index:
   its windows are counted one by one, in slices, which Spark adds up before it shuffles.
5. Texts that occur twice or more as a whole go whole. The marks of all others are joined
   with their texts.

Texts are told by their MD5, so rows need no key and equal rows share the work. Null or
empty texts, and those shorter than ``length``, keep all. Windows never cross texts. Bytes
are judged on the input. ``without_repeats`` drops what a cut leaves of a character. A very long
text is cut into windows like any other. An empty table gives an empty result. Other columns
pass through, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeeper.llm.common import (
    _BASE,
    _BASE_INVERSE,
    _powers,
    documents,
    fresh,
    mapped,
    mixed,
    text_blocks,
    with_column_type,
)
from rollkeeper.llm.suffixes import suffix_array
from rollkeeper.session import written

LENGTH = 200
GRAM = 32
MOST_CONTENTS = 4096
#: Bytes of contents in one index.
INDEX_BYTES = 1 << 20
#: Bytes of contents of one value in an index.
MOST_BYTES = 4 << 20
#: Contents, their bytes, and windows that a task hands on at once.
SLICE_ROWS, SLICE_BYTES, SLICE_BITS = 10_000, 8 << 20, 16


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each place on."""
    n = len(data) - gram + 1
    size = 1 << max(12, int(len(data) - 1).bit_length())
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(size, _BASE)[: len(data)], out=sums[1:])
    return mixed((sums[gram:] - sums[:n]) * _powers(size, _BASE_INVERSE)[:n])


def least_in_windows(values: np.ndarray, span: int) -> np.ndarray:
    """The least of ``span`` values from each place on."""
    least, done = values, 1
    while done * 2 <= span:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    rest = span - done
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _among(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ``values`` are among the sorted ``known``, and their numbers there."""
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values, at


def found_twice(hashes: np.ndarray, at: np.ndarray, end: np.ndarray, value: np.ndarray, span: int) -> np.ndarray:
    """For each range of places (``at`` to ``end``) whether its ``value``, the least of ``span``, may stand at several.

    A value that is high for the least of so many comes from a text of few different
    grams; it counts as found twice without a look. Others are looked up.
    """
    high = np.uint64(min(10 / span, 1.0) * float((1 << 64) - 2048))
    out = value > high
    if out.all():
        return out
    place = np.flatnonzero(hashes <= min(value[~out].max(), high))
    ranked = np.sort(hashes[place])
    again = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(again):
        return out
    some, number = _among(value, again)
    if some.any():
        own, group = _among(hashes[place], again)
        size = len(hashes) + 1
        key = np.sort(group[own] * size + place[own])
        base = number[some] * size
        out[some] |= np.searchsorted(key, base + end[some]) - np.searchsorted(key, base + at[some]) > 1
    return out


def cut(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Segments of a block: text, first byte in the block, windows, value, and whether its gram may stand there twice."""
    if len(data) < length:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64), np.empty(0, bool))
    hashes = gram_hashes(data, gram)
    value = least_in_windows(hashes, length - gram + 1)
    windows = np.maximum(np.diff(offsets) - length + 1, 0)
    long = np.flatnonzero(windows)
    first, last = offsets[long], offsets[long] + windows[long]
    edge = np.zeros(len(value) + 1, bool)
    edge[1:-1] = value[1:] != value[:-1]
    edge[first] = True
    edge[last] = True
    at = np.flatnonzero(edge)
    row = np.searchsorted(offsets, at, "right") - 1
    inside = at < offsets[row] + windows[np.minimum(row, len(windows) - 1)] if len(windows) else np.zeros(len(at), bool)
    inside &= row < len(windows)
    end = np.append(at[1:], len(value))
    row, at, wins = row[inside], at[inside], (end - at)[inside]
    return row, at, wins, value[at], found_twice(hashes, at, at + wins + length - gram, value[at], length - gram + 1)


def segments(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``texts`` (digest, text) -> digest, start, wins, value, twice, content of all segments."""

    def run(batches):
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            digests = batch.column(0)
            for low, high, data, offsets in text_blocks(batch.column(1), 1 << 18):
                row, at, wins, value, twice = cut(data, offsets, length, gram)
                raw = data.tobytes()
                content = [xxh3_64_intdigest(raw[a:b]) for a, b in zip(at.tolist(), (at + wins + length - 1).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        digests.slice(low, high - low).take(pa.array(row)),
                        pa.array(at - offsets[row]),
                        pa.array(wins),
                        pa.array(value.view(np.int64)),
                        pa.array(twice),
                        pa.array(np.array(content, np.uint64).view(np.int64)),
                    ],
                    names=["digest", "start", "wins", "value", "twice", "content"],
                )

    return texts.transform(mapped, run, "digest binary, start bigint, wins bigint, value bigint, twice boolean, content bigint")


def slices(sizes: np.ndarray, rows: int = SLICE_ROWS, limit: int = SLICE_BYTES):
    """Ranges of at most ``rows`` rows and ``limit`` bytes; a larger row has a range of its own."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    low = 0
    while low < len(sizes):
        high = min(low + rows, int(np.searchsorted(total, total[low] + limit, "right")) - 1)
        high = max(low + 1, high)
        yield low, high
        low = high


def bodies(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the ``wanted`` contents (value, content, n, hot, digest, start, wins), from texts told by digest."""
    asked = wanted.groupBy("digest").agg(F.collect_list(F.struct("value", "content", "n", "hot", "start", "wins")).alias("asked"))

    def run(batches):
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            rows = batch.column(1)
            flat = rows.flatten()
            row = np.repeat(np.arange(len(rows)), rows.value_lengths().to_numpy())
            start, wins = flat.field("start").to_numpy(), flat.field("wins").to_numpy()
            for k, end in slices(wins + length - 1):
                last, raw, out = -1, b"", []
                for r, a, w in zip(row[k:end].tolist(), start[k:end].tolist(), wins[k:end].tolist(), strict=True):
                    if r != last:
                        last, raw = r, texts[r].as_py()
                    out.append(raw[a : a + w + length - 1])
                some = flat.slice(k, end - k)
                columns = [some.field(c) for c in ("value", "content", "n", "hot")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], names=["value", "content", "n", "hot", "body"])

    return texts.join(asked, "digest").select("text", "asked").transform(mapped, run, "value bigint, content bigint, n bigint, hot boolean, body binary")


_SIGN_BITS, _TOGETHER = 9, 7


def packed(rank: np.ndarray) -> np.ndarray:
    """The seven signs from each place on, in one number."""
    wide = np.concatenate([rank, np.zeros(_TOGETHER, np.int64)])
    out = np.zeros(len(rank), np.int64)
    for k in range(_TOGETHER):
        out = (out << _SIGN_BITS) | wide[k : k + len(rank)]
    return out


def common_lengths(seven: np.ndarray, stop: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many signs the suffixes at ``a`` and ``b`` share; stops equal nothing. ``seven``: see ``packed``."""
    most = np.minimum(stop[a] - a, stop[b] - b)
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        apart = seven[a[live] + out[live]] ^ seven[b[live] + out[live]]
        same = sum((apart >> (_SIGN_BITS * k) == 0).astype(np.int64) for k in range(_TOGETHER))
        out[live] = np.minimum(out[live] + same, most[live])
        live = live[(same == _TOGETHER) & (out[live] < most[live])]
    return out


class RunLengthIndex:
    """The run-compressed transform of some contents, and the samples at its runs' ends.

    ``signs``: for each run its sign (0: a stop, which is a run of its own), ``sizes``: its
    length. ``before`` and ``behind``: places of the first (last) suffix of each run, with
    the length it shares with the suffix before (behind) it in order.
    """

    def __init__(self, contents: list[bytes]):
        sizes = np.array([len(c) for c in contents], np.int64)
        self.first = np.cumsum(sizes + 1) - sizes - 1
        data = np.frombuffer(b"\0".join([*contents, b""]), np.uint8)
        n = len(data)
        self.stop = np.repeat(self.first + sizes, sizes + 1)
        rank = data.astype(np.int64) + 1
        rank[self.first + sizes] = 0
        order = suffix_array(rank, self.stop, int(sizes.max(initial=0)) + 1, settle=True)
        sign = rank[order - 1]  # the first place of all has the last stop before it
        edge = np.ones(n + 1, bool)
        edge[1:-1] = (sign[1:] != sign[:-1]) | (sign[1:] == 0)
        heads = np.flatnonzero(edge[:-1])
        tails = np.flatnonzero(edge[1:])
        self.signs, self.sizes = sign[heads], tails - heads + 1
        seven = packed(rank)
        self.before = self._sampled(seven, order[heads], order[heads - 1], heads > 0)
        self.behind = self._sampled(seven, order[tails], order[(tails + 1) % n], tails < n - 1)

    def _sampled(self, seven, place, other, there) -> tuple[np.ndarray, np.ndarray]:
        shared = np.zeros(len(place), np.int64)
        shared[there] = common_lengths(seven, self.stop, place[there], other[there])
        by = np.argsort(place)
        return place[by], shared[by]

    def matching_statistics(self) -> np.ndarray:
        """For each place how long its suffix matches at another place, streamed past the samples."""
        places = np.arange(len(self.stop))
        longest = np.zeros(len(self.stop), np.int64)
        for at, shared in (self.before, self.behind):
            last = np.zeros(len(self.stop), np.int64)
            last[at] = np.arange(len(at))
            np.maximum.accumulate(last, out=last)
            np.maximum(longest, shared[last] - (places - at[last]), out=longest)
        return longest


def marked_windows(contents: list[bytes], n: np.ndarray, length: int) -> list[np.ndarray]:
    """For each content the windows (first bytes) that occur more than once, all counts taken together."""
    index = RunLengthIndex(contents)
    long = index.matching_statistics() >= length
    out = []
    for k, c in enumerate(contents):
        wins = len(c) - length + 1
        own = long[index.first[k] : index.first[k] + wins]
        out.append(np.arange(wins) if n[k] > 1 else np.flatnonzero(own))
    return out


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and length of each run of consecutive numbers."""
    if not len(places):
        return places, places
    head = np.flatnonzero(np.diff(places, prepend=places[0] - 2) != 1)
    return places[head], np.diff(np.append(head, len(places)))


MARKS = "value bigint, content bigint, at bigint, wins bigint"


def indexed_marks(rows: DataFrame, length: int) -> DataFrame:
    """Runs of marked windows of contents (value, content, n, body); whole values meet in one task, in sorted order."""

    def run(batches):
        def flush(group):
            contents = [g[3] for g in group]
            found = marked_windows(contents, np.array([g[2] for g in group]), length)
            parts = [_runs(f) for f in found]
            size = [len(p[0]) for p in parts]
            spot = np.repeat(np.arange(len(group)), size)
            value, content = (np.array([g[i] for g in group], np.int64)[spot] for i in (0, 1))
            at, wins = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (value, content, at, wins)], names=["value", "content", "at", "wins"])

        group, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(batch.schema.names.index(c)).to_pylist() for c in ("value", "content", "n", "body")), strict=True):
                if group and size >= INDEX_BYTES and row[0] != group[-1][0]:
                    yield flush(group)
                    group, size = [], 0
                if group and group[-1][:2] == row[:2]:
                    continue  # the same content from an equal text
                group.append(row)
                size += len(row[3])
        if group:
            yield flush(group)

    return rows.repartition("value").sortWithinPartitions("value", "content").transform(mapped, run, MARKS)


def window_slices(value: int, content: int, n: int, body: bytes, length: int, bits: int = SLICE_BITS):
    """The windows of one content with their hashes, 2**bits at a time."""
    from xxhash import xxh3_128_digest

    wins = len(body) - length + 1
    for low in range(0, wins, 1 << bits):
        at = np.arange(low, min(low + (1 << bits), wins))
        fixed = [pa.array(np.full(len(at), x, np.int64)) for x in (value, content, n)]
        hashes = [xxh3_128_digest(body[i : i + length]) for i in at.tolist()]
        yield pa.RecordBatch.from_arrays([*fixed, pa.array(at), pa.array(hashes, pa.binary())], names=["value", "content", "n", "at", "window"])


def counted_marks(rows: DataFrame, length: int) -> DataFrame:
    """The same for values with very many contents or bytes: single windows, counted, and runs of them within each slice."""

    def run(batches):
        for batch in batches:
            columns = [batch.column(batch.schema.names.index(c)) for c in ("value", "content", "n", "body")]
            for k in range(batch.num_rows):
                yield from window_slices(*(c[k].as_py() for c in columns), length)

    def joined(batches):
        for batch in batches:
            value, content, ats = (batch.column(batch.schema.names.index(c)) for c in ("value", "content", "ats"))
            for k in range(batch.num_rows):
                at, wins = _runs(np.sort(ats[k].values.to_numpy()))
                fixed = [pa.array(np.full(len(at), x[k].as_py(), np.int64)) for x in (value, content)]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(at), pa.array(wins.astype(np.int64))], names=["value", "content", "at", "wins"])

    rows = rows.dropDuplicates(["value", "content"])
    windows = written(rows.transform(mapped, run, "value bigint, content bigint, n bigint, at bigint, window binary"), "windows")
    often = windows.groupBy("window").agg(F.sum("n").alias("_all")).filter("_all > 1").select("window")
    often = written(often, "frequent-windows")
    found = windows.join(often, "window").groupBy("value", "content", F.shiftright("at", SLICE_BITS).alias("slice"))
    return found.agg(F.collect_list("at").alias("ats")).transform(mapped, joined, MARKS)


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def marks(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, most: int = MOST_CONTENTS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """digest, whole, spans (start, wins) of the texts that hold repeats; stored."""
    texts = docs.select(F.coalesce(text_col, F.lit("")).alias("text")).filter(F.octet_length("text") >= length)
    texts = texts.select(_digest(F.col("text")).alias("digest"), "text")
    copies = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("digest")
    copies = written(copies, "copies")

    all_segments = segments(texts, length, gram)
    values = all_segments.groupBy("value").agg(F.count(F.lit(1)).alias("_n"), F.min("content").alias("_lo"), F.max("content").alias("_hi"), F.max("twice").alias("_twice"))
    mixed = (F.col("_n") == 1) | (F.col("_lo") < F.col("_hi"))
    values = written(values.filter("_n > 1 or _twice").select("value", mixed.alias("mixed")), "values")
    found = written(all_segments.drop("twice").join(values, "value"), "segments")

    contents = found.filter("mixed").groupBy("value", "content").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("digest", "start", "wins")).alias("_one"))
    contents = written(contents.select("value", "content", "n", "_one.*"), "contents")
    sizes = contents.groupBy("value").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("wins") + (length - 1)).alias("_bytes"))
    hot = sizes.filter((F.col("_n") > most) | (F.col("_bytes") > most_bytes)).select("value", F.lit(True).alias("hot"))
    hot = written(hot, "hot-values")
    any_hot = not hot.isEmpty()
    wanted = contents.join(hot, "value", "left").withColumn("hot", F.coalesce("hot", F.lit(False))) if any_hot else contents.withColumn("hot", F.lit(False))
    single = texts.join(copies, "digest", "left_anti").unionByName(texts.join(copies, "digest", "left_semi").dropDuplicates(["digest"]))
    rows = bodies(single, wanted, length)
    if any_hot:
        rows = written(rows, "bodies")
        runs = indexed_marks(rows.filter(~F.col("hot")), length).unionByName(counted_marks(rows.filter("hot"), length))
    else:
        runs = indexed_marks(rows, length)
    runs = written(runs, "marked-windows")

    own = found.join(copies, "digest", "left_anti")
    plain = own.filter(~F.col("mixed")).select("digest", "start", "wins")
    some = own.filter("mixed").drop("wins").join(runs, ["value", "content"])
    some = some.select("digest", (F.col("start") + F.col("at")).alias("start"), "wins")
    spans = plain.unionByName(some).groupBy("digest").agg(F.collect_list(F.struct("start", "wins")).alias("spans"))
    whole = copies.select("digest", F.lit(True).alias("whole"), F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    return written(spans.select("digest", F.lit(False).alias("whole"), "spans").unionByName(whole), "marks")


def _removed(size: int, whole, spans, length: int) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes."""
    if whole:
        return [(0, size)]
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["start"] + s["wins"] + length - 1) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def judged(docs: DataFrame, keep: list[str], name: str, text_col: str = "text", length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """The ``keep`` columns and a struct ``name``: n_bytes, n_removed, spans (start, bytes), kept_sha256 and, if asked, the text that is left."""
    found = marks(docs, text_col, length)
    hidden = [fresh(docs, x) for x in ("_digest", "_whole", "_spans", "_body")]
    digest, whole, spans, body = hidden
    rows = docs.select(*keep, F.coalesce(text_col, F.lit("")).alias(body)).withColumn(digest, _digest(F.col(body)))
    rows = rows.join(found.toDF(digest, whole, spans), digest, "left").select(*keep, body, whole, spans)
    kind = "struct<n_bytes:bigint,n_removed:bigint,spans:array<struct<start:bigint,bytes:bigint>>,kept_sha256:string,text:string>"
    span = pa.struct([("start", pa.int64()), ("bytes", pa.int64())])
    out_type = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(span)), ("kept_sha256", pa.string()), ("text", pa.string())])

    def run(batches):
        for batch in batches:
            texts, wholes, marked = (batch.column(len(keep) + i) for i in range(3))
            for low, high, data, offsets in text_blocks(texts):
                raw, out = data.tobytes(), []
                own = zip(offsets[:-1].tolist(), offsets[1:].tolist(), wholes.slice(low, high - low).to_pylist(), marked.slice(low, high - low).to_pylist(), strict=True)
                for a, b, w, s in own:
                    text = raw[a:b]
                    gone = _removed(b - a, w, s, length)
                    left = b"".join(text[x:y] for x, y in zip([0, *(g[1] for g in gone)], [*(g[0] for g in gone), b - a], strict=True)) if gone else text
                    out.append(
                        {
                            "n_bytes": b - a,
                            "n_removed": sum(y - x for x, y in gone),
                            "spans": [{"start": x, "bytes": y - x} for x, y in gone],
                            "kept_sha256": hashlib.sha256(left).hexdigest(),
                            "text": left.decode(errors="ignore") if with_text else None,
                        }
                    )
                columns = [batch.column(i).slice(low, high - low) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(out, out_type)], names=[*keep, name])

    return rows.transform(mapped, run, with_column_type(docs.select(*keep), name, kind))


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeats cut out of the text; a null text stays null."""
    name = fresh(docs, "_cut")
    flag = fresh(docs, "_null")
    rows = docs.withColumn(flag, F.col(text_col).isNull())
    rest = [c for c in rows.columns if c != text_col]
    out = judged(rows, rest, name, text_col, length, with_text=True)
    text = F.when(~F.col(flag), F.col(name)["text"])
    return out.select(*(text.alias(c) if c == text_col else F.col(c) for c in docs.columns))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("_cut")
    return judged(documents(spark, sf_dir), ["doc_id"], "_cut").select(
        "doc_id",
        s["n_bytes"].alias("n_bytes"),
        s["n_removed"].alias("n_removed"),
        F.size(s["spans"]).cast("long").alias("n_spans"),
        s["kept_sha256"].alias("kept_sha256"),
    )
