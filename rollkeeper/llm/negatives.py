"""Hard negatives by Four-Russians scoring: subset-sum tables of the anchors, bit planes of the candidates.

Components are integers. For each group of eight dimensions an anchor gets a table of the sums
of every subset of its eight components, 256 of them. A candidate's components are cut into
bit planes (two's complement, the sign plane counts negative); the eight bits of a plane and
group are one byte, and this byte is the place in the table. So a plane's part of the inner
product is one lookup a group, and the planes are added up by doubling from the highest down.
The scores are whole and exact; nothing is estimated or left out.

Anchors are written by tasks as files and searched in blocks of bounded size, each block in
passes of its own over all rows. A first pass scores rows of the anchor's label and gives the
positives; a second one scores rows of other labels and gives, for each positive, the first
rows of its band. A task keeps the best few of each anchor, and Spark ranks what the tasks
give: a label or a vector that a third of the rows have makes no task larger.

Rows with a null label, a null vector, or a null or non-finite component take no part. A row
without id is a candidate, after all others among ties, but no anchor. Shorter vectors count
as if zeros followed. Of rows that repeat an anchor's id, the one of the least label and
vector is the anchor, and none of them is a candidate for it; other repeated rows are
candidates one by one. Scores that don't fit 64 bits are an error. An empty table gives an
empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollkeeper.llm.common import mapped
from rollkeeper.llm.files import located, new_folder, own_name
from rollkeeper.session import written

POSITIVES = 5
NEGATIVES = 5
SCALE = 256
#: A negative's score is in these hundredths of the positive's.
BAND = (80, 100)
#: Bytes of anchors' components (8 each) that one pass over the rows searches for.
BLOCK_BYTES = 32 << 20
#: Bytes of subset sums that are held at a time, and scores.
TABLE_BYTES = 4 << 20
_SCORES = 1 << 18
_GROUP = 8
_LEAST = np.iinfo(np.int64).min


def integers(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a vector of finite components, and these rows' floor(scale * x), zeros behind the shorter ones."""
    column = column.cast(pa.large_list(column.type.value_type))
    lengths = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    values = column.flatten()
    null = np.asarray(values.is_null())
    x = np.asarray(values.fill_null(0)).astype(np.float64)
    wrong = null | ~np.isfinite(x)
    row = np.repeat(np.arange(len(lengths)), lengths)
    whole = np.asarray(column.is_valid()) & (np.bincount(row[wrong], minlength=len(lengths)) == 0)
    x = np.floor(scale * np.where(wrong, 0, x))
    if len(x) and np.abs(x[whole[row]]).max(initial=0) >= 2.0**62:
        raise ValueError("components don't fit 64 bits")
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    place = np.arange(len(row)) - (np.cumsum(lengths) - lengths)[row]
    out[row, place] = np.where(whole[row], x, 0).astype(np.int64)
    return whole, out[whole]


def bit_planes(x: np.ndarray) -> np.ndarray:
    """Rows of components as bytes: plane (the last is the sign's), group of eight dimensions, row."""
    n, width = x.shape
    groups = -(-width // _GROUP)
    padded = np.zeros((n, groups * _GROUP), np.int64)
    padded[:, :width] = x
    planes = 1 + max(int(x.max(initial=0)).bit_length(), int(~x.min(initial=0)).bit_length())
    out = np.empty((planes, groups, n), np.uint8)
    for p in range(planes):
        bits = ((padded >> p) & 1).astype(np.uint8)
        out[p] = np.packbits(bits, axis=1, bitorder="little").T
    return out


class Tables:
    """The subset sums of some anchors: group, subset, anchor."""

    def __init__(self, anchors: np.ndarray, planes: int):
        n, width = anchors.shape
        groups = -(-width // _GROUP)
        # no sum on the way exceeds the sum of all sizes, shifted by every plane
        most = max((sum(map(abs, row)) for row in anchors.tolist()), default=0) << planes
        if most >> 62:
            raise ValueError("scores don't fit 64 bits")
        kind = np.int32 if not most >> 30 else np.int64
        padded = np.zeros((n, groups * _GROUP), kind)
        padded[:, :width] = anchors
        self.sums = np.zeros((groups, 1 << _GROUP, n), kind)
        for j in range(_GROUP):
            held = 1 << j
            self.sums[:, held : 2 * held] = self.sums[:, :held] + padded[:, j::_GROUP].T[:, None, :]

    def scores(self, planes: np.ndarray) -> np.ndarray:
        """Inner products of rows given as bit planes with all anchors; planes beyond either's groups are zeros."""
        n, width = planes.shape[2], self.sums.shape[2]
        total = np.zeros((n, width), self.sums.dtype)
        one = np.empty_like(total)
        for p in range(len(planes) - 1, -1, -1):
            if p < len(planes) - 1:
                total <<= 1
            for table, byte in zip(self.sums, planes[p], strict=False):
                np.take(table, byte, axis=0, out=one, mode="clip")
                if p == len(planes) - 1:
                    total -= one
                else:
                    total += one
        return total


class Best:
    """The first ``k`` rows of each slot: the highest score, then the smallest id, null last."""

    def __init__(self, slots: int, k: int):
        self.k, self.least = k, np.full(slots, _LEAST)
        self.held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)]
        self.waiting: list[list[np.ndarray]] = []
        self.size = 0

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        self.waiting.append([slot, score, ids, null])
        self.size += len(slot)
        if self.size > max(_SCORES, 4 * len(self.held[0])):
            self.settle()

    def settle(self) -> list[np.ndarray]:
        if self.waiting:
            slot, score, ids, null = (np.concatenate(c) for c in zip(self.held, *self.waiting, strict=True))
            by = np.lexsort((ids, null, -score, slot))
            head = np.searchsorted(slot[by], slot[by])
            by = by[np.arange(len(by)) - head < self.k]
            self.held = [slot[by], score[by], ids[by], null[by]]
            last = np.flatnonzero(np.bincount(self.held[0], minlength=len(self.least)) == self.k)
            ends = np.searchsorted(self.held[0], last, "right") - 1
            self.least[last] = self.held[1][ends]
            self.waiting, self.size = [], 0
        return self.held


class Anchors:
    """A block of anchors, by label; ``bands`` as (anchor, slot) limits of scores, where they have positives."""

    def __init__(self, paths: list[str]):
        tables = [_read(path) for path in paths]
        width = max((t.column("x").chunk(0).type.list_size for t in tables if len(t)), default=0)
        x = [np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (_matrix(t) for t in tables)]
        label = np.concatenate([np.asarray(t.column("label")) for t in tables])
        by = np.argsort(label, kind="stable")
        self.x, self.label = np.concatenate(x)[by], label[by]
        self.ids = np.concatenate([np.asarray(t.column("id")) for t in tables])[by]
        if "scores" in tables[0].column_names:
            scores = [s for t in tables for s in t.column("scores").to_pylist()]
            self.scores = [scores[k] for k in by.tolist()]

    def groups(self) -> Iterator[tuple[int, int]]:
        """Runs of anchors of one label whose tables stay in bounds."""
        step = max(1, TABLE_BYTES // (4 * 32 * max(1, self.x.shape[1])))
        edges = [0, *(np.flatnonzero(np.diff(self.label)) + 1).tolist(), len(self.label)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            for at in range(low, high, step):
                yield at, min(at + step, high)


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("x").combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), column.type.list_size)


def _read(path: str) -> pa.Table:
    store, place = located(path)
    with store.open_input_file(place) as stream:
        return pa.ipc.open_file(stream).read_all().combine_chunks()


def anchor_blocks(anchors: DataFrame, limit: int = BLOCK_BYTES) -> list[list[str]]:
    """``anchors`` (id, label, x, and scores if they have positives) as lists of files of about ``limit`` bytes of components together."""
    folder = new_folder(anchors.sparkSession, "anchors")

    def run(batches):
        number = 0
        for batch in batches:
            lengths = np.asarray(batch.column(2).value_lengths()).astype(np.int64)
            width = max(1, int(lengths.max(initial=0)))
            step = max(1, limit // (8 * width))
            for low in range(0, batch.num_rows, step):
                part = pa.table(batch.slice(low, step))
                x = np.zeros((len(part), width), np.int64)
                for k, row in enumerate(part.column("x").to_pylist()):
                    x[k, : len(row)] = row
                part = part.set_column(2, "x", pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width))
                path = own_name(folder, number, ".arrow")
                number += 1
                store, place = located(path)
                with store.open_output_stream(place, compression=None) as stream, pa.ipc.new_file(stream, part.schema) as out:
                    out.write_table(part.combine_chunks())
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([8 * width * len(part)])], names=["path", "size"])

    blocks, room = [], 0
    for r in written(anchors.transform(mapped, run, "path string, size bigint"), "anchor-files").orderBy("path").collect():
        if r["size"] > room or not blocks:
            blocks.append([])
            room = limit
        blocks[-1].append(r["path"])
        room -= r["size"]
    return blocks


def _batches(batches, scale: int) -> Iterator[tuple]:
    """Ids, where they are null, labels and components of the rows that take part."""
    for batch in batches:
        whole, x = integers(batch.column(2), scale)
        ids, label = batch.column(0), batch.column(1)
        kept = np.flatnonzero(whole & np.asarray(label.is_valid()))
        x = x[np.asarray(label.is_valid())[whole]]
        null = np.asarray(ids.is_null())[kept]
        yield np.asarray(ids.fill_null(0)).astype(np.int64)[kept], null, np.asarray(label.fill_null(0)).astype(np.int64)[kept], x


def _scored(rows: tuple, anchors: Anchors, same: bool) -> Iterator[tuple]:
    """Scores of the rows of an anchor's label, or of other labels: first anchor, scores (row, anchor), ids, null."""
    ids, null, label, x = rows
    planes = bit_planes(x)
    for low, high in anchors.groups():
        tables = Tables(anchors.x[low:high], len(planes))
        fit = np.flatnonzero((label == anchors.label[low]) == same)
        step = max(1, _SCORES // (high - low))
        for at in range(0, len(fit), step):
            some = fit[at : at + step]
            yield low, high, tables.scores(planes[:, :, some]), ids[some], null[some]


def _positives(rows: DataFrame, paths: list[str], k: int, scale: int) -> DataFrame:
    """The first ``k`` rows of each anchor's label that a task has: anchor, score, id."""

    def run(batches):
        anchors = Anchors(paths)
        best = Best(len(anchors.ids), k)
        for part in _batches(batches, scale):
            for low, high, scores, ids, null in _scored(part, anchors, True):
                wanted = (scores >= best.least[low:high]) & ((ids[:, None] != anchors.ids[low:high]) | null[:, None])
                row, col = np.nonzero(wanted)
                best.add(low + col, scores[row, col].astype(np.int64), ids[row], null[row])
        slot, score, ids, null = best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(anchors.ids[slot]), pa.array(score), pa.array(ids, mask=null)], names=["anchor", "score", "id"])

    return rows.transform(mapped, run, "anchor bigint, score bigint, id bigint")


def _negatives(rows: DataFrame, paths: list[str], k: int, scale: int, band: tuple[int, int]) -> DataFrame:
    """The first ``k`` rows of other labels in each positive's band that a task has: anchor, place of the positive, score, id."""

    def run(batches):
        anchors = Anchors(paths)
        width = max(map(len, anchors.scores))
        # the scores allowed: from low to high, empty where there is no such positive
        low_ = np.full((len(anchors.ids), width), np.iinfo(np.int64).max)
        high_ = np.full((len(anchors.ids), width), _LEAST)
        for a, scores in enumerate(anchors.scores):
            for j, s in enumerate(scores):
                low_[a, j], high_[a, j] = -((-band[0] * s) // 100), band[1] * s // 100
        best = Best(low_.size, k)
        for part in _batches(batches, scale):
            for low, high, scores, ids, null in _scored(part, anchors, False):
                floor = np.maximum(low_[low:high], best.least.reshape(low_.shape)[low:high])
                row, col = np.nonzero((scores >= floor.min(axis=1)) & (scores <= high_[low:high].max(axis=1)))
                score = scores[row, col].astype(np.int64)
                for j in range(width):
                    own = np.flatnonzero((score >= floor[col, j]) & (score <= high_[low + col, j]))
                    best.add((low + col[own]) * width + j, score[own], ids[row[own]], null[row[own]])
        slot, score, ids, null = best.settle()
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchors.ids[slot // width]), pa.array(slot % width), pa.array(score), pa.array(ids, mask=null)],
            names=["anchor", "place", "score", "id"],
        )

    return rows.transform(mapped, run, "anchor bigint, place bigint, score bigint, id bigint")


def _anchors(rows: DataFrame, scale: int) -> DataFrame:
    """id, label and components of each anchor, one for each id."""

    def run(batches):
        for ids, _, label, x in _batches(batches, scale):
            x = pa.ListArray.from_arrays(np.arange(0, x.size + 1, max(1, x.shape[1]), dtype=np.int32)[: len(ids) + 1] if x.size else np.zeros(len(ids) + 1, np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(label), x], names=["id", "label", "x"])

    found = rows.transform(mapped, run, "id bigint, label bigint, x array<bigint>")
    return found.groupBy("id").agg(F.min(F.struct("label", "x")).alias("_row")).select("id", "_row.label", "_row.x")


def _first(parts: list[DataFrame], by: list[str], k: int) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label: str | Column = "label",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    scale: int = SCALE,
    band: tuple[int, int] = BAND,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    label = F.col(label) if isinstance(label, str) else label
    facts = [F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).alias("x")]
    rows = vectors.select(*facts)
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    anchors = written(_anchors(vectors.filter(is_anchor & F.col(id_col).isNotNull()).select(*facts), scale), "anchor-rows")
    blocks = anchor_blocks(anchors, block_bytes)
    if not blocks:
        return vectors.sparkSession.createDataFrame([], schema)
    near = written(_first([_positives(rows, b, positives, scale) for b in blocks], ["anchor"], positives), "positives")
    places = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("scores"))
    places = anchors.join(places, anchors.id == places.anchor).select("id", "label", "x", F.col("scores.score").alias("scores"))
    blocks = anchor_blocks(places, block_bytes)
    if not blocks:
        return vectors.sparkSession.createDataFrame([], schema)
    far = [_negatives(rows, b, negatives, scale, band) for b in blocks]
    far = _first(far, ["anchor", "place"], negatives).withColumn("place", F.col("place") + 1)
    near = near.select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(near, ["anchor", "place"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, label=label)


SQL = {
    "op11_negatives": """
WITH v AS (
    SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT a.vec_id AS anchor_id, c.k, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM a.vec_id
),
positives AS (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id NULLS LAST) AS place FROM scores WHERE same
),
met AS (
    SELECT p.anchor_id, p.place, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY n.score DESC, n.vec_id NULLS LAST)::INTEGER AS rank
    FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    WHERE p.place <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM met WHERE rank <= 5
"""
}
