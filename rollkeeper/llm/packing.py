"""Best-fit packing by the configuration linear program over the length histogram.

Lengths are counted in classes of ``GRAIN`` tokens, rounded up. A configuration says how
many pieces of each class share a sequence; the program covers every class's count with
the fewest sequences. It is solved by multiplicative weights: a class's weight falls with
its coverage, a knapsack by dynamic programming finds the configuration of the greatest
weight, and a step of it is added, until every class is covered. Rounding takes whole
copies of each configuration, as far as pieces are left; what remains is packed best-fit,
also by counts. The histogram has at most capacity / GRAIN rows and the plan at most
``STEPS`` plus two configurations per class, so both fit the driver and a broadcast
whatever the input's size. Pieces get numbers within their class, spread over many
windows, and look their sequence up in the plan.

Null or empty text: the end id alone. Repeated rows are packed one by one. A very long text is
cut into pieces. An empty table gives no sequence. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollkeeper.llm.common import documents, mapped, numbered, text_blocks
from rollkeeper.llm.tokens import crc32s, encoder
from rollkeeper.session import written

CAPACITY = 4096
GRAIN = 4
END_ID = 1
#: Steps of the weights at most, and how much of a class one step covers: less if classes are few.
STEPS = 4000
STEP = (0.01, 0.25)
SHARPNESS = 12.0
#: Bytes of text that are cut into units at once; that holds some fifty for each, beside the tokenizer.
_BLOCK = 1 << 20
#: Part of the sequences that rounding takes from the program at most; best-fit does the rest.
TAKEN = 0.95


def public_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenised texts cut where they exceed the capacity: doc_id, piece, start, length, ids_crc32 and, if asked, ids."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        words = encoder(path)
        for batch in batches:
            for low, high, data, offsets in text_blocks(batch.column(1), _BLOCK):
                ids, counts = words.block(data, offsets, end)
                n = -(-counts // capacity)
                row = np.repeat(np.arange(high - low), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                length = np.minimum(counts[row] - piece * capacity, capacity)
                columns = [
                    batch.column(0).slice(low, high - low).take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(piece * capacity),
                    pa.array(length),
                    pa.array(crc32s(ids, length), pa.int64()),
                ]
                if with_ids:
                    raw, ends = ids.astype("<u4").tobytes(), (np.cumsum(length) * 4).tolist()
                    columns.append(pa.array([raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return docs.select(id_col, text_col).transform(mapped, run, schema)


def priced(value: np.ndarray, capacity: int) -> np.ndarray:
    """The classes (1-based, with repeats) of the most valuable configuration; value[0] is class 1's."""
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        m = min(c, len(value))
        total = value[:m] + best[c - m : c][::-1]
        k = int(total.argmax())
        if total[k] > best[c - 1]:
            best[c], pick[c] = total[k], k + 1
        else:
            best[c] = best[c - 1]
    out, c = [], capacity
    while c > 0:
        if pick[c]:
            out.append(pick[c])
        c -= max(1, pick[c])
    return np.array(out, np.int64)


def solve(counts: np.ndarray, steps: int = STEPS) -> list[tuple[dict[int, int], float]]:
    """Configurations (class -> pieces) and how often each is used, covering ``counts`` (by class, from 1) in fractions."""
    capacity = len(counts)
    open_ = counts > 0
    covered = np.where(open_, 0.0, 1.0)
    used: dict[tuple, float] = {}
    need = np.where(open_, counts, 1).astype(float)
    part = min(max(4 * int(open_.sum()) / steps, STEP[0]), STEP[1])
    for _ in range(steps):
        least = covered.min()
        if least >= 1:
            break
        weight = np.where(open_ & (covered < 1), np.exp(-SHARPNESS * (covered - least)), 0)
        chosen, copies = np.unique(priced(weight / need, capacity), return_counts=True)
        if not len(chosen):
            break
        step = part * (need[chosen - 1] / copies).min()
        covered[chosen - 1] += step * copies / need[chosen - 1]
        key = tuple(zip(chosen.tolist(), copies.tolist(), strict=True))
        used[key] = used.get(key, 0.0) + step
    return [(dict(k), x) for k, x in used.items()]


def filled(config: dict[int, int], left: np.ndarray, n: int) -> dict[int, int]:
    """``config`` with its room filled best-fit from what is ``left``, as far as it is there for ``n`` copies."""
    config, free = dict(config), left // n
    for c, k in config.items():
        free[c - 1] -= k
    room = len(left) - sum(c * k for c, k in config.items())
    while room and len(fits := np.flatnonzero(free[:room] > 0)):
        c = int(fits[-1]) + 1
        k = min(int(free[c - 1]), room // c)
        config[c], room = config.get(c, 0) + k, room - k * c
        free[c - 1] -= k
    return config


def rounded(counts: np.ndarray, fractions: list[tuple[dict[int, int], float]]) -> list[tuple[dict[int, int], int]]:
    """Whole copies of the configurations, their room filled, then best-fit of what is left; together they hold exactly ``counts``."""
    left, out = counts.astype(np.int64).copy(), []

    def take(config: dict[int, int], most: int):
        n = min(most, *(int(left[c - 1]) // k for c, k in config.items()))
        if n > 0:
            config = filled(config, left, n)
            for c, k in config.items():
                left[c - 1] -= n * k
            out.append((config, n))

    # The program may cover some classes twice; with all of it taken, small pieces would run out before large ones.
    bound = float((np.arange(1, len(counts) + 1) * counts).sum()) / len(counts)
    part = min(1.0, TAKEN * bound / max(sum(x for _, x in fractions), 1e-9))
    for config, x in sorted(fractions, key=lambda p: -p[1]):
        take(config, int(x * part))
    while left.any():
        first = filled({}, left, 1)
        take(first, int(left.sum()))
    return out


class Plan:
    """Which sequence holds piece number r of class c."""

    def __init__(self, configs: list[tuple[dict[int, int], int]]):
        rows, first = [], 0
        seen: dict[int, int] = {}
        for config, n in configs:
            for c, k in sorted(config.items(), reverse=True):
                rows.append((c, seen.get(c, 0), first, k))
                seen[c] = seen.get(c, 0) + n * k
            first += n
        self.sequences = first
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.key = (table[:, 0] << 44) | table[:, 1]
        self.from_, self.first, self.each = table[:, 1], table[:, 2], table[:, 3]

    def sequence(self, size_class: np.ndarray, number: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.key, (size_class << 44) | number, "right") - 1
        return self.first[at] + (number - self.from_[at]) // self.each[at]


def pack(cut: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """``cut`` (with a ``length`` up to the capacity) plus ``sequence_id`` and ``offset``."""
    spark = cut.sparkSession
    rows = written(
        cut.withColumn("_class", F.ceil(F.col("length") / grain).cast("long")).withColumn("_place", F.monotonically_increasing_id()),
        "pieces",
    )
    counts = np.zeros(-(-capacity // grain), np.int64)
    for c, n in rows.groupBy("_class").count().collect():
        counts[c - 1] = n
    shared = spark.sparkContext.broadcast(Plan(rounded(counts, solve(counts))))
    ranked = numbered(rows, ["_class"], "_number", "_place")

    def run(batches):
        plan = shared.value
        for batch in batches:
            size_class, number = (batch.column(batch.schema.names.index(c)).to_numpy() for c in ("_class", "_number"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(plan.sequence(size_class, number))], names=[*batch.schema.names, "sequence_id"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields)
    placed = ranked.transform(mapped, run, f"{schema}, sequence_id bigint")
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "_place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("_class", "_place", "_number")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces that carry ``ids``: sequence_id, ids (binary, 32-bit), its pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return grouped.select(
        "sequence_id",
        F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"], p["length"])).alias("pieces"),
    )


def pack_documents(docs: DataFrame, path: str) -> DataFrame:
    return pack(pieces(docs, path)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack_documents(documents(spark, sf_dir), public_path())
