"""Brown class-based bigrams: P(word | word before) = P(class | class before) * P(word | class).

Every word has one class. The most frequent words get theirs by exchange clustering: a word
moves to the class that raises the likelihood of the class bigrams most. A round counts,
over all training documents, each such word's neighbours by class (Spark), and then moves
word after word on these counts (at most ``EXCHANGED * 2 * CLASSES`` numbers, whatever the
corpus). Rounds end when the likelihood no longer grows; the best round counts. All other
words of the training documents begin with the class that words with their last two bytes have
most often, and are then exchanged by Spark: each one's neighbours by class are counted and
meet in a task, which moves one after the other. It doesn't see what the other tasks move, so
it takes its words, dealt out by hash, for a sample of all, and what they change for as much
more as all of them are. Where that doesn't raise the likelihood, as counted thereafter, they
go by parts, up to ``PARTS`` of them. Words that training hasn't seen keep the class of their ending.
The end of a text is a word and a class of its own, and stands before each first word.

Class transitions are interpolated with class frequencies; within a class a word counts its
occurrences plus ``DELTA``, and one more word stands for all unknown ones.

Counts are exact over all training documents. Words are told by a 64-bit hash. The most
frequent ``KEPT`` words are broadcast with their counts; all rarer tokens look theirs up by
a join. Documents are turned into numbers once and stored.

Null or empty text: the end alone. A null doc_id counts as the empty text, which trains.
Repeated rows count, and are scored, one by one. Without training documents every word is
unknown. A very long text is one sequence like any other. An empty table gives an empty result.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeeper.llm.common import documents, GRAPH, LOWER, mapped, text_blocks, word_bounds, word_hashes
from rollkeeper.session import steps_of_a_run, written

CLASSES = 32
EXCHANGED = 8192
KEPT = 1 << 18
ROUNDS = 8
#: Parts, at most, in which the words beyond the most frequent are exchanged.
PARTS = 2
#: Of these, how many a task judges as a sample of all.
SAMPLE = 8192
#: Steps of log2 of the counts, to find how many a word needs to be kept.
STEPS = 16
DELTA = 0.5
BACK_OFF = 50.0
ENDINGS = 1 << 16
#: Bytes of text taken at once: hashing needs some 60 bytes for each, and as much stays with a worker until it ends.
_BLOCK = 1 << 20
#: Bytes of numbers taken at once.
_NUMBERS = 1 << 21


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of a block, their endings (last two bytes), and each text's first word."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, GRAPH)
    last = data[ends - 1].astype(np.int64)
    before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.int64)
    return word_hashes(data, starts, ends), (before << 8) | last, first


def vocabulary(train: DataFrame) -> DataFrame:
    """``train`` (text) -> hash, ending, c of every word; stored. A task sends each word of its share once."""

    def folded(parts):
        hashes, endings, counts = map(np.concatenate, zip(*parts, strict=True))
        order = np.argsort(hashes)
        hashes = hashes[order]
        head = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
        return (hashes[head], endings[order[head]], np.add.reduceat(counts[order], head)) if len(head) else (hashes, endings, counts)

    def run(batches):
        known, held, size = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)), [], 0
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0), _BLOCK):
                h, e, _ = tokens(data, offsets)
                held.append(folded([(h, e, np.ones(len(h), np.int64))]))
                size += len(held[-1][0])
                if size >= len(known[0]):
                    known, held, size = folded([known, *held]), [], 0
        hashes, endings, counts = folded([known, *held])
        for k in range(0, len(hashes), 100_000):
            some = slice(k, k + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[some].view(np.int64)), pa.array(endings[some].astype(np.int32)), pa.array(counts[some])], names=["hash", "ending", "c"]
            )

    rows = train.transform(mapped, run, "hash bigint, ending int, c bigint")
    return written(rows.groupBy("hash").agg(F.first("ending").alias("ending"), F.sum("c").alias("c")), "vocabulary")


class Words:
    """The kept words by frequency (numbers 1, 2, ...; 0 is the end), and totals of all."""

    def __init__(self, words: DataFrame, ends: int, kept: int):
        step = F.floor(F.log2("c") * STEPS)
        sizes = words.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c"))
        sizes = sorted(((r.s, r.n, r.c) for r in sizes.collect()), reverse=True)
        self.n = ends + sum(c for _, _, c in sizes)
        self.v = (ends > 0) + sum(n for _, n, _ in sizes)
        taken, self.least_step = 0, (sizes[0][0] + 1 if sizes else 0)
        for s, n, _ in sizes:
            if taken + n > kept:
                break
            taken, self.least_step = taken + n, s
        is_kept = step >= self.least_step
        table = words.filter(is_kept).select("hash", "ending", "c").toArrow()
        hashes, endings, counts = (table.column(k).to_numpy() for k in ("hash", "ending", "c"))
        order = np.lexsort((hashes, -counts))
        self.hashes, self.endings, self.counts = hashes[order].view(np.uint64), endings[order].astype(np.int64), np.append(ends, counts[order])
        self.by_hash = np.argsort(self.hashes)
        self.sorted = self.hashes[self.by_hash]
        rest = words.filter(~is_kept)
        self.rare_n, self.rare_v = np.zeros(ENDINGS), np.zeros(ENDINGS)
        for r in rest.groupBy("ending").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
            self.rare_n[r.ending], self.rare_v[r.ending] = r.c, r.v
        self.rare = rest.select("hash", "c")

    def lookup(self) -> tuple[np.ndarray, np.ndarray]:
        return self.sorted, self.by_hash + 1


def numbered_texts(docs: DataFrame, words: Words, id_col: str, text_col: str) -> DataFrame:
    """doc_id, place, held_out, ids, rare; stored. ids (32-bit): kept words, or behind them the ending; rare: hashes of the latter."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(words.lookup())
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        known, number = shared.value
        for batch in batches:
            for low, high, data, offsets in text_blocks(batch.column(2), _BLOCK):
                h, ending, first = tokens(data, offsets)
                order = np.argsort(h)
                at = np.searchsorted(known, h[order])
                found = np.zeros(len(h), bool)
                if len(known):
                    at = np.minimum(at, len(known) - 1)
                    found = known[at] == h[order]
                ids = (ending + len(known) + 1).astype(np.uint32)
                ids[order[found]] = number[at[found]]
                rare = np.ones(len(h), bool)
                rare[order[found]] = False
                upto = np.concatenate([[0], np.cumsum(rare)])[first]
                raw = np.insert(ids, first[1:], np.uint32(0)).astype("<u4").tobytes()
                ends = ((first + np.arange(len(first))) * 4).tolist()
                hashes = h[rare].astype("<u8").tobytes()
                spots = (upto * 8).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(1).slice(low, high - low),
                        pa.array([raw[a:b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary()),
                        pa.array([hashes[a:b] for a, b in zip(spots, spots[1:], strict=False)], pa.binary()),
                    ],
                    names=["doc_id", "held_out", "ids", "rare"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    rows = rows.transform(mapped, run, f"doc_id {kind}, held_out boolean, ids binary, rare binary")
    return written(rows.withColumn("place", F.monotonically_increasing_id()), "numbered")


def _cuts(batch: pa.RecordBatch, limit: int):
    """Runs of whole documents with about ``limit`` bytes of ids: first row, row after the last."""
    ends = np.cumsum(pc.binary_length(batch.column(batch.schema.names.index("ids"))).to_numpy(), dtype=np.int64)
    low = 0
    while low < batch.num_rows:
        upto = (ends[low - 1] if low else 0) + limit
        high = max(low + 1, int(np.searchsorted(ends, upto, "right")))
        yield low, high
        low = high


def _streams(batch: pa.RecordBatch):
    """The ids of some documents, one after the other, and how many each has."""
    column = batch.column(batch.schema.names.index("ids"))
    for low, high in _cuts(batch, _NUMBERS):
        raw = column.slice(low, high - low).to_pylist()
        yield low, np.frombuffer(b"".join(raw), "<u4").astype(np.int64), np.array([len(x) // 4 for x in raw], np.int64)


def class_counts(texts: DataFrame, classes: np.ndarray, exchanged: int, n_classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Over all ``texts``: bigrams of classes, and for each exchanged word the classes before and behind it."""
    shared = texts.sparkSession.sparkContext.broadcast(classes)
    cells = 2 * n_classes

    def run(batches):
        own = shared.value
        pairs = np.zeros(n_classes * n_classes, np.int64)
        near = np.zeros((exchanged + 1) * cells, np.int64)
        for batch in batches:
            for _, ids, _ in _streams(batch):
                kind = own[ids]
                pairs += np.bincount(np.append(0, kind[:-1]) * n_classes + kind, minlength=len(pairs))
                at = np.flatnonzero((ids > 0) & (ids <= exchanged))  # never the last one, which is an end
                before = np.where(at > 0, kind[at - 1], 0)
                near += np.bincount(ids[at] * cells + before, minlength=len(near))
                near += np.bincount(ids[at] * cells + n_classes + kind[at + 1], minlength=len(near))
        total = np.concatenate([pairs, near])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])

    rows = texts.select("ids").transform(mapped, run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(n_classes * n_classes + (exchanged + 1) * cells)
    total[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    pairs, near = total[: n_classes * n_classes], total[n_classes * n_classes :].reshape(-1, 2, n_classes)
    return pairs.reshape(n_classes, n_classes), near[:, 0], near[:, 1]


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(pairs: np.ndarray) -> float:
    """Log-likelihood of the training text, but for what does not depend on the classes."""
    return float(_f(pairs).sum() - _f(pairs.sum(axis=1)).sum() - _f(pairs.sum(axis=0)).sum())


def exchange(classes: np.ndarray, pairs: np.ndarray, before: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """One round: each exchanged word (1, 2, ...) to the class of the greatest likelihood, given where the others were counted."""
    classes, m = classes.copy(), pairs.copy()
    n = len(m)
    diagonal = np.arange(n)
    for w in range(1, len(before)):
        left, right = before[w], behind[w]
        if not left.any():
            continue
        old = classes[w]
        m[old] -= right
        m[:, old] -= left
        np.maximum(m, 0, out=m)
        rows, columns = m.sum(axis=1), m.sum(axis=0)
        base = _f(m)
        gain = (_f(m + right) - base).sum(axis=1) + (_f(m + left[:, None]) - base).sum(axis=0)
        corner = m[diagonal, diagonal]
        gain += _f(corner + left + right) - _f(corner + right) - _f(corner + left) + _f(corner)
        gain -= _f(rows + right.sum()) - _f(rows) + _f(columns + left.sum()) - _f(columns)
        gain[0] = -np.inf  # the end stays alone
        new = int(gain.argmax())
        if gain[new] <= gain[old] + 1e-9:
            new = old
        classes[w] = new
        m[new] += right
        m[:, new] += left
    return classes


def by_ending(words: Words, classes: np.ndarray, exchanged: int, n_classes: int) -> np.ndarray:
    """The classes of all numbers: exchanged words as given, others by their ending."""
    top = min(exchanged, len(words.endings))
    weight = np.zeros((ENDINGS, n_classes))
    np.add.at(weight, (words.endings[:top], classes[1 : top + 1]), words.counts[1 : top + 1])
    last = weight.reshape(256, 256, n_classes).sum(axis=0)
    total = weight.sum(axis=0)
    own = np.where(weight.any(axis=1), weight.argmax(axis=1), 0)
    short = np.where(last.any(axis=1), last.argmax(axis=1), max(1, int(total[1:].argmax()) + 1))
    own = np.where(own > 0, own, np.tile(short, 256))
    out = np.concatenate([[0], own[words.endings], own])
    out[1 : top + 1] = classes[1 : top + 1]
    return out


def clustered(texts: DataFrame, words: Words, exchanged: int = EXCHANGED, n_classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all numbers, and the bigrams of classes, after the best round."""
    top = min(exchanged, len(words.endings))
    start = np.zeros(top + 1, np.int64)
    start[1:] = 1 + (words.endings[:top] * 40503 >> 4) % (n_classes - 1)  # by ending, to begin with
    classes = by_ending(words, start, exchanged, n_classes)
    best = None
    for _ in range(rounds + 1):
        pairs, before, behind = class_counts(texts, classes, top, n_classes)
        now = likelihood(pairs)
        if best and now <= best[0] + 1e-4 * abs(best[0]):
            return best[1:] if now <= best[0] else (classes, pairs)
        best = now, classes, pairs
        classes = by_ending(words, exchange(classes[: top + 1], pairs, before, behind), exchanged, n_classes)
    return best[1:]


def rest_counts(texts: DataFrame, words: Words, classes: np.ndarray, exchanged: int, n_classes: int) -> DataFrame:
    """hash, cells of each word beyond the exchanged ones; cells: how often (n) each code occurs.

    A code tells whether the word isn't kept, its class, and the classes before and behind it.
    """
    shared = texts.sparkSession.sparkContext.broadcast((classes, words.hashes))

    def run(batches):
        own, hashes = shared.value
        known = len(hashes)
        for batch in batches:
            column = batch.column(batch.schema.names.index("rare"))
            for k, ids, counts in _streams(batch):
                kind = own[ids]
                at = np.flatnonzero(ids > exchanged)  # never the last one, which is an end
                far = ids[at] > known
                word = np.empty(len(at), np.uint64)
                word[far] = np.frombuffer(b"".join(column.slice(k, len(counts)).to_pylist()), "<u8")
                word[~far] = hashes[ids[at[~far]] - 1]
                before = np.where(at > 0, kind[at - 1], 0)
                code = ((far * n_classes + kind[at]) * n_classes + before) * n_classes + kind[at + 1]
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(code.astype(np.int32))], names=["hash", "code"])

    rows = texts.select("ids", "rare").transform(mapped, run, "hash bigint, code int").groupBy("hash", "code").agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy("hash").agg(F.collect_list(F.struct("code", "n")).alias("cells"))


def moved(old: np.ndarray, left: np.ndarray, right: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The class of the greatest likelihood for each of some words, given their neighbours by class, as if it moved alone.

    Sums run over the neighbours that a word has; what it adds to its present class is taken off first.
    """
    some = np.arange(len(old))
    gain = np.zeros(left.shape)
    for near, other, m in ((right, left, pairs.T), (left, right, pairs)):
        word, cls = np.nonzero(near)
        n = near[word, cls][:, None]
        base = m[cls].astype(float)  # row: the neighbour's class; column: the class that is tried
        base[np.arange(len(word)), old[word]] -= n[:, 0]
        base -= np.where((cls == old[word])[:, None], other[word], 0)
        np.maximum(base, 0, out=base)
        np.add.at(gain, word, _f(base + n) - _f(base))
    own = np.zeros(left.shape)
    own[some, old] = 1
    corner = np.maximum(np.diagonal(pairs) - own * (left + right), 0)
    gain += _f(corner + left + right) - _f(corner + right) - _f(corner + left) + _f(corner)
    for near, other, total in ((right, left, pairs.sum(axis=1)), (left, right, pairs.sum(axis=0))):
        n = near.sum(axis=1, keepdims=True)
        base = np.maximum(total - other - own * n, 0)
        gain -= _f(base + n) - _f(base)
    gain[:, 0] = -np.inf  # the end stays alone
    new = gain.argmax(axis=1)
    return np.where(gain[some, new] > gain[some, old] + 1e-9, new, old)


def moved_in_turn(old: np.ndarray, left: np.ndarray, right: np.ndarray, pairs: np.ndarray, share: float, steps: int = 64) -> np.ndarray:
    """``moved`` for some words in steps, each judged on the counts that those before it would leave if for each
    word of them ``share`` words did the same: these words are a sample, by hash, of all that move at once."""
    new, m = old.copy(), pairs.astype(float)
    some = max(1, -(-len(old) // steps))
    for k in range(0, len(old), some):
        part = slice(k, k + some)
        new[part] = moved(old[part], left[part], right[part], m)
        np.add.at(m, old[part], -share * right[part])
        np.add.at(m.T, old[part], -share * left[part])
        np.add.at(m, new[part], share * right[part])
        np.add.at(m.T, new[part], share * left[part])
        np.maximum(m, 0, out=m)
    return new


def rest_classes(
    texts: DataFrame, words: Words, classes: np.ndarray, pairs: np.ndarray, exchanged: int, parts: int = 1, turn: int = 0
) -> DataFrame:
    """hash, far (not kept), cls, c of every training word beyond the exchanged ones, after one move of each of this part; stored."""
    n_classes = len(pairs)
    all_words = words.v - 1 - min(exchanged, len(words.hashes))
    shared = texts.sparkSession.sparkContext.broadcast(pairs)

    def judged(some: pa.Table) -> pa.RecordBatch:
        cells = some.column("cells").combine_chunks()
        flat = cells.flatten()
        code, n = flat.field("code").to_numpy().astype(np.int64), flat.field("n").to_numpy()
        ends = cells.offsets.to_numpy() - cells.offsets[0].as_py()
        word = np.repeat(np.arange(len(some)), np.diff(ends))
        left, right = (np.bincount(word * n_classes + c, n, len(some) * n_classes).reshape(-1, n_classes) for c in (code // n_classes % n_classes, code % n_classes))
        head = code[ends[:-1]] // n_classes**2
        ours = np.flatnonzero(some.column("hash").to_numpy().view(np.uint64) % np.uint64(parts) == turn)
        new = head % n_classes
        new[ours] = moved_in_turn(new[ours], left[ours], right[ours], shared.value, all_words / len(some))
        made = [some.column("hash").combine_chunks(), pa.array(head >= n_classes), pa.array(new.astype(np.int32)), pa.array(np.add.reduceat(n, ends[:-1]))]
        return pa.RecordBatch.from_arrays(made, names=["hash", "far", "cls", "c"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= SAMPLE:
                yield judged(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield judged(pa.Table.from_batches(held))

    counted = rest_counts(texts, words, classes, exchanged, n_classes)
    return written(counted.transform(mapped, run, "hash bigint, far boolean, cls int, c bigint"), "rest-classes")


def _rare_words(batches):
    """place, hash, m: the words of each text that aren't kept, and how often it has them."""
    for batch in batches:
        for place, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            h, n = np.unique(np.frombuffer(raw, "<i8"), return_counts=True)
            if len(h):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), place)), pa.array(h), pa.array(n)], names=["place", "hash", "m"])


def recoded(texts: DataFrame, words: Words, far: DataFrame) -> DataFrame:
    """``texts`` with a number for the class of each word in ``far`` (hash, cls) in place of its ending's; stored."""
    begin = len(words.hashes) + 1 + ENDINGS
    found = texts.select("place", "rare").transform(mapped, _rare_words, "place bigint, hash bigint, m bigint").join(far, "hash")
    found = found.groupBy("place").agg(F.collect_list(F.struct("hash", "cls")).alias("found"))

    def run(batches):
        for batch in batches:
            ids_at, rare_at, found_at = (batch.schema.names.index(c) for c in ("ids", "rare", "found"))
            for some in (batch.slice(low, high - low) for low, high in _cuts(batch, _NUMBERS)):
                out = []
                for ids, rare, cells in zip(some.column(ids_at).to_pylist(), some.column(rare_at).to_pylist(), some.column(found_at), strict=True):
                    if cells.is_valid:
                        hashes, cls = (np.asarray(cells.values.field(c)) for c in ("hash", "cls"))
                        order = np.argsort(hashes)
                        hashes, cls = hashes[order], cls[order]
                        asked = np.frombuffer(rare, "<i8")
                        at = np.minimum(np.searchsorted(hashes, asked), len(hashes) - 1)
                        numbers = np.frombuffer(ids, "<u4").copy()
                        spots = np.flatnonzero(numbers >= begin - ENDINGS)
                        hit = hashes[at] == asked
                        numbers[spots[hit]] = begin + cls[at[hit]]
                        ids = numbers.tobytes()
                    out.append(ids)
                columns = [pa.array(out, pa.binary()) if k == ids_at else c for k, c in enumerate(some.columns) if k != found_at]
                yield pa.RecordBatch.from_arrays(columns, names=[c for c in some.schema.names if c != "found"])

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema)
    return written(texts.join(found, "place", "left").select(*texts.columns, "found").transform(mapped, run, kind), "recoded")


def refined(
    texts: DataFrame, words: Words, classes: np.ndarray, pairs: np.ndarray, exchanged: int = EXCHANGED, most_parts: int = PARTS
) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``texts``, the classes of all numbers and the bigrams of classes, after each word beyond the exchanged was moved too.

    The numbers behind those of the endings are classes: of training words that aren't kept.
    """
    n_classes, top = len(pairs), min(exchanged, len(words.hashes))
    if words.v - 1 <= top:
        return texts, classes, pairs
    first, shorter = texts, classes
    classes = np.concatenate([classes, np.arange(n_classes)])
    parts, turn = 1, 0
    while turn < parts:
        rest = rest_classes(texts.filter("not held_out"), words, classes, pairs, top, parts, turn)
        near = rest.filter("not far").select("hash", "cls").toArrow()
        new = classes.copy()
        at = np.searchsorted(words.sorted, near.column("hash").to_numpy().view(np.uint64))
        new[words.by_hash[at] + 1] = near.column("cls").to_numpy()
        far = rest.filter("far")
        sums = far.groupBy("cls").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
        now = recoded(first, words, far.select("hash", "cls")) if sums else first
        counted, _, _ = class_counts(now.filter("not held_out"), new, top, n_classes)
        if likelihood(counted) > likelihood(pairs):
            texts, classes, pairs, shorter = now, new, counted, None
            # every training word that isn't kept has a number of its own class now
            words.rare_n, words.rare_v = np.zeros(ENDINGS + n_classes), np.zeros(ENDINGS + n_classes)
            for r in sums:
                words.rare_n[ENDINGS + r.cls], words.rare_v[ENDINGS + r.cls] = r.c, r.v
        elif parts < most_parts:
            # too many at once: all words again, in parts half as large
            turn, parts = 0, parts * 2
            continue
        turn += 1
    return texts, classes if shorter is None else shorter, pairs


class Model:
    """Log10 probabilities of transitions, and of words in their classes."""

    def __init__(self, words: Words, classes: np.ndarray, pairs: np.ndarray):
        n_classes = len(pairs)
        known = len(words.counts)
        self.classes = classes
        n = np.bincount(classes[:known], words.counts, n_classes) + np.bincount(classes[known:], words.rare_n, n_classes)
        v = np.bincount(classes[:known], words.counts > 0, n_classes) + np.bincount(classes[known:], words.rare_v, n_classes)
        one = (pairs.sum(axis=0) + 1) / (pairs.sum() + n_classes)
        self.step = np.log10((pairs + BACK_OFF * one) / (pairs.sum(axis=1, keepdims=True) + BACK_OFF))
        self.below = np.log10(n + DELTA * (v + 1))
        self.below[0] = 0.0
        # of kept words the whole emission; of the others the part that does not depend on their count
        self.emit = -self.below[classes]
        self.emit[1:known] += np.log10(words.counts[1:] + DELTA)
        self.base_below = float(np.log10(words.n + words.v + 1))
        self.base = np.full(len(classes), -self.base_below)
        self.base[:known] += np.log10(words.counts + 1)
        self.known = np.zeros(len(classes), bool)
        self.known[:known] = words.counts > 0


def scored(texts: DataFrame, words: Words, model: Model) -> DataFrame:
    """place, doc_id, held_out, n_tokens, n_known, base_score, score; the rarer words' counts come by a join."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for k, ids, counts in _streams(batch):
                cls = m.classes[ids]
                logs = m.step[np.append(0, cls[:-1]), cls] + m.emit[ids]
                first = np.cumsum(counts) - counts
                some = batch.slice(k, len(counts))
                fixed = [some.column(some.schema.names.index(c)) for c in ("place", "doc_id", "held_out")]
                sums = [np.add.reduceat(x, first) for x in (m.known[ids].astype(np.int64), m.base[ids], logs)]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(counts), *map(pa.array, sums)], names=names)

    names = ["place", "doc_id", "held_out", "n_tokens", "_known", "_base", "_score"]
    rows = texts.transform(mapped, run, f"place bigint, doc_id {kind}, held_out boolean, n_tokens bigint, _known bigint, _base double, _score double")
    rows = written(rows, "scored")
    lookups = texts.select("place", "rare").transform(mapped, _rare_words, "place bigint, hash bigint, m bigint").join(words.rare, "hash", "left")
    c = F.coalesce("c", F.lit(0))
    sums = lookups.groupBy("place").agg(
        F.sum(F.when(c > 0, F.col("m")).otherwise(0)).alias("_more_known"),
        F.sum(F.col("m") * F.log10(c + 1)).alias("_more_base"),
        F.sum(F.col("m") * F.log10(c + DELTA)).alias("_more_score"),
    )
    sums = written(sums, "rare-words")
    add = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return rows.join(sums, "place", "left").select(
        "place",
        "doc_id",
        "held_out",
        "n_tokens",
        add("_known", "_more_known").cast("long").alias("n_known"),
        F.lit(words.n).cast("long").alias("train_tokens"),
        add("_base", "_more_base").alias("base_score"),
        add("_score", "_more_score").alias("score"),
    )


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kept: int = KEPT, exchanged: int = EXCHANGED, n_classes: int = CLASSES) -> DataFrame:
    """Learns from the documents that aren't held out, and scores all."""
    train = docs.filter(~held_out(F.col(id_col)))
    words = Words(vocabulary(train.select(text_col)), train.count(), kept)
    with steps_of_a_run(docs.sparkSession) as steps:
        texts = numbered_texts(docs, words, id_col, text_col)
        classes, pairs = clustered(texts.filter("not held_out"), words, exchanged, n_classes)
        texts, classes, pairs = refined(texts, words, classes, pairs, exchanged)
        used = {file.split("/")[-2] for file in texts.inputFiles()}
        steps[:] = [step for step in steps if step.split("/")[-1] not in used]
    return scored(texts, words, Model(words, classes, pairs)).drop("place")


def op8_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
