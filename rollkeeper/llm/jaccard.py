"""Documents linked by the Jaccard similarity of their word shingles: rare-first prefix join.

Two sets of shingles are linked when their intersection has at least ``LEAST`` hundredths of
their union. A set of n shingles lacks at most d = n - ceil(LEAST * n / 100) of its shingles
in a set it is linked with. That is used twice.

First, for a share of all shingles that is chosen by hash (``SAMPLED`` eighths), Spark counts
the tasks' sets of each. A set with more than d shingles there that no other set has is linked
with none, and goes; that is nearly every text without a near-duplicate. Then all shingles of
the sets that are left are counted and ordered, the rarest first. Whatever the order, two
linked sets share a shingle among the first d + 1 of each; with this one few others do.

Prefix shingles are joined. Three filters hold for the first shingle that a linked pair
shares, and pairs that pass them under some shingle are verified, each once, on whole sets:

- length: the smaller has at least LEAST hundredths of the larger;
- position: behind the shared shingle both have enough left for the overlap that is needed;
- suffix: what is left is divided by hash, twice: the sizes of eight parts differ by no more
  in sum than the shingles in which the two may differ, and as many at most of 256 parts are
  of odd size in one and of even size in the other.

A shingle shared by very many sets isn't expanded into pairs. In up to ``ROUNDS`` rounds, as long as that finds
links, each set is held against one set of each shingle, another one every round, and the
links so found are closed to components. Then the shingles that still hold several components are joined, all
but their largest component with the others. A pair that is left out lies in one component
already, so the components are exact.

Equal sets are folded first. Sets that are equal but for shingles which no other set has (copies
with own words at one place) are folded too: with c shingles in common, the one with the
fewest of its own is linked with all that are linked with any of them, so the others that are linked with
it go on as that one does. However many they are, they make no pairs.

No words, null included: the empty set, linked with nothing,
not even with another empty set. Fewer words than a shingle: the whole sequence is the only
one. Repeated rows have equal sets and share a component; its id is its smallest doc_id (null
if it has none). A very long text is one row of hashes. An empty table gives an empty result.
Other columns are not read, whatever their names. Shingles and sets are told apart by 64-bit
hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeeper.llm.common import GRAPH, LOWER, documents, fresh, lists, mapped, mixed, text_blocks, word_bounds, word_hashes
from rollkeeper.llm.components import components
from rollkeeper.llm.files import located, new_folder
from rollkeeper.session import written

SHINGLE = 4
LEAST = 85
#: Eighths of all shingles by which sets are told to have no partner.
SAMPLED = 3
ROUNDS = 2

_STEP = np.uint64(0xA24BAED4963EE407)
#: Bytes of text that are hashed at once; that holds some fifty for each.
_BLOCK = 1 << 20
_TASK_BITS = 33
_PARTS = 8
_BITS = 16
_ODD = 256


def missing(n, least: int = LEAST):
    """How many of its n shingles a set may lack in a set it is linked with."""
    return n - (n * least + 99) // 100


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of each text's shingles, ascending and distinct, one text after the other, and each text's number."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, GRAPH)
    words = word_hashes(data, starts, ends)
    n_words = np.diff(first)
    width = np.minimum(n_words, shingle)
    counts = np.where(n_words > 0, n_words - width + 1, 0)
    edges = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(int(edges[-1])) + (first[:-1] - edges[:-1])[row]
    width = width[row]
    out = width.astype(np.uint64)
    for k in range(shingle):
        taken = words[np.minimum(at + k, len(words) - 1)] if len(words) else words
        out = np.where(k < width, mixed(out * _STEP + taken), out)
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        out[low:high].sort()
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return out[new], np.bincount(row[new], minlength=len(counts))


def set_ids(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set; 0 for the empty one."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes * _STEP))])
    edges = np.concatenate([[0], np.cumsum(counts)])
    out = mixed(sums[edges[1:]] - sums[edges[:-1]] + counts.astype(np.uint64) * _STEP)
    return np.where(counts > 0, out, np.uint64(0))


def _packed(counts: np.ndarray) -> np.ndarray:
    """Rows of eight counts as two longs; counts that don't fit 16 bits stay at the greatest, which only loosens the filter."""
    return np.minimum(counts, (1 << _BITS) - 1).astype("<u2").view("<i8")


def suffixes(hashes: np.ndarray, places: int) -> np.ndarray:
    """For each of the first ``places`` hashes what comes behind it: the sizes of eight parts as
    two longs, and which of 256 parts are odd as four."""
    part = (hashes & np.uint64(_PARTS - 1)).astype(np.int64)
    behind = np.bincount(part, minlength=_PARTS) - np.cumsum(np.eye(_PARTS, dtype=np.int64)[part[:places]], axis=0)
    part = ((hashes >> np.uint64(3)) & np.uint64(_ODD - 1)).astype(np.int64)
    bit = np.zeros((len(hashes), _ODD // 64), np.uint64)
    bit[np.arange(len(hashes)), part >> 6] = np.uint64(1) << (part & 63).astype(np.uint64)
    odd = np.bitwise_xor.reduce(bit, axis=0) ^ np.bitwise_xor.accumulate(bit[:places], axis=0)
    return np.concatenate([_packed(behind).reshape(-1, 2), odd.view(np.int64).reshape(-1, 4)], axis=1)


#: Columns of what ``suffixes`` gives.
_SIZES, _PARITIES = ["right0", "right1"], ["odd0", "odd1", "odd2", "odd3"]


def with_sets(docs: DataFrame, keep: list[str], text_col: str, shingle: int) -> DataFrame:
    """For each row its ``keep`` columns, the hash and the size of its set (sid, n), and the
    sampled shingles of it (tokens), but null on a row whose set the same task has had before."""
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*fields, "sid bigint, n bigint, tokens array<bigint>"])

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for low, high, data, offsets in text_blocks(batch.column(batch.num_columns - 1), _BLOCK):
                hashes, counts = shingle_sets(data, offsets, shingle)
                sids = set_ids(hashes, counts)
                lead = np.zeros(high - low, bool)
                for k, sid in enumerate(sids.tolist()):
                    if sid not in seen:
                        seen.add(sid)
                        lead[k] = sid != 0
                row = np.repeat(np.arange(high - low), counts)
                ours = ((hashes >> np.uint64(61)) < SAMPLED) & lead[row]
                ends = np.concatenate([[0], np.cumsum(np.bincount(row[ours], minlength=high - low))]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[ours].view(np.int64)), mask=pa.array(~lead))
                own = [batch.column(i).slice(low, high - low) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(sids.view(np.int64)), pa.array(counts), tokens], names=[*keep, "sid", "n", "tokens"])

    return docs.select(*keep, F.col(text_col).alias(fresh(docs, "_body"))).transform(mapped, run, schema)


def places_by_task(rows: DataFrame, place: str) -> str:
    """Writes the column ``place`` (monotonically_increasing_id) to a folder with one part for each task it names."""
    folder = f"{new_folder(rows.sparkSession, 'places')}/parts"
    parts = rows.select(F.col(place).alias("place"), F.shiftright(place, _TASK_BITS).alias("task")).repartition("task")
    parts.sortWithinPartitions("task", "place").write.partitionBy("task").parquet(folder)
    return folder


def _places(folder: str, task: int) -> np.ndarray:
    """The places that were written for a task, ascending."""
    store, path = located(f"{folder}/task={task}")
    files = [f.path for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet")]
    found = [np.asarray(pq.ParquetFile(store.open_input_file(f)).read(["place"]).column(0)) for f in files]
    return np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)


def whole_sets(placed: DataFrame, place: str, folder: str, text_col: str, shingle: int) -> DataFrame:
    """The hash and all shingle hashes (sid, tokens) of the sets of the rows whose places are in ``folder``.

    Texts stay where they are: a task opens the part that was written for it.
    """

    def run(batches):
        task, held = None, None
        for batch in batches:
            at = np.asarray(batch.column(0))
            if task is None and len(at):
                task = int(at[0]) >> _TASK_BITS
                held = _places(folder, task)
            if not len(at) or not len(held):
                continue
            found = np.minimum(np.searchsorted(held, at), len(held) - 1)
            texts = batch.column(1).filter(pa.array(held[found] == at))
            for _, _, data, offsets in text_blocks(texts, _BLOCK):
                hashes, counts = shingle_sets(data, offsets, shingle)
                made = [pa.array(set_ids(hashes, counts).view(np.int64)), lists(pa.array(hashes.view(np.int64)), counts)]
                yield pa.RecordBatch.from_arrays(made, names=["sid", "tokens"])

    return placed.select(place, text_col).transform(mapped, run, "sid bigint, tokens array<bigint>")


def prefix_entries(sets: DataFrame, least: int) -> DataFrame:
    """``sets`` (sid, n, shared): a row for each prefix shingle that other sets have too.

    ``shared`` lists all such shingles of a set with their counts; those it has alone come
    before them. The columns of ``suffixes`` tell what comes behind.
    """
    names = ["token", "sid", "n", "pos", *_SIZES, *_PARITIES]

    def run(batches):
        for batch in batches:
            out = []
            for sid, n, shared in zip(*(batch.column(c) for c in ("sid", "n", "shared")), strict=True):
                sid, n = sid.as_py(), n.as_py()
                token = np.asarray(shared.values.field("token")).view(np.uint64)
                token = token[np.lexsort((token, np.asarray(shared.values.field("sets"))))]
                alone = n - len(token)
                held = token[: max(0, missing(n, least) + 1 - alone)].view(np.int64)
                if len(held):
                    facts = [held, np.full(len(held), sid), np.full(len(held), n), alone + np.arange(len(held))]
                    out.append(np.concatenate([np.stack(facts, axis=1), suffixes(token, len(held))], axis=1))
            if out:
                rows = np.concatenate(out).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=names)

    schema = ", ".join(f"{c} bigint" for c in names)
    return sets.select("sid", "n", "shared").transform(mapped, run, schema)


def may_link(one: str, two: str, least: int) -> Column:
    """The length, position and suffix filters, for the columns of two entries with these endings."""
    n1, n2 = F.col(f"n{one}"), F.col(f"n{two}")
    left1, left2 = n1 - F.col(f"pos{one}") - 1, n2 - F.col(f"pos{two}") - 1
    # 100 * overlap >= least * (n1 + n2 - overlap), rounded up
    need = F.floor(((n1 + n2) * least + (99 + least)) / (100 + least))
    length = F.least(n1, n2) * 100 >= F.greatest(n1, n2) * least
    position = F.least(left1, left2) + 1 >= need
    apart = left1 + left2 - (need - 1) * 2
    odd = sum((F.bit_count(F.col(f"{c}{one}").bitwiseXOR(F.col(f"{c}{two}"))) for c in _PARITIES), F.lit(0))
    sizes = F.lit(0)
    for c in _SIZES:
        for k in range(4):
            a, b = (F.shiftrightunsigned(F.col(f"{c}{x}"), _BITS * k).bitwiseAND(F.lit((1 << _BITS) - 1)) for x in (one, two))
            sizes = sizes + F.abs(a - b)
    return length & position & (odd <= apart) & (sizes <= apart)


def _ending(df: DataFrame, ending: str, but: tuple[str, ...] = ("token",)) -> DataFrame:
    return df.select(*(F.col(c).alias(c if c in but else f"{c}{ending}") for c in df.columns))


def _pairs(met: DataFrame, tried: DataFrame | None) -> DataFrame:
    """Each pair of sets (a < b) once, but for those tried before; stored."""
    pairs = met.select(F.least("sid1", "sid2").alias("a"), F.greatest("sid1", "sid2").alias("b")).distinct()
    return written(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")


def verified(pairs: DataFrame, whole: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough. ``whole`` (sid, tokens) is stored and has each set once."""
    asked = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    whole = written(whole.join(asked, "sid", "left_semi"), "asked-sets")
    first = whole.select(F.col("sid").alias("a"), F.col("tokens").alias("tokens_a"))
    second = whole.select(F.col("sid").alias("b"), F.col("tokens").alias("tokens_b"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.size("tokens_a") + F.size("tokens_b") - both
    return pairs.join(first, "a").join(second, "b").filter(both * 100 >= union * least).select("a", "b")


def _rooted(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """``entries`` with each set's component (``root``) and its number of sets (``size``); stored."""
    sizes = roots.groupBy("b").agg((F.count(F.lit(1)) + 1).alias("size")).withColumnRenamed("b", "root")
    rooted = entries.drop("root", "size").join(roots, F.col("sid") == F.col("a"), "left").withColumn("root", F.coalesce("b", "sid"))
    rooted = rooted.drop("a", "b").join(sizes, "root", "left").withColumn("size", F.coalesce("size", F.lit(1)))
    return written(rooted, "rooted")


def set_components(entries: DataFrame, whole: DataFrame, least: int = LEAST, rounds: int = ROUNDS) -> DataFrame:
    """``entries``, stored: for each set but the least of its component (a, b), b being the least."""
    roots = tried = None
    live = entries.withColumn("root", F.col("sid")).withColumn("size", F.lit(1))
    columns = ["sid", "n", "pos", *_SIZES, *_PARITIES, "root"]
    several = (F.min("root") < F.max("root")).alias("several")
    for k in range(rounds):
        # of a shingle's largest component, another set every round
        pick = F.min(F.struct((-F.col("size")).alias("size"), F.xxhash64("sid", F.lit(k)).alias("by"), *columns)).alias("head")
        heads = live.groupBy("token").agg(pick, several).filter("several")
        heads = written(heads.select("token", *(F.col(f"head.{c}").alias(f"{c}2") for c in columns)), "heads")
        met = _ending(live, "1").join(heads.hint("merge"), "token").filter("root1 <> root2").filter(may_link("1", "2", least))
        pairs = _pairs(met, tried)
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = written(verified(pairs, whole, least), "verified")
        if links.isEmpty():
            roots = links if roots is None else roots
            break
        roots = components(links if roots is None else roots.unionByName(links))
        # shingles whose sets are all in one component are done with
        live = _rooted(live.join(heads.select("token").hint("merge"), "token", "left_semi") if k else live, roots)

    live = live.withColumn("weight", F.struct("size", "root")).drop("size")
    tops = live.groupBy("token").agg(F.max("weight").alias("top"), several).filter("several")
    tops = written(tops.select("token", "top"), "tops")
    if tops.isEmpty():
        return roots
    mixed = written(live.join(tops.hint("merge"), "token"), "mixed")
    one, two = _ending(mixed.filter("weight < top").drop("top"), "1"), _ending(mixed.drop("top"), "2")
    met = one.join(two, "token").filter("weight1 < weight2").filter(may_link("1", "2", least))
    more = written(verified(_pairs(met, tried), whole, least), "verified")
    return roots if more.isEmpty() else components(roots.unionByName(more))


def folded(sets: DataFrame, least: int) -> DataFrame:
    """``sets`` (sid, n, shared), stored: a and b for each set that can go, as it is linked with b and with no set that b isn't linked with; stored.

    Of sets with the same shared shingles b has the fewest of its own. What two sets have
    in common are shared shingles, so all of these have the same number in common with any other set.
    """
    core = F.xxhash64(F.array_sort(F.col("shared.token"))).alias("core")
    cores = sets.select("sid", "n", F.size("shared").alias("c"), core)
    heads = cores.groupBy("core", "c").agg(F.min(F.struct("n", "sid")).alias("head"), F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    heads = written(heads.select("core", "c", F.col("head.n").alias("least_n"), F.col("head.sid").alias("b")), "cores")
    met = cores.join(heads, ["core", "c"]).filter("sid <> b")
    linked = met.filter(F.col("c") * 100 >= (F.col("n") + F.col("least_n") - F.col("c")) * least)
    return written(linked.select(F.col("sid").alias("a"), "b"), "folded")


def _met_twice(tokens: DataFrame) -> DataFrame:
    """The shingles that several rows have, and how many (sets); stored."""
    return written(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1"), "met-twice")


def jaccard_components(docs: DataFrame, keep: list[str], least: int = LEAST, shingle: int = SHINGLE, text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, ``sid``, ``n`` and ``root`` (equal for all rows of a component).

    ``docs`` must be a stored table, so that a row keeps its place from scan to scan.
    """
    place = fresh(docs, "_place")
    placed = docs.withColumn(place, F.monotonically_increasing_id())
    rows = written(with_sets(placed, [*keep, place], text_col, shingle), "sets")
    leads = rows.filter(F.col("tokens").isNotNull())
    lacks = F.col("n") - F.ceil(F.col("n") * least / 100)

    # sets that have too much alone go; the tokens of equal sets in several tasks count as shared, which keeps more
    tokens = leads.select("sid", F.explode("tokens").alias("token"))
    shared = tokens.join(_met_twice(tokens).hint("merge"), "token").groupBy("sid").agg(F.count(F.lit(1)).alias("shared"))
    sets = leads.groupBy("sid").agg(F.min(F.struct(place, "n", F.size("tokens").alias("m"))).alias("_set"))
    sets = sets.select("sid", F.col("_set")[place].alias(place), F.col("_set.n").alias("n"), F.col("_set.m").alias("m"))
    alone = F.col("m") - F.coalesce("shared", F.lit(0))
    sets = written(sets.join(shared, "sid", "left").filter(alone <= lacks).select("sid", place, "n"), "open-sets")
    whole = written(whole_sets(placed, place, places_by_task(sets, place), text_col, shingle), "whole-sets")

    tokens = whole.select("sid", F.explode("tokens").alias("token"))
    shared = tokens.join(_met_twice(tokens).hint("merge"), "token").groupBy("sid").agg(F.collect_list(F.struct("sets", "token")).alias("shared"))
    sets = written(sets.join(shared, "sid").filter(F.col("n") - F.size("shared") <= lacks).select("sid", "n", "shared"), "shared-sets")
    folds = folded(sets, least)
    sets = sets.join(folds.select(F.col("a").alias("sid")), "sid", "left_anti")
    entries = written(prefix_entries(sets, least), "entries")
    met = _met_twice(entries).drop("sets")
    entries = written(entries.join(met.hint("merge"), "token", "left_semi"), "met-entries")
    roots = set_components(entries, whole, least)
    gone = folds.join(roots.select(F.col("a").alias("b"), F.col("b").alias("root")), "b", "left").select("a", F.coalesce("root", "b").alias("b"))
    roots = written(roots.unionByName(gone), "roots")
    return rows.select(*keep, "sid", "n").join(roots, F.col("sid") == F.col("a"), "left").select(*keep, "sid", "n", F.coalesce("b", "sid").alias("root"))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(jaccard_components(documents(spark, sf_dir), ["doc_id"]), "rooted")
    ids = written(rows.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("least")), "component-ids")
    own = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return rows.join(ids, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

#: All pairs that share a shingle, and all that reach one another: for tables of some thousand rows.
SQL = {
    "op12_jaccard": f"""
WITH RECURSIVE words AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS ws FROM documents),
shingle AS (
    SELECT DISTINCT k, CASE WHEN len(ws) < 4 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 3], ' ') END AS g
    FROM (SELECT k, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM words WHERE len(ws) > 0)
),
size AS (SELECT k, count(*) AS n FROM shingle GROUP BY k),
met AS (SELECT a.k AS a, b.k AS b, count(*) AS n_both FROM shingle a JOIN shingle b ON a.g = b.g AND a.k < b.k GROUP BY ALL),
link AS (SELECT a, b FROM met JOIN size x ON x.k = a JOIN size y ON y.k = b WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
step AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT k, k AS r FROM size UNION SELECT reach.k, step.b FROM reach JOIN step ON reach.r = step.a),
lowest AS (SELECT reach.k, min(doc_id) AS c FROM reach JOIN words ON words.k = reach.r GROUP BY reach.k)
SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE c END AS component_id
FROM words LEFT JOIN size USING (k) LEFT JOIN lowest USING (k)
"""
}
