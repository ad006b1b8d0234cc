"""Ranked lexical search: MaxScore over block indexes, with bounds for pairs of terms.

Documents stay where they are. A task indexes its texts block by block: postings of the
terms that are asked for, each with its impact. Every item is searched in every block, best
first: its terms go from the weakest weight to the strongest, and ``bound[i]`` is the most
that the first i of them can give together. Documents that hold none of the other terms
can't come in when that is below the item's 20th score so far; those that do are scored
with the other terms first, then with the weak ones, the strongest of them first, and go as
soon as what is left can't lift them.

The bound is where pairs come in. For terms that follow each other in an item's order, the
index holds the list of documents that have both, and the greatest sum of both impacts in it.
So a pair gives at most that sum, or the greater of the two single maxima: less than both
maxima together. ``bound`` is the least combination of such pairs and single terms that
covers the first i terms. Lists are made of terms in at most ``PAIR_SHARE`` of a block's
documents; other terms count with their single maxima. Bounds decide what is skipped only:
whatever may enter is scored in full, in integers.

The items are split into blocks of bounded size, hashed and written by tasks; there is one
pass over the documents for the counts of a block's terms and one for its search. A task
gives 20 rows an item at most, and these are ranked by Spark.

Null text: no terms; such a document is not counted and never found. An item without terms,
or whose terms occur nowhere, has no rows. Repeated documents are found one by one, ties by
ascending doc_id, null last. Repeated items are ranked one by one. Very long texts are a block
of their own. An empty table on either side gives an empty result. Other columns are not read,
whatever their names. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollkeeper.llm.common import documents, fresh, mapped, ranges, text_blocks
from rollkeeper.llm.decontaminate import Items, item_blocks, words_of
from rollkeeper.session import written

TOP = 20
#: A term pair's list is made if both terms are in at most this share of a block's documents.
PAIR_SHARE = 1 / 8


class Wanted:
    """The items of a block: their distinct terms with weights and repeats, from the weakest to the strongest."""

    def __init__(self, items: Items, terms: np.ndarray, weights: np.ndarray):
        """``terms``: ascending hashes of the terms that some document has; ``weights``: theirs."""
        self.terms, self.weights = terms, weights
        at = np.searchsorted(terms, items.words)
        known = at < len(terms)
        known[known] = terms[at[known]] == items.words[known]
        known[known] = weights[at[known]] > 0
        width = max(1, len(terms))
        keys, times = np.unique(items.item[known] * width + at[known], return_counts=True)
        item, term = keys // width, keys % width
        by = np.lexsort((term, weights[term], item))
        self.term, self.factor = term[by], (weights[term] * times)[by]
        self.first = np.searchsorted(item[by], np.arange(len(items.ids) + 1))
        self.ids = items.ids


class Index:
    """Postings of the wanted terms in a block of documents, and the bounds of each item's terms and pairs."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray, wanted: Wanted, n_docs: int, n_terms: int):
        counts = np.diff(first)
        norm = 75 + 25 * counts * n_docs // n_terms
        size = len(counts)
        doc = np.repeat(np.arange(size), counts)
        at = np.minimum(np.searchsorted(wanted.terms, hashes), len(wanted.terms) - 1)
        known = wanted.terms[at] == hashes
        self.keys, times = np.unique(at[known] * size + doc[known], return_counts=True)
        self.docs = self.keys % size
        self.impact = 1_000_000_000 * times // (1000 * times + 12 * norm[self.docs])
        self.first = np.searchsorted(self.keys, np.arange(len(wanted.terms) + 1) * size)
        self.size = size
        lengths = np.diff(self.first)
        greatest = np.zeros(len(wanted.terms), np.int64)
        some = np.flatnonzero(lengths)
        if len(some):
            greatest[some] = np.maximum.reduceat(self.impact, self.first[some])
        self.most = wanted.factor * greatest[wanted.term]
        self.joint = self._pairs(wanted, lengths)

    def _pairs(self, wanted: Wanted, lengths: np.ndarray) -> np.ndarray:
        """For each term of an item the most that it and the one before it give together."""
        joint = self.most.copy()
        joint[1:] += self.most[:-1]
        few = lengths[wanted.term] <= self.size * PAIR_SHARE
        pair = np.flatnonzero(few[1:] & few[:-1]) + 1
        pair = pair[~np.isin(pair, wanted.first)]  # the first term of an item has none before it
        if not len(pair):
            return joint
        # one intersection list for each pair of terms with its factors, whichever items share it
        facts = np.stack([wanted.term[pair - 1], wanted.term[pair], wanted.factor[pair - 1], wanted.factor[pair]], axis=1)
        facts, which = np.unique(facts, axis=0, return_inverse=True)
        one, two, factor1, factor2 = facts.T
        count = lengths[one]
        own = np.repeat(np.arange(len(facts)), count)
        here = ranges(self.first[one], count)
        key = two[own] * self.size + self.docs[here]
        there = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
        both = self.keys[there] == key if len(key) else np.empty(0, bool)
        own, here, there = own[both], here[both], there[both]
        sums = factor1[own] * self.impact[here] + factor2[own] * self.impact[there]
        most = np.zeros(len(facts), np.int64)
        if len(own):
            heads = np.flatnonzero(np.diff(own, prepend=-1))
            most[own[heads]] = np.maximum.reduceat(sums, heads)
        single = np.maximum(self.most[pair - 1], self.most[pair])
        joint[pair] = np.maximum(most[which.ravel()], single)
        return joint

    def bounds(self, low: int, high: int) -> list[int]:
        """``out[i]``: the most that the first i of the item's terms can give together."""
        out = [0]
        for most, joint in zip(self.most[low:high].tolist(), self.joint[low:high].tolist(), strict=True):
            out.append(min(out[-1] + most, out[-2] + joint) if len(out) > 1 else most)
        return out

    def posting(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.first[term], self.first[term + 1]
        return self.docs[low:high], self.impact[low:high]

    def search(self, wanted: Wanted, item: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the block with a score of at least ``least`` (1 or more), and their scores."""
        low, high = int(wanted.first[item]), int(wanted.first[item + 1])
        bound = self.bounds(low, high)
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        if bound[-1] < least:
            return none
        weak = 0
        while weak < high - low and bound[weak + 1] < least:
            weak += 1
        score = np.zeros(self.size, np.int64)
        for i in range(low + weak, high):
            docs, impact = self.posting(wanted.term[i])
            score[docs] += wanted.factor[i] * impact
        found = np.flatnonzero(score)
        for i in range(low + weak - 1, low - 1, -1):
            found = found[score[found] + bound[i - low + 1] >= least]
            if not len(found):
                return none
            docs, impact = self.posting(wanted.term[i])
            if not len(docs):
                continue
            at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            hit = docs[at] == found
            score[found[hit]] += wanted.factor[i] * impact[at[hit]]
        found = found[score[found] >= least]
        return found, score[found]


def _best(scores: np.ndarray, ids: np.ndarray, null: np.ndarray, top: int) -> np.ndarray:
    return np.lexsort((ids, null, -scores))[:top]


def term_counts(docs: DataFrame, text_col: str, paths: list[str]) -> DataFrame:
    """For each term of the items in the files ``paths`` that occurs: term, docs; and a row without term: documents with terms, all terms."""

    def run(batches):
        vocabulary = np.unique(Items(paths, 1).words)
        counts = np.zeros(len(vocabulary), np.int64)
        n_docs = n_terms = 0
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                hashes, first = words_of(data, offsets)
                n_docs += int(np.count_nonzero(np.diff(first)))
                n_terms += len(hashes)
                if not len(vocabulary) or not len(hashes):
                    continue
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                known = vocabulary[at] == hashes
                doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))[known]
                keys = np.unique(doc * len(vocabulary) + at[known])
                counts += np.bincount(keys % len(vocabulary), minlength=len(vocabulary))
        some = np.flatnonzero(counts)
        term = pa.array([None, *vocabulary[some].view(np.int64).tolist()], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [term, pa.array(np.append(n_docs, counts[some])), pa.array(np.append(n_terms, np.zeros(len(some), np.int64)))],
            names=["term", "docs", "terms"],
        )

    rows = docs.select(text_col).transform(mapped, run, "term bigint, docs bigint, terms bigint")
    return rows.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms"))


def weight(docs: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * docs + 1)))


def _searched(docs: DataFrame, id_col: str, text_col: str, paths: list[str], top: int) -> DataFrame:
    """The best ``top`` documents of each task for the items in these files: item, doc_id, score."""
    counted = written(term_counts(docs, text_col, paths), "term-counts")
    total = counted.filter("term is null").agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = (int(x or 0) for x in total)
    held = counted.filter("term is not null").select("term", "docs").toArrow()  # no more rows than the block has terms
    terms = np.asarray(held.column("term")).astype(np.int64).view(np.uint64)
    weights = np.array([weight(d, n_docs) for d in held.column("docs").to_pylist()], np.int64)
    by = np.argsort(terms)
    facts = docs.sparkSession.sparkContext.broadcast((terms[by], weights[by]))

    def run(batches):
        terms, weights = facts.value
        if not len(terms):
            return
        wanted = Wanted(Items(paths, 1), terms, weights)
        some = np.flatnonzero(np.diff(wanted.first)).tolist()
        empty = np.empty(0, np.int64)
        best = {item: (empty, empty, np.empty(0, bool)) for item in some}
        least = dict.fromkeys(some, 1)
        for batch in batches:
            ids = batch.column(0)
            null, ids = np.asarray(ids.is_null()), np.asarray(ids.fill_null(0)).astype(np.int64)
            for low, high, data, offsets in text_blocks(batch.column(1)):
                hashes, first = words_of(data, offsets)
                if not len(hashes):
                    continue
                index = Index(hashes, first, wanted, n_docs, n_terms)
                own_ids, own_null = ids[low:high], null[low:high]
                for item in some:
                    found, scores = index.search(wanted, item, least[item])
                    if not len(found):
                        continue
                    held = best[item]
                    scores = np.concatenate([held[0], scores])
                    id_, null_ = np.concatenate([held[1], own_ids[found]]), np.concatenate([held[2], own_null[found]])
                    order = _best(scores, id_, null_, top)
                    best[item] = scores[order], id_[order], null_[order]
                    if len(order) == top:
                        least[item] = max(1, int(scores[order[-1]]))
        for item, (scores, id_, null_) in best.items():
            if len(scores):
                place = pa.array(np.full(len(scores), int(wanted.ids[item])))
                yield pa.RecordBatch.from_arrays([place, pa.array(id_, mask=null_), pa.array(scores)], names=["place", "doc_id", "score"])

    return docs.select(F.col(id_col).cast("long"), text_col).transform(mapped, run, "place bigint, doc_id bigint, score bigint")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
) -> DataFrame:
    """For each row of ``items`` its best ``top`` documents: the item's id, rank, doc_id, score.

    ``items`` must be a stored table, so that a row keeps its place from scan to scan.
    """
    placed = items.select(
        F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"), F.monotonically_increasing_id().alias("place")
    )
    blocks, _ = item_blocks(placed, "place", "text")
    parts = [_searched(docs, id_col, text_col, paths, top) for paths in blocks]
    names = placed.select("place", "item_id")
    if not parts:
        return names.limit(0).selectExpr("item_id", "0 AS rank", "0L AS doc_id", "0L AS score")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = written(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top), "ranked")
    return best.join(names, "place").select("item_id", "rank", "doc_id", "score")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL = {
    "op13_lexical": f"""
WITH words AS (SELECT row_number() OVER () AS k, doc_id, unnest({_TERMS}) AS term FROM documents),
sizes AS (SELECT k, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY k),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
tf AS (SELECT k, term, count(*) AS tf FROM words GROUP BY k, term),
asked AS (SELECT row_number() OVER () AS q, item_id, unnest({_TERMS}) AS term FROM benchmark),
weights AS (
    SELECT term, floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tf, whole WHERE term IN (SELECT term FROM asked) GROUP BY term
),
scored AS (
    SELECT q, any_value(item_id) AS item_id, k, any_value(doc_id) AS doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (k), whole
    GROUP BY q, k
),
ranks AS (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 20
"""
}
