"""From documents to packed training sequences, stage by stage, each written and read again.

1. Quality rules: what the word rules or the perplexity band of its language reject goes.
2. SimHash near-dedup: of each component of near-duplicates the document of the smallest id stays.
3. Suffix-array dedup: long repeats are cut out of the texts; ``n_chars`` follows the text.
4. Benchmark decontamination: contaminated documents go.
5. Best-fit packing: the documents' tokens in sequences of at most 4096.

Each stage judges the documents that the one before has kept, by the operator's own
parameters. All but the last return the columns of ``documents``, others included.
Null or empty texts fail the quality rules, so later stages see none from there; a text
that is cut to nothing stays, as an empty one, and packs as its end id. Rows that repeat
are copies, so the second stage keeps one of them. An empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeeper.llm import decontaminate, packing, perplexity, runlength, simhash
from rollkeeper.session import steps_of_a_run, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return perplexity.keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = runlength.without_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, packing.public_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL can express neither the language model nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        if k == len(STAGES) - 1:
            return stage(spark, docs, sf_dir)
        with steps_of_a_run(spark) as steps:  # what a stage has stored goes, but for its result
            docs = written(stage(spark, docs, sf_dir), "stage")
            steps.pop()
    return docs
