"""Corpus pipeline: from raw documents to a training mix.

STAGES are applied in order, each to all its predecessor kept, written as
Parquet in the shared checkpoint folder and read back:

1. language identification drops texts without a language,
2. the n-gram Jaccard join keeps one document of every near-duplicate group
   (five words, similarity 0.8),
3. benchmark decontamination drops documents that hold a benchmark item,
4. personal data becomes surrogates,
5. sources are mixed to their target weights (column ``copy`` numbers the
   repetitions of a document).

All but the last return the columns of ``documents``.  SQL can express none of
the trained or randomised stages, so there is no oracle; the tests compare
with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontam, langid, mixing, ngram_join, pii
from strata.llm.common import materialize, read


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 0, F.lit(True))
    found = langid.identify(docs, train)
    return found.filter(F.col("lang_pred") != langid.UNDETERMINED).select(docs.columns)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove_leaks(docs, read(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = pii.replace(docs)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("ngram_join", join_near_duplicates),
    ("decontamination", decontaminate),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
