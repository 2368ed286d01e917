"""A pipeline that makes a training mix of the documents: five stages, each one of the operators.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import store, table
from strata.llm.decontamination import drop_leaks
from strata.llm.jaccard_join import keep_one
from strata.llm.line_dedup import drop_frequent_lines
from strata.llm.mixing import mix
from strata.llm.quality_classifier import model_for, score_quality

#: Near duplicates in the pipeline: words of a shingle and least similarity in percent.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores below 0.5 go."""
    scored = score_quality(docs, model_for(spark, docs, sf_dir), "_score")
    return scored.where("_score >= 0.5").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents go, but for one; n_chars follows the text."""
    kept = drop_frequent_lines(docs.drop("n_chars"))
    kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return keep_one(docs, NEAR_WORDS, NEAR_PERCENT)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with how often each is taken, so that sources meet their target weights."""
    return mix(docs, columns=tuple(docs.columns)).withColumn("taken", (F.col("size") * F.col("copies")).cast("long"))


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("jaccard_join", near_copies),
    ("benchmark_decontamination", leaks),
    ("mixing", mixture),
]

#: A compressor's sizes and a seeded draw are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
