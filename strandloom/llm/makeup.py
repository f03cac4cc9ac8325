"""Queries p8: the areas of the documents and the make-up of the corpus by area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm.areas import areas
from strandloom.session import table


def _areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas(*(table(spark, sf_dir, t) for t in ("documents", "subject_labels", "subjects")))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _areas(spark, sf_dir).select("doc_id", "subject")


def p8_makeup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and sentences of every area; areas without documents too."""
    found = _areas(spark, sf_dir).groupBy("subject").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("n_sentences").alias("n_sentences"))
    return table(spark, sf_dir, "subjects").select("subject", "title").join(found, "subject", "left").select("subject", "title", F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.coalesce("n_sentences", F.lit(0)).alias("n_sentences"))


QUERIES = {f.__name__: f for f in (p8_found, p8_makeup)}
SQL: dict[str, str] = {}
