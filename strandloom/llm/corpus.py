"""Queries p6 and p7 over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.llm import leaks as leaking
from strandloom.llm import mixing
from strandloom.session import checkpointed, table


def _leaks(spark: SparkSession, sf_dir: str, short: bool = False) -> DataFrame:
    return leaking.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), short=short)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("doc_id", "item_id")


def p6_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leak with the longest verbatim match, its places, and the share of the item's four-word runs."""
    return _leaks(spark, sf_dir, short=True)


def p6_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are left when those with leaks are removed."""
    return table(spark, sf_dir, "documents").select("doc_id").join(_leaks(spark, sf_dir).select("doc_id").distinct(), "doc_id", "left_anti")


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.with_tokens(table(spark, sf_dir, "documents"), "text", ["doc_id", "source"])


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(_counted(spark, sf_dir), table(spark, sf_dir, "mix_targets")).filter("binds").select(F.col("written").alias("source"))


def p7_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, budgets, passes and the tempered shares of every source of mix_targets."""
    return mixing.plan(_counted(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen documents with their repeats."""
    counted = checkpointed(_counted(spark, sf_dir))
    return mixing.realise(counted, mixing.plan(counted, table(spark, sf_dir, "mix_targets")))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every source of mix_targets its target, its share by the plan and what the chosen documents really give, of all tokens and of the mix."""
    counted = checkpointed(_counted(spark, sf_dir))
    planned = checkpointed(mixing.plan(counted, table(spark, sf_dir, "mix_targets")))
    given = mixing.realise(counted, planned).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("given"), F.count(F.lit(1)).alias("n_documents"), F.max("repeats").alias("most_repeats"))
    # One row for each source of the plan, so one task may add them up.
    rows = planned.join(given, "source", "left").withColumn("given", F.coalesce("given", F.lit(0)))
    rows = rows.withColumn("mixed", F.sum("given").over(Window.partitionBy()))
    return rows.select(F.col("written").alias("source"), "target_share", "tempered_share", F.col("given").alias("tokens_given"), (F.col("given") / F.col("all_tokens")).alias("share_of_all"), (F.col("given") / F.col("mixed")).alias("share_of_mix"), F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"))


QUERIES = {f.__name__: f for f in (p6_found, p6_matches, p6_clean, p7_found, p7_plan, p7_mix, p7_shares)}

SQL = {
    # Which sources can't reach their share doesn't depend on the tokenizer; characters stand for tokens.
    "p7_found": r"""WITH d AS (SELECT regexp_replace(trim(lower(source)), '[_\-\s]+', '_', 'g') AS s, sum(length(text)) AS n FROM documents GROUP BY 1)
  SELECT m.source FROM mix_targets m LEFT JOIN d ON regexp_replace(trim(lower(m.source)), '[_\-\s]+', '_', 'g') = d.s WHERE m.max_repeats * coalesce(n, 0) < m.target_share * (SELECT sum(n) FROM d)""",
}
