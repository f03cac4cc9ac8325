"""All queries of the core by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandloom.plans import assembly_queries, format_queries, hit_queries, interval_queries, problems, report_queries

MODULES = (problems, interval_queries, hit_queries, assembly_queries, format_queries, report_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_queries.j8_fact_table(spark, sf_dir)
