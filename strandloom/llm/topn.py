"""The best N items of every group, whatever the size of the group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[tuple[str, bool]], n: int, spread: Column, salts: int | None = None) -> DataFrame:
    """The ``n`` best rows of each group by ``order`` ((column, descending) pairs), with ``place`` 1..n; two-stage salted ranking.

    Each group is hashed into ``salts`` subgroups by ``spread`` (as many as there are shuffle partitions, unless given) and ranked
    there; only the n best items of a subgroup go on, each once, and the survivors, at most n x salts of a group, are ranked
    again. ``spread`` must be a function of the order columns, so that equal rows meet in one subgroup; if it is constant over
    neighbouring items, small groups stay in one subgroup and shrink in the first stage already. Both stages filter on the
    rank, so Spark also cuts every subgroup on the map side, before the shuffle.

    ``order`` must end in a column that tells items apart: rows equal in the group and all order columns are one item and
    take one place (any one of them is returned). Rows with a NULL in the group or an order column, or NaN, are left out.
    Fewer than n items give fewer rows; an empty table gives none. Columns other than these pass
    through; one named place is replaced.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for c in group:
        df = df.filter(F.col(c).isNotNull())
    for c, _ in order:
        df = df.filter(F.col(c).isNotNull())
        if dict(df.dtypes)[c] in ("double", "float"):
            df = df.filter(~F.isnan(c))
    sort = [F.col(c).desc() if down else F.col(c).asc() for c, down in order]
    item = [*group, *(c for c, _ in order)]
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    survivors = best_of_subgroups(salted, group, sort, item, n)
    second = Window.partitionBy(*group).orderBy(*sort)
    return survivors.drop("__salt").withColumn("place", F.row_number().over(second).cast("bigint")).filter(F.col("place") <= n)


def best_of_subgroups(salted: DataFrame, group: Sequence[str], sort: Sequence[Column], item: Sequence[str], n: int) -> DataFrame:
    """The n best items of each (group, __salt), each once; copies meet in one subgroup, so dropping them needs no shuffle of its own."""
    first = Window.partitionBy(*group, "__salt").orderBy(*sort)
    return salted.withColumn("__rank", F.dense_rank().over(first)).filter(F.col("__rank") <= n).drop("__rank").dropDuplicates([*item, "__salt"])
