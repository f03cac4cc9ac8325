"""Eager aggregation through joins: per-key results without moving the rows of heavy keys.

Both join inputs are first reduced to compact states, one row for each key (and further grouping column). The reduction is
an ordinary hash aggregate, so every map task combines its own rows before anything is shuffled and a key that holds most
rows costs as much to shuffle as any other. The states are joined and their counts and sums combined algebraically, which
gives exactly the aggregates of the joined rows without building them; a last roll-up drops grouping columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDE = "decimal(38,0)"


def present(column: str | Column) -> Column:
    """True where a string key is there: not NULL and none of the in-band signs for missing."""
    c = F.col(column) if isinstance(column, str) else column
    return c.isNotNull() & ~c.isin(".", "NONE")


def compact(
    df: DataFrame,
    by: Sequence[str],
    sums: Mapping[str, Column | str] | None = None,
    mins: Mapping[str, Column | str] | None = None,
    maxs: Mapping[str, Column | str] | None = None,
    rows: str = "n_rows",
) -> DataFrame:
    """One state for each combination of ``by``: the row count, and per name a sum, a minimum or a maximum.

    Rows with a NULL in ``by`` are left out, as an inner join would leave them out. A sum over NULLs only is 0; minima and
    maxima over NULLs only are NULL. Columns that aren't named are dropped, so clashing names can't reach the join.
    """
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    kept = df
    for key in by:
        kept = kept.filter(F.col(key).isNotNull())
    return kept.groupBy(*by).agg(
        F.count(F.lit(1)).cast(WIDE).alias(rows),
        *[F.coalesce(F.sum(as_column(c)), F.lit(0)).cast(WIDE).alias(k) for k, c in (sums or {}).items()],
        *[F.min(as_column(c)).alias(k) for k, c in (mins or {}).items()],
        *[F.max(as_column(c)).alias(k) for k, c in (maxs or {}).items()],
    )


def rollup(states: DataFrame, by: Sequence[str], sums: Sequence[str] = (), mins: Sequence[str] = (), maxs: Sequence[str] = ()) -> DataFrame:
    """Fewer grouping columns: counts and sums add up, minima and maxima combine."""
    return states.groupBy(*by).agg(
        *[F.sum(c).cast(WIDE).alias(c) for c in sums],
        *[F.min(c).alias(c) for c in mins],
        *[F.max(c).alias(c) for c in maxs],
    )


def join_states(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_rows: str = "n_rows",
    right_rows: str = "n_rows",
    left_sums: Sequence[str] = (),
    right_sums: Sequence[str] = (),
    products: Mapping[str, tuple[str, str]] | None = None,
    pairs: str = "n_pairs",
) -> DataFrame:
    """The aggregates of the inner join of the rows behind two state tables, from the states alone.

    count(*) is the product of the counts; a sum over one side's column is that sum times the other side's count; a sum of
    products of one column from each side (``products``: name -> (left sum, right sum)) is the product of the sums. Minima
    and maxima pass through. All arithmetic is in 38-digit decimals, since pair counts leave 64 bits at scale.
    Every state column must carry a name of its own, apart from ``on`` and the two row counts.
    """
    l_rows, r_rows = "__rows_of_left", "__rows_of_right"
    joined = left.withColumnRenamed(left_rows, l_rows).join(right.withColumnRenamed(right_rows, r_rows), list(on))
    wide = lambda c: F.col(c).cast(WIDE)
    out = {pairs: (wide(l_rows) * wide(r_rows)).cast(WIDE)}
    out |= {name: (wide(a) * wide(b)).cast(WIDE) for name, (a, b) in (products or {}).items()}
    out |= {c: (wide(c) * wide(r_rows)).cast(WIDE) for c in left_sums}
    out |= {c: (wide(c) * wide(l_rows)).cast(WIDE) for c in right_sums}
    return joined.select("*", *[v.alias(f"__new_{k}") for k, v in out.items()]).select(
        *[c for c in joined.columns if c not in out and c not in (l_rows, r_rows)],
        *[F.col(f"__new_{k}").alias(k) for k in out],
        F.col(l_rows).alias("left_rows"),
        F.col(r_rows).alias("right_rows"),
    )


def heavy_keys(rows: DataFrame, within: Sequence[str], key: str, percent: int) -> DataFrame:
    """Keys holding at least ``percent`` % of the rows with a key, within each combination of ``within``.

    The rows are joined with all rows of their own table (``within``) by eager aggregation: the left states count each key, the
    right ones the table, a product of counts is the number of joined rows of a key, and rolled up after the join they are
    those of the table. A key is heavy if that share of the joined rows is its own. However many rows a key has, the join is on a
    row for each key; the states of the table are combined from those of its keys, so the rows are read once. Rows count as
    they are, copies included; rows whose key is missing (NULL, ``.`` or ``NONE``) count neither way. An empty table gives no row.
    """
    states = compact(rows.filter(present(key)), [*within, key])
    joined = join_states(states, rollup(states, within, sums=["n_rows"]), within)
    whole = rollup(joined, within, sums=["n_pairs"]).withColumnRenamed("n_pairs", "all_pairs")
    return joined.join(whole, list(within)).filter(F.col("n_pairs") * 100 >= F.col("all_pairs") * percent).select(*within, key, F.col("left_rows").cast("bigint").alias("n_rows"))
