"""Summaries for reports, the fact table, and what is exported from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def family_split(df: DataFrame, family: str, condition: Column, yes: str, no: str) -> DataFrame:
    """Counts of a condition for each family in long form (x, y, condition), with zeros for what doesn't occur."""
    counts = df.groupBy(F.col(family).alias("x")).agg(F.count_if(condition).alias("a"), F.count_if(~F.coalesce(condition, F.lit(False))).alias("b"))
    return counts.select("x", F.explode(F.array(F.struct(F.col("a").alias("y"), F.lit(yes).alias("condition")), F.struct(F.col("b").alias("y"), F.lit(no).alias("condition")))).alias("r")).select("x", "r.*")


def strand_counts(df: DataFrame, family: str, strand: str) -> DataFrame:
    """Forward and reverse for each family, reverse negative; what isn't - counts as forward."""
    return df.groupBy(F.col(family).alias("x")).agg(F.count_if(~F.coalesce(F.col(strand) == "-", F.lit(False))).alias("forward"), (-F.count_if(F.col(strand) == "-")).alias("reverse"))


def frequency_bins(df: DataFrame, family: str, value: str, bounds: Sequence[int] = (0, 2, 9, 15, 50, 100)) -> DataFrame:
    """Rows for each family and bin of percent (x, y, condition); the first bin holds its lower bound, all hold the upper.

    Values outside the bins and NULLs are left out; every family with a value in some bin comes with all bins.
    """
    v = F.col(value)
    labels = [f"{a}-{b}(%)" for a, b in zip(bounds, bounds[1:], strict=False)]
    bins = [((v >= a) if i == 0 else (v > a)) & (v <= b) for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
    kept = df.filter(v.between(bounds[0], bounds[-1]))
    counts = kept.groupBy(F.col(family).alias("x")).agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(bins)])
    return counts.select("x", F.explode(F.array(*[F.struct(F.col(f"c{i}").alias("y"), F.lit(n).alias("condition")) for i, n in enumerate(labels)])).alias("r")).select("x", "r.*")


def stacked(df: DataFrame, conditions: Sequence[str], rank: DataFrame | None = None) -> DataFrame:
    """Long counts (x, y, condition) as one row for each x with a column for each condition, its total and place.

    Places follow ``rank`` (x, rank) if given, unranked ones last, else the total, then x.
    """
    wide = df.groupBy("x").agg(*[F.coalesce(F.sum(F.when(F.col("condition") == c, F.col("y"))), F.lit(0)).alias(c) for c in conditions], F.sum("y").alias("total"))
    if rank is None:
        ordered = wide.withColumn("__o", F.col("total"))
    else:
        ordered = wide.join(rank.select("x", F.col("rank").alias("__o")), "x", "left")
    # One row for each family: a dimension, so one task may order it.
    return ordered.withColumn("place", F.row_number().over(Window.orderBy(F.col("__o").asc_nulls_last(), "x")).cast("bigint")).drop("__o")


def top_grid(df: DataFrame, x: str, y: str, n: int = 50) -> DataFrame:
    """Counts of the n most frequent x over all y that occur with them, zero where a pair doesn't occur."""
    counts = df.groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count(F.lit(1)).alias("z"))
    top = counts.groupBy("x").agg(F.sum("z").alias("total")).orderBy(F.col("total").desc(), "x").limit(n).select("x")
    some = counts.join(F.broadcast(top), "x")  # n rows
    # n families by the few values of y: one task may hold them.
    whole = some.withColumn("__ys", F.collect_set("y").over(Window.partitionBy()))
    grid = whole.groupBy("x").agg(F.max(F.array_sort("__ys")).alias("__ys")).select("x", F.explode("__ys").alias("y"))
    return grid.join(some, ["x", "y"], "left").select("x", "y", F.coalesce("z", F.lit(0)).alias("z"))


def durations(df: DataFrame, keys: Sequence[str], start: str, order: Sequence[str]) -> DataFrame:
    """Each event with ``stop``, the start of the next one of its keys, and ``seconds`` between (NULL for the last)."""
    line = Window.partitionBy(*keys).orderBy(start, *order)
    return df.withColumn("stop", F.lead(start).over(line)).withColumn("seconds", F.unix_timestamp("stop") - F.unix_timestamp(start))


def run_log(lines: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, category, start) of the steps in the log of a run (line_no, value): each ``rule NAME:`` with the ``[date]`` in the line before (F16).

    Dates are like ``[Wed Oct 18 14:20:11 2023]``. Other lines, and rules without a date, are left out.
    """
    w = Window.partitionBy(*keys).orderBy("line_no") if keys else Window.orderBy("line_no")
    date = F.regexp_extract(F.lag("value").over(w), r"^\[\w+ +(\w+ +\d+ +[\d:]+ +\d+)\]", 1)
    start = F.try_to_timestamp(F.regexp_replace(date, " +", " "), F.lit("MMM d HH:mm:ss yyyy"))
    steps = lines.withColumn("start", start).filter("value like 'rule %' and start is not null")
    return steps.select(*keys, F.regexp_extract("value", r"^rule (\S+?):?\s*$", 1).alias("category"), "start", "line_no")


def first_of(base: DataFrame, key: str, sources: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """The base rows with ``columns`` from the first source that has their key.

    Each source must have a key once; a key is taken from one source as a whole, NULLs included.
    """
    found = base
    for i, s in enumerate(sources):
        found = found.join(s.select(key, F.struct(*columns).alias(f"__s{i}")), key, "left")
    pick = F.coalesce(*[f"__s{i}" for i in range(len(sources))])
    return found.withColumn("__pick", pick).select(*base.columns, *[F.col(f"__pick.{c}").alias(c) for c in columns])


MATCHED = ("pident", "psize_te", "size_el", "kind", "support")
FACTS = ("chrom", "start", "end", "te", "ident", "strand", "tsd", "pident", "psize_te", "size_te", "new_pos", "freq", "freq_with_clipped", "sv_size", "sv_id", "sv_type")


def gathered(sources: Mapping[str, tuple[DataFrame, Sequence[str]]], key: str) -> DataFrame:
    """One row for each key of any source, with a struct of the named columns for each source (name -> source, columns), NULL where it
    doesn't know the key. Of several rows of a key in one source the greatest counts. All sources share one shuffle by key."""
    kinds = {n: df.select(F.struct(*columns).alias("s")).schema["s"].dataType for n, (df, columns) in sources.items()}
    parts = [df.filter(F.col(key).isNotNull()).select(key, *[(F.struct(*columns) if m == n else F.lit(None).cast(k)).alias(m) for m, k in kinds.items()]) for n, (df, columns) in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(key).agg(*[F.max(n).alias(n) for n in kinds])


def first_match(*names: str) -> Column:
    """The struct of the first source that knows the identifier."""
    return F.coalesce(*[F.col(n) for n in names])


def first_frequency(*names: str) -> Column:
    """The first struct (freq, freq_with_clipped) in which both are at most 100, and the last one as it is."""
    return F.coalesce(*[F.when((F.col(n)["freq"] <= 100) & (F.col(n)["freq_with_clipped"] <= 100), F.col(n)) for n in names[:-1]], F.col(names[-1]))


def fact_table(sites: DataFrame, known: DataFrame, match: Column, frequency: Column, size: Column, sv_id: Column, sv_type: Column, duplication: str = "duplication") -> DataFrame:
    """The wide fact table (J8): what the sources say of each site, joined by its identifier.

    ``sites``: chrom, start, end, te, ident, strand, and what else the columns are made from. ``known``: one row for each ident with
    what the sources know (see ``gathered``), among it a struct ``duplication`` of tsd, size_te, new_pos. ``match`` is a struct with
    ``MATCHED``, ``frequency`` one of freq and freq_with_clipped, both picked from the sources in order of trust; ``sv_id`` and ``sv_type``
    may use the columns of the match. Without a duplication the size is that of the match, the place the site's own. Sites that no
    source knows stay, with NULLs; rows come as often as ``sites`` has them.
    """
    there = sites.join(known, "ident", "left").withColumn("__m", match).withColumn("__f", frequency).withColumn("sv_size", size)
    d = F.col(duplication)
    made = there.withColumns({c: F.col("__m")[c] for c in MATCHED}).withColumns({c: F.col("__f")[c] for c in ("freq", "freq_with_clipped")})
    made = made.withColumn("tsd", d["tsd"]).withColumn("size_te", F.when(d["tsd"].isNotNull(), d["size_te"]).otherwise(F.col("size_el"))).withColumn("new_pos", F.coalesce(d["new_pos"], "start"))
    return made.withColumn("sv_id", sv_id).withColumn("sv_type", sv_type).select(*FACTS)


def outsider_id(number) -> Column:
    """Identifier of a site from reads: that of the call where it is clipped, else from place, kind and support; ``number`` makes a
    number of a text (``chain_id``)."""
    place = number(F.concat_ws(":", "chrom", F.col("start").cast("string"))).cast("string")
    return F.when(F.col("ident").rlike("SOFT|HARD"), F.concat(F.lit("TE_ID_OUTSIDER."), "ident")).otherwise(F.concat_ws(".", F.lit("TE_ID_OUTSIDER"), place, "kind", F.coalesce(F.col("support").cast("string"), F.lit("0"))))


def insider_id(number) -> Column:
    place = number(F.concat_ws(":", "chrom", F.col("start").cast("string"))).cast("string")
    return F.concat_ws(".", F.lit("TE_ID_INSIDER"), place, F.coalesce("kind", F.lit("UNKNOWN")))


def variant_size(sv_type: Column, size: Column, query_dist: Column) -> Column:
    """The size of an assembly variant: deletions by size, insertions by their length on the query, NULL for other kinds."""
    gone, added = ("Deletion", "Repeat_contraction", "Tandem_contraction"), ("Insertion", "Repeat_expansion", "Tandem_expansion")
    return F.when(sv_type.isin(*gone), size).when(sv_type.isin(*added), query_dist)


def priority_union(sources: Sequence[DataFrame], key: str) -> DataFrame:
    """All rows of the first source, then those of each next one whose key no earlier source has."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s.join(out.select(key).distinct(), key, "left_anti"))
    return out


# The layouts of circular plots: the fields of one datum.
LAYOUTS: Mapping[str, Sequence[str]] = {
    "SCATTER": ("chr", "start", "end", "name", "des"), "SNP": ("chr", "pos", "value", "des", "color"), "ARC": ("chr", "start", "end", "color", "des"), "HEATMAP": ("chr", "start", "end", "name", "value"),
    "LINE": ("chr", "pos", "value"), "HISTOGRAM": ("chr", "start", "end", "name", "value"), "LINK": ("fusion", "g1chr", "g1start", "g1end", "g1name", "g2chr", "g2start", "g2end", "g2name"), "CNV": ("chr", "start", "end", "value"),
}


def plot_data(df: DataFrame, layout: str) -> DataFrame:
    """One JSON object for each row with the fields of a layout, all as text; rows with a NULL keep the field out."""
    return df.select(F.to_json(F.struct(*[F.col(f).cast("string").alias(f) for f in LAYOUTS[layout]])).alias("datum"))


def row_index(df: DataFrame, key: str, at: str) -> DataFrame:
    """(key, n_rows, lowest, highest): where the rows of each key lie, as an index for reading one of them (K6)."""
    return df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"), F.min(at).alias("lowest"), F.max(at).alias("highest"))


def json_rows(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.select(F.to_json(F.struct(*fields)).alias("datum"))


def sentinels(df: DataFrame, signs: Mapping[str, str]) -> DataFrame:
    """For exports: NULL of each named column as its sign of missing, everything as text."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(signs[c])).alias(c) if c in signs else F.col(c) for c in df.columns])
