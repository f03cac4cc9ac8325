"""Element frequencies over generations: points, merged positions, trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.intervals import cluster


def points(facts: DataFrame, group: str) -> DataFrame:
    """Scatter points of one generation from its fact table (chrom, start, te_id, freq, freq_with_clipped, sv_id, sv_type).

    Only calls from reads with both frequencies that are neither clips nor deletions.
    """
    number = lambda c: F.col(c).try_cast("double")
    kept = facts.filter(F.col("sv_id").contains("OUTSIDER") & ~F.col("sv_id").rlike("HARD|SOFT") & ~F.col("sv_type").rlike("HARD|SOFT|^DEL$") & number("freq").isNotNull() & number("freq_with_clipped").isNotNull() & F.col("chrom").isNotNull())
    te = F.split_part("te_id", F.lit("|"), F.lit(1))
    ident = F.split_part("te_id", F.lit("|"), F.lit(2))
    return kept.select("chrom", F.col("start").cast("bigint").alias("x"), (number("freq") / 100).alias("y1"), (number("freq_with_clipped") / 100).alias("y2"), F.lit(group).alias("group"), F.concat_ws(":", "chrom", "start", te).alias("name"), F.lit("OUTSIDER").alias("in_out"), ident.alias("id"), F.split_part(ident, F.lit("."), F.lit(2)).alias("type"))


def merge_positions(scatter: DataFrame, d: int = 200) -> DataFrame:
    """Points within ``d`` of each other on a chromosome take the first position, in ``x`` and in their names."""
    c = cluster(scatter.withColumn("__end", F.col("x") + 1), ["chrom"], "x", "__end", d)
    first = c.groupBy("chrom", "cluster").agg(F.min("x").alias("__first"))
    joined = c.join(first, ["chrom", "cluster"])
    return joined.withColumn("x", F.col("__first")).withColumn("name", F.concat_ws(":", "chrom", "__first", F.split_part("name", F.lit(":"), F.lit(3)))).drop("cluster", "__end", "__first")


def trends(scatter: DataFrame, manifest: Sequence[tuple[str, int]]) -> DataFrame:
    """The course of each name over the generations of the manifest ((group, number), in order), if it is in two or more.

    sum1 and sum2 begin with the first value over the generation's number (1 at least) and add, for each step, the change in
    percent for each generation times the number of manifest steps. type1, type2: + rises only, - falls only, = stays, ~ else
    (a step without change counts for neither). Of several points of a name in a generation the least (y1, y2) counts. The
    window holds one row for each generation of a name.
    """
    spark = scatter.sparkSession
    order = spark.createDataFrame([(g, i, n) for i, (g, n) in enumerate(manifest)], "group string, ix bigint, num bigint")
    one = scatter.groupBy("name", "group").agg(F.min(F.struct("y1", "y2")).alias("y")).select("name", "group", "y.y1", "y.y2")
    p = one.join(F.broadcast(order), "group")
    line = Window.partitionBy("name").orderBy("ix")
    p = p.withColumn("next", F.lead(F.struct("ix", "num", "y1", "y2")).over(line)).withColumn("place", F.row_number().over(line))
    for i in ("1", "2"):
        rate = (F.col(f"next.y{i}") * 100 - F.col(f"y{i}") * 100) / F.nullif(F.col("next.num") - F.col("num"), F.lit(0))
        p = p.withColumn(f"rate{i}", rate).withColumn(f"part{i}", F.when(F.col("place") == 1, F.col(f"y{i}") / F.greatest("num", F.lit(1))).otherwise(0.0) + F.coalesce(rate * (F.col("next.ix") - F.col("ix")), F.lit(0.0)))
    def kind(i: str):
        up, down = F.max(F.col(f"rate{i}") > 0), F.max(F.col(f"rate{i}") < 0)
        return F.when(up & ~down, "+").when(down & ~up, "-").when(~up & ~down, "=").otherwise("~")

    out = p.groupBy("name").agg(
        F.sum("part1").alias("sum1"), F.sum("part2").alias("sum2"), kind("1").alias("type1"), kind("2").alias("type2"), F.min_by("group", "ix").alias("__from"), F.max_by("group", "ix").alias("__to"), F.count(F.lit(1)).alias("nb_gen"),
    ).filter("nb_gen >= 2")
    return out.select("name", F.split_part("name", F.lit(":"), F.lit(1)).alias("chrom"), F.split_part("name", F.lit(":"), F.lit(2)).try_cast("bigint").alias("x"), "sum1", "sum2", "type1", "type2", F.concat_ws("-", "__from", "__to").alias("gen_inter"), "nb_gen")


def with_trends(scatter: DataFrame, found: DataFrame) -> DataFrame:
    """The points with the trend of their name; NONE where it has none."""
    t = found.select("name", "type1", "type2", F.col("nb_gen").cast("string").alias("nb_gen"))
    return scatter.join(t, "name", "left").fillna("NONE", ["type1", "type2", "nb_gen"])


def keep_trends(found: DataFrame, te: str | None = None, trend: str | None = None, least_generations: int = 0, chrom: str | None = None) -> DataFrame:
    """Filters of the trend graph: by element, trend sign, number of generations, chromosome."""
    if te is not None:
        found = found.filter(F.split_part("name", F.lit(":"), F.lit(3)) == te)
    if trend is not None:
        found = found.filter(F.col("type1") == trend)
    if chrom is not None:
        found = found.filter(F.col("chrom") == chrom)
    return found.filter(F.col("nb_gen") >= least_generations)
