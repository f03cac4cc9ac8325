"""Covered periods and gaps of overlapping intervals per entity, from two independent sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def axis_intervals(df: DataFrame, keys: Sequence[str], axes: dict[str, tuple[str, str]]) -> DataFrame:
    """One interval (keys, axis, lo, hi) for each axis of each row, in one scan.

    The two ends may come in either order. Rows with a NULL key are left out; on an axis with a NULL or two equal ends
    the row gives no interval.
    """
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    parts = F.array(*[
        F.struct(F.lit(a).alias("axis"), F.least(F.col(s), F.col(e)).alias("lo"), F.greatest(F.col(s), F.col(e)).alias("hi"), (F.col(s).isNotNull() & F.col(e).isNotNull()).alias("whole"))
        for a, (s, e) in axes.items()
    ])
    return df.select(*keys, F.explode(parts).alias("p")).filter("p.whole and p.lo < p.hi").select(*keys, "p.axis", "p.lo", "p.hi")


def periods_and_gaps(intervals: DataFrame, keys: Sequence[str], lo: str = "lo", hi: str = "hi", width: int = 1 << 18) -> DataFrame:
    """Rows (keys, kind, seg_start, seg_end), kind ``period`` or ``gap``, of intervals [lo, hi) with lo < hi.

    Starts and ends are sorted independently. Between the i-th end and the (i+1)-th start lies a gap exactly where that start
    exceeds that end; the starts and ends that are left when those of all others are closed are paired, the k-th with the k-th.
    Intervals that touch belong to one period. Copies of an interval change nothing. Rows with a NULL, or with lo >= hi, are
    left out; no rows give no rows.

    Intervals are first cut at the borders of ranges of ``width``, where their parts touch, so every range of an entity is
    ranked by itself, in one task of its own, however much of the table the entity holds. Of parts that begin together only
    the longest counts; that is settled before the first shuffle, so a range has at most ``width`` parts. Periods that touch
    the border of a range are joined over it, from one row for each range of an entity.
    """
    names = [f"__key{i}" for i in range(len(keys))]
    there = intervals.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(lo).cast("bigint").alias("lo"), F.col(hi).cast("bigint").alias("hi")).filter("lo < hi")
    for n in names:
        there = there.filter(F.col(n).isNotNull())
    last = F.floor((F.col("hi") - 1) / F.lit(width)).cast("bigint")
    there = there.withColumn("first", F.floor(F.col("lo") / F.lit(width)).cast("bigint"))
    there = there.select(*names, "lo", "hi", F.explode(F.when(F.col("first") == last, F.array("first")).otherwise(F.sequence("first", last))).alias("range"))
    parts = there.select(*names, F.greatest("lo", F.col("range") * width).alias("lo"), F.least("hi", (F.col("range") + 1) * width).alias("hi"))
    parts = parts.groupBy(*names, "lo").agg(F.max("hi").alias("hi")).withColumn("range", F.floor(F.col("lo") / F.lit(width)).cast("bigint"))
    ranked = parts.groupBy(*names, "range").agg(F.sort_array(F.collect_list("lo")).alias("starts"), F.sort_array(F.collect_list("hi")).alias("ends"))
    # starts[i + 1] > ends[i]: a gap. The first start and the last end bound the periods of the range.
    gaps = F.filter(F.zip_with("ends", F.slice("starts", 2, F.greatest(F.size("starts") - 1, F.lit(0))), lambda e, s: F.struct(e.alias("seg_start"), s.alias("seg_end"))), lambda g: g["seg_end"] > g["seg_start"])
    ranked = ranked.select(*names, "range", F.array_min("starts").alias("lo"), F.array_max("ends").alias("hi"), gaps.alias("gaps"))

    line = Window.partitionBy(*names).orderBy("range")
    single = F.size("gaps") == 0
    ranked = ranked.select("*", F.lag("hi").over(line).alias("before"), F.lead("lo").over(line).alias("after"))
    goes_on = F.coalesce(F.col("before") == F.col("lo"), F.lit(False))  # the first period began in an earlier range
    # Where the last period of this range began; NULL where it is the first one and that began earlier.
    began = F.when(single, F.when(~goes_on, F.col("lo"))).otherwise(F.col("gaps")[F.size("gaps") - 1]["seg_end"])
    opened = F.last("began", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1))
    ranked = ranked.withColumn("goes_on", goes_on).withColumn("began", began).withColumn("opened", opened)
    ends_here = F.coalesce(F.col("after") != F.col("hi"), F.lit(True))
    opens = F.concat(F.array(F.when(F.col("goes_on"), F.col("opened")).otherwise(F.col("lo"))), F.transform("gaps", lambda g: g["seg_end"]))
    closes = F.concat(F.transform("gaps", lambda g: g["seg_start"]), F.array("hi"))
    periods = F.zip_with(opens, closes, lambda s, e: F.struct(s.alias("seg_start"), e.alias("seg_end")))
    periods = F.when(ends_here, periods).otherwise(F.slice(periods, F.lit(1), F.size(periods) - 1))
    holes = F.when(F.col("before") < F.col("lo"), F.concat(F.array(F.struct(F.col("before").alias("seg_start"), F.col("lo").alias("seg_end"))), F.col("gaps"))).otherwise(F.col("gaps"))
    kind = lambda name, a: F.transform(a, lambda x: F.struct(F.lit(name).alias("kind"), x["seg_start"].alias("seg_start"), x["seg_end"].alias("seg_end")))
    out = ranked.select(*names, F.explode(F.concat(kind("period", periods), kind("gap", holes))).alias("s"))
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "s.kind", "s.seg_start", "s.seg_end")
