"""Interval algebra on half-open integer intervals [start, end) per sequence.

Nothing here gathers a whole sequence in one task. Running quantities along a sequence are computed in ranges of coordinates,
with what earlier ranges carry over joined on (one row for each range), and equal intervals are counted together first. Joins
between intervals are equi-joins on coordinate bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.periods import periods_and_gaps

WIDTH = 1 << 18


def _there(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def carried(df: DataFrame, keys: Sequence[str], at: str, order: Sequence[str | Column], columns: dict[str, tuple[str, Column, int]], width: int = WIDTH) -> DataFrame:
    """Running sums and maxima along ``at`` within ``keys``, exactly, in ranges of ``width``.

    ``columns``: name -> ('sum' or 'max', expression, last): over all rows before, up to and with the row (last = 0) or up to
    the one before it (last = -1), in the order of ``at`` and then ``order``. An empty frame gives NULL, for a sum 0.
    """
    df = df.withColumn("__range", F.floor(F.col(at) / F.lit(width)).cast("bigint"))
    line = Window.partitionBy(*keys, "__range").orderBy(at, *order)
    agg = {"sum": F.sum, "max": F.max}
    within = df
    for name, (kind, e, last) in columns.items():
        within = within.withColumn(f"__in_{name}", agg[kind](e).over(line.rowsBetween(Window.unboundedPreceding, last)))
    totals = df.groupBy(*keys, "__range").agg(*[agg[kind](e).alias(f"__all_{name}") for name, (kind, e, _) in columns.items()])
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, "__range", *[agg[kind](f"__all_{name}").over(earlier).alias(f"__carry_{name}") for name, (kind, _, _) in columns.items()])
    carry = carry.filter(" or ".join(f"__carry_{name} is not null" for name in columns))
    joined = within.join(carry, [*keys, "__range"], "left")
    out = []
    for name, (kind, _, _) in columns.items():
        a, b = F.col(f"__in_{name}"), F.col(f"__carry_{name}")
        out.append((F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)) if kind == "sum" else F.greatest(a, b)).alias(name))
    return joined.select(*[c for c in df.columns if c != "__range"], *out)


def distinct_spans(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    return _there(df, [*keys, start, end]).groupBy(*keys, F.col(start).cast("bigint").alias("start"), F.col(end).cast("bigint").alias("end")).agg(F.count(F.lit(1)).alias("n"))


def cluster_spans(df: DataFrame, keys: Sequence[str], start: str, end: str, d: int, width: int = WIDTH) -> DataFrame:
    """Distinct intervals (keys, start, end, n copies) with the number of their cluster within the keys, from 1.

    A new cluster begins where start > d + the greatest end so far (not only the end before). Rows with a NULL are left out.
    """
    spans = distinct_spans(df, keys, start, end)
    reached = carried(spans, keys, "start", ["end"], {"reach": ("max", F.col("end"), -1)}, width)
    fresh = reached.withColumn("fresh", F.when(F.col("reach").isNull() | (F.col("start") > F.col("reach") + d), 1).otherwise(0)).drop("reach")
    return carried(fresh, keys, "start", ["end"], {"cluster": ("sum", F.col("fresh"), 0)}, width).drop("fresh")


def cluster(df: DataFrame, keys: Sequence[str], start: str, end: str, d: int, width: int = WIDTH) -> DataFrame:
    """The rows with their cluster number; rows with a NULL in keys or coordinates are left out."""
    numbered = cluster_spans(df, keys, start, end, d, width).select(*keys, F.col("start").alias(start), F.col("end").alias(end), "cluster")
    return _there(df, [*keys, start, end]).join(numbered, [*keys, *dict.fromkeys([start, end])])


def merge(df: DataFrame, keys: Sequence[str], start: str, end: str, d: int, width: int = WIDTH) -> DataFrame:
    """One row (keys, start, end, n) for each cluster."""
    spans = cluster_spans(df, keys, start, end, d, width)
    return spans.groupBy(*keys, "cluster").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")).drop("cluster")


def complement(df: DataFrame, sizes: DataFrame, keys: Sequence[str], start: str, end: str, size: str, width: int = WIDTH) -> DataFrame:
    """What [0, size) of every sequence the intervals leave free, both ends included; whole sequences where there is none.

    Intervals are clipped to the sequence; those of unknown sequences count for nothing.
    """
    known = _there(sizes, [*keys, size]).groupBy(*keys).agg(F.max(size).alias("__size"))
    clipped = _there(df, [*keys, start, end]).join(known, list(keys)).select(*keys, F.greatest(F.col(start), F.lit(0)).alias("lo"), F.least(F.col(end), F.col("__size")).alias("hi"))
    # Empty sentinels at both ends would be no intervals; one base outside on either side is.
    outside = known.select(*keys, F.explode(F.array(F.struct(F.lit(-1).cast("bigint").alias("lo"), F.lit(0).cast("bigint").alias("hi")), F.struct(F.col("__size").alias("lo"), (F.col("__size") + 1).alias("hi")))).alias("p")).select(*keys, "p.*")
    return periods_and_gaps(clipped.unionByName(outside), keys, width=width).filter("kind = 'gap'").select(*keys, F.col("seg_start").alias("start"), F.col("seg_end").alias("end"))


def _binned(df: DataFrame, start: Column, end: Column, bin_size: int) -> DataFrame:
    first, last = F.floor(start / bin_size), F.floor(F.greatest(end - 1, start) / bin_size)
    return df.withColumn("__first", first.cast("bigint")).withColumn("__bin", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))))


def window_join(a: DataFrame, b: DataFrame, on: Sequence[str], a_span: tuple[str, str], b_span: tuple[str, str], window: int = 0, how: str = "inner", bin_size: int = 1 << 14) -> DataFrame:
    """Pairs of rows equal in ``on`` with b.start < a.end + window and b.end > a.start - window; both bounds are strict.

    Columns of ``b`` other than ``on`` must have names of their own. ``how``: inner, left_semi or left_anti (rows of ``a``, each
    once as it is there). Rows with a NULL in keys or coordinates match nothing. Each interval is put into every bin it
    touches, and of the bins two intervals share only the first gives the pair, so each pair comes once. ``bin_size`` should
    be near the usual length of an interval plus window: longer ones only cost more copies.
    """
    (s, e), (t, u) = a_span, b_span
    if how != "inner":
        keys = _there(a, [*on, s, e]).select(*on, s, e).distinct()
        hits = window_join(keys, _there(b, [*on, t, u]).select(*on, F.col(t).alias("__t"), F.col(u).alias("__u")).distinct(), on, a_span, ("__t", "__u"), window, "inner", bin_size).select(*on, s, e).distinct()
        return a.join(hits, [*on, s, e], how)
    left = _binned(_there(a, [*on, s, e]), F.col(s) - window, F.col(e) + window, bin_size)
    right = _binned(_there(b, [*on, t, u]), F.col(t), F.col(u), bin_size).withColumnRenamed("__first", "__first_b")
    pairs = left.join(right, [*on, "__bin"])
    near = (F.col(t) < F.col(e) + window) & (F.col(u) > F.col(s) - window)
    return pairs.filter(near & (F.col("__bin") == F.greatest("__first", "__first_b"))).drop("__bin", "__first", "__first_b")


def overlap(a_start: str, a_end: str, b_start: str, b_end: str) -> Column:
    return F.greatest(F.least(F.col(a_end), F.col(b_end)) - F.greatest(F.col(a_start), F.col(b_start)), F.lit(0))


def subtract(a: DataFrame, b: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", bin_size: int = 1 << 14, width: int = WIDTH) -> DataFrame:
    """The pieces of every row of ``a`` that no interval of ``b`` covers: the columns of ``a`` with piece_start, piece_end.

    A row without an overlap is its own piece; an empty interval has none.
    """
    a = _there(a, [*keys, start, end]).filter(F.col(end) > F.col(start))
    reach = a.groupBy(*keys).agg(F.min(start).alias("__lo"), F.max(end).alias("__hi"))
    outside = reach.select(*keys, F.explode(F.array(F.struct((F.col("__lo") - 1).alias("lo"), F.col("__lo").alias("hi")), F.struct(F.col("__hi").alias("lo"), (F.col("__hi") + 1).alias("hi")))).alias("p")).select(*keys, "p.*")
    covered = _there(b, [*keys, start, end]).select(*keys, F.col(start).alias("lo"), F.col(end).alias("hi"))
    free = periods_and_gaps(covered.unionByName(outside), keys, width=width).filter("kind = 'gap'").select(*keys, F.col("seg_start").alias("__s"), F.col("seg_end").alias("__e"))
    pairs = window_join(a, free, keys, (start, end), ("__s", "__e"), 0, "inner", bin_size)
    return pairs.withColumn("piece_start", F.greatest(start, "__s")).withColumn("piece_end", F.least(end, "__e")).drop("__s", "__e")


def depth_at(points: DataFrame, blocks: DataFrame, keys: Sequence[str], at: str, block: tuple[str, str], width: int = WIDTH) -> DataFrame:
    """The distinct points (keys, at) with the number of blocks [start, end) that hold them; 0 where none does.

    That is the starts up to the point less the ends up to it: one running sum over both, without a pair of point and block.
    Rows with a NULL, and blocks that end where they begin or before, count for nothing.
    """
    b = _there(blocks, [*keys, *block]).filter(F.col(block[0]) < F.col(block[1]))
    steps = b.select(*keys, F.explode(F.array(*[F.struct(F.col(c).cast("bigint").alias("__at"), F.lit(n).cast("bigint").alias("__step"), F.lit(False).alias("__point")) for c, n in zip(block, (1, -1), strict=True)])).alias("p")).select(*keys, "p.*")
    spots = _there(points, [*keys, at]).select(*keys, F.col(at).cast("bigint").alias("__at"), F.lit(0).cast("bigint").alias("__step"), F.lit(True).alias("__point"))
    both = steps.unionByName(spots).groupBy(*keys, "__at").agg(F.sum("__step").alias("__step"), F.max("__point").alias("__point"))
    depths = carried(both, keys, "__at", [], {"depth": ("sum", F.col("__step"), 0)}, width)
    return depths.filter("__point").select(*keys, F.col("__at").alias(at), "depth")


def running_offset(df: DataFrame, keys: Sequence[str], start: str, size: str, tie: Sequence[str], width: int = WIDTH) -> DataFrame:
    """Each row with ``new_start``: its start shifted by the sizes of all rows before it on the sequence."""
    there = _there(df, [*keys, start, size])
    moved = carried(there, keys, start, tie, {"shift": ("sum", F.col(size), -1)}, width)
    return moved.withColumn("new_start", F.col(start) + F.col("shift")).drop("shift")


def consecutive_dedupe(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Drop each row whose value equals that of the row before it within the keys (say a cluster); NULL equals NULL."""
    line = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__before", F.lag(value).over(line)).withColumn("__first", F.row_number().over(line) == 1).filter(F.col("__first") | ~F.col("__before").eqNullSafe(F.col(value))).drop("__before", "__first")


def flanks(df: DataFrame, start: str, end: str, size: int, limit: Column | None = None) -> DataFrame:
    """Two rows for each: side L [start - size, start) and R [end, end + size), clamped to 0 and ``limit``."""
    top = (lambda c: F.least(c, limit)) if limit is not None else (lambda c: c)
    lo = lambda c: F.greatest(c, F.lit(0))
    parts = F.array(F.struct(F.lit("L").alias("side"), lo(F.col(start) - size).alias("flank_start"), top(F.col(start)).alias("flank_end")), F.struct(F.lit("R").alias("side"), lo(F.col(end)).alias("flank_start"), top(F.col(end) + size).alias("flank_end")))
    return df.withColumn("__p", F.explode(parts)).select(*df.columns, "__p.side", "__p.flank_start", "__p.flank_end")


def unique_anchors(df: DataFrame, query: str, start: str, end: str, least: int, row: str, width: int = WIDTH) -> DataFrame:
    """Mark alignments by the length of the query they alone cover: columns unique_length and tag (unique or repetitive).

    Stretches of each query where exactly one alignment lies are its unique stretches. An alignment is kept as unique if the
    unique stretches inside it reach ``least``; one alone on its query is by its whole length. Ends may come in either
    order. Rows with a NULL or empty span are left out. ``row`` must tell rows apart.
    """
    spans = _there(df, [query, start, end]).withColumn("__s", F.least(start, end)).withColumn("__e", F.greatest(start, end)).filter("__s < __e")
    events = spans.select(query, F.explode(F.array(F.struct(F.col("__s").alias("at"), F.lit(1).alias("step")), F.struct(F.col("__e").alias("at"), F.lit(-1).alias("step")))).alias("p")).select(query, "p.*")
    steps = events.groupBy(query, "at").agg(F.sum("step").alias("step"))
    cover = carried(steps, [query], "at", [], {"cover": ("sum", F.col("step"), 0)}, width)
    # A stretch of one alignment runs from the point where the cover becomes 1 to the next point.
    points = cover.select(query, "at", "cover")
    follow = _next_point(points, query, width)
    alone = follow.filter("cover = 1").select(query, F.col("at").alias("__us"), F.col("after").alias("__ue"))
    hits = window_join(spans.select(query, row, "__s", "__e"), alone, [query], ("__s", "__e"), ("__us", "__ue")).groupBy(row).agg(F.sum(F.col("__ue") - F.col("__us")).alias("unique_length"))
    marked = spans.join(hits, [row], "left").withColumn("unique_length", F.coalesce("unique_length", F.lit(0)))
    return marked.withColumn("tag", F.when(F.col("unique_length") >= least, "unique").otherwise("repetitive")).drop("__s", "__e")


def _next_point(points: DataFrame, key: str, width: int) -> DataFrame:
    """Each point with the next greater one of its key (NULL for the last), in ranges."""
    ranged = points.withColumn("__range", F.floor(F.col("at") / F.lit(width)).cast("bigint"))
    inside = ranged.withColumn("__in", F.lead("at").over(Window.partitionBy(key, "__range").orderBy("at")))
    firsts = ranged.groupBy(key, "__range").agg(F.min("at").alias("__min"))
    later = firsts.select(key, "__range", F.lead("__min").over(Window.partitionBy(key).orderBy("__range")).alias("__later")).filter("__later is not null")
    return inside.join(later, [key, "__range"], "left").withColumn("after", F.coalesce("__in", "__later")).drop("__in", "__later", "__range")
