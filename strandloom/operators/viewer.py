"""Hits as the hit viewer shows them, and the questions it answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AXIS = 500


def geometry(df: DataFrame, sstart: str, send: str, qstart: str, qend: str, subject: str, query: str) -> DataFrame:
    """Pixels of each hit on an axis of 500, against the subject's length and scaled to the query's: lead, place and size.

    Shares are whole percents, halves rounded up, and pixels are cut to whole numbers, all in integers. Adds strand, lead0,
    lead1, posq0, posq1, size0, size1; a length of 0 gives NULL. Coordinates outside the sequences are taken as they are: parts
    may be negative, where shares are rounded in the same way and pixels cut toward 0.
    """
    s, e, q = F.least(sstart, send), F.greatest(sstart, send), F.least(qstart, qend)
    down = F.col(sstart) > F.col(send)
    named = df.withColumn("__sub", F.nullif(F.col(subject), F.lit(0))).withColumn("__que", F.nullif(F.col(query), F.lit(0)))
    percent = lambda part, whole: F.floor((200 * part + F.col(whole)) / (2 * F.col(whole))).cast("bigint")
    named = named.withColumn("__lead", percent(F.when(down, F.col("__sub") - e).otherwise(s - 1), "__sub")).withColumn("__share", percent(e - s, "__sub")).withColumn("__place", percent(q - 1, "__que"))
    plain = lambda c: F.expr(f"{AXIS} * {c} div 100")
    scaled = lambda c: F.expr(f"{AXIS} * __sub * {c} div (100 * __que)")
    named = named.withColumn("strand", F.when(down, -1).otherwise(1).cast("bigint")).withColumn("lead0", plain("__lead")).withColumn("lead1", scaled("__lead"))
    named = named.withColumn("posq0", plain("__place") - F.col("lead0")).withColumn("posq1", plain("__place") - F.col("lead1")).withColumn("size0", plain("__share")).withColumn("size1", scaled("__share"))
    return named.drop("__sub", "__que", "__lead", "__share", "__place")


def complete(df: DataFrame, name: str, parts: Sequence[str], limit: int = 20) -> DataFrame:
    """Up to ``limit`` names that hold any of the parts in any case, in order; all names without parts."""
    names = df.select(name).filter(F.col(name).isNotNull()).distinct()
    if parts:
        low = F.lower(name)
        wanted = F.lit(False)
        for p in parts:
            wanted = wanted | low.contains(p.lower())
        names = names.filter(wanted)
    return names.orderBy(name).limit(limit)


def groups(hits: DataFrame, chrom: str | None = None, elements: Sequence[str] = ()) -> DataFrame:
    """Hits grouped by query and element with the best bitscore and number of hits, for a chromosome or elements."""
    if chrom is not None:
        hits = hits.filter(F.split_part("qseqid", F.lit(":"), F.lit(1)) == chrom)
    if elements:
        hits = hits.filter(F.col("sseqid").isin(*elements))
    return hits.groupBy("qseqid", "sseqid").agg(F.max("bitscore").alias("best"), F.count(F.lit(1)).alias("n_hits"), F.min("line_no").alias("line_no"))


def chromosomes(hits: DataFrame) -> DataFrame:
    """(chrom, n_groups, n_hits) of every chromosome that hits lie on."""
    g = groups(hits).withColumn("chrom", F.split_part("qseqid", F.lit(":"), F.lit(1)))
    return g.groupBy("chrom").agg(F.count(F.lit(1)).alias("n_groups"), F.sum("n_hits").alias("n_hits"))


def by_position(hits: DataFrame, chrom: str | None = None, elements: Sequence[str] = ()) -> DataFrame:
    """Hit groups with their place, sorted by it."""
    part = lambda i: F.split_part("qseqid", F.lit(":"), F.lit(i))
    g = groups(hits, chrom, elements).withColumn("chrom", part(1)).withColumn("start", part(3).try_cast("bigint"))
    return g.select("chrom", "start", "qseqid", "sseqid", "best", "n_hits", "line_no").orderBy("chrom", "start", "qseqid", "sseqid")


def facts(df: DataFrame, ident: str) -> DataFrame:
    return df.filter(F.col("sv_id") == ident)
