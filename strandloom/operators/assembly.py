"""Variants from alignments of assemblies: neighbours, classification between and within alignments, gaps, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.cigar import walk
from strandloom.operators.intervals import WIDTH, merge, window_join


def neighbours(df: DataFrame, keys: Sequence[str], at: str, order: Sequence[str], take: Sequence[str], width: int = WIDTH) -> DataFrame:
    """Each row with ``before``: a struct of ``take`` of the row before it within the keys; its fields are NULL for the first.

    Rows are compared in ranges of ``at``; the last row of each range is handed to the next one that has rows.
    """
    values = F.struct(*take)
    ranged = df.withColumn("__range", F.floor(F.col(at) / F.lit(width)).cast("bigint"))
    inside = ranged.withColumn("__in", F.lag(values).over(Window.partitionBy(*keys, "__range").orderBy(at, *order)))
    lasts = ranged.groupBy(*keys, "__range").agg(F.max_by(values, F.struct(at, *order)).alias("__last"))
    given = lasts.select(*keys, "__range", F.lag("__last").over(Window.partitionBy(*keys).orderBy("__range")).alias("__given")).filter("__given is not null")
    return inside.join(given, [*keys, "__range"], "left").withColumn("before", F.coalesce("__in", "__given")).drop("__in", "__given", "__range")


def classify_between(rdist: Column, qdist: Column, same_reference: Column, same_strand_flip: Column, least_near: int = 50, most: int = 20_000, long_query: int = 100_000) -> Column:
    """The kind of variant between two neighbouring alignments from their distances on reference and query; NULL for none.

    ``same_strand_flip``: the two alignments run in different directions (an inversion).
    """
    size = F.abs(rdist - qdist)
    insertion = (rdist > -least_near) & (rdist < least_near) & (qdist > -least_near)
    deletion = (rdist > -least_near) & (qdist > -least_near) & (qdist < least_near)
    tandem = (rdist < 0) | (qdist < 0)
    kind = (
        F.when(~same_reference, "Interchromosomal").when(same_strand_flip, "Inversion")
        .when(qdist > rdist, F.when(insertion, "Insertion").when(tandem, "Tandem_expansion").otherwise("Repeat_expansion"))
        .when(qdist < rdist, F.when(deletion, "Deletion").when(tandem, "Tandem_contraction").otherwise("Repeat_contraction"))
    )
    return F.when((size > most) & (F.abs(qdist) > long_query), F.lit(None).cast("string")).when(kind.isNotNull() & (kind != "Interchromosomal") & (size > most), "Longrange").otherwise(kind)


def between_alignments(df: DataFrame, least_size: int = 50, width: int = WIDTH) -> DataFrame:
    """Variants between alignments that follow each other on a query (rid, qid, rstart, rend, qstart, qend; qend < qstart: reverse).

    Inversions, jumps between references and long-range events are classified but not returned, nor variants below ``least_size``.
    A variant of no extent on the reference gets the end start + 1. Rows with NULLs are left out.
    """
    there = df.dropna(subset=["rid", "qid", "rstart", "rend", "qstart", "qend"])
    forward = F.col("qend") > F.col("qstart")
    a = there.withColumn("lo", F.least("qstart", "qend")).withColumn("forward", forward)
    take = ["rid", "rstart", "rend", "qstart", "qend", "forward"]
    n = neighbours(a, ["qid"], "lo", ["rstart", "rend", "rid", "qstart", "qend"], take, width).filter("before.rid is not null")
    i, j = (lambda c: F.col(f"before.{c}")), F.col
    f, g = i("forward"), j("forward")
    rdist = F.when(f & g, j("rstart") - i("rend")).when(~f & ~g, i("rstart") - j("rend")).when(f, j("rstart") - i("rend")).otherwise(i("rstart") - j("rend"))
    qdist = F.when(f & g, j("qstart") - i("qend")).when(~f & ~g, j("qend") - i("qstart")).when(f, j("qend") - i("qend")).otherwise(i("qend") - j("qend"))
    left = F.when(f, i("rend")).otherwise(i("rstart"))
    right = F.when(g, j("rstart")).otherwise(j("rend"))
    n = n.withColumn("ref_dist", rdist).withColumn("query_dist", qdist).withColumn("sv_type", classify_between(rdist, qdist, i("rid") == j("rid"), f != g))
    n = n.withColumn("size", F.abs(F.col("ref_dist") - F.col("query_dist"))).withColumn("start", F.least(left, right)).withColumn("stop", F.greatest(left, right))
    kept = n.filter(~F.col("sv_type").isin("Inversion", "Interchromosomal", "Longrange") & (F.col("size") >= least_size))
    return kept.select("rid", "start", F.when(F.col("start") == F.col("stop"), F.col("stop") + 1).otherwise(F.col("stop")).alias("stop"), "size", "sv_type", "ref_dist", "query_dist", "qid")


def within_alignment(df: DataFrame, chrom: str, pos: str, cigar: str, least: int = 50) -> DataFrame:
    """Insertions and deletions of at least ``least`` bases inside alignments, with their spans on the reference.

    A deletion covers the reference from where it begins; an insertion is a point, given the end start + 1.
    """
    ops = df.withColumn("__op", F.explode(walk(F.col(cigar)))).filter(F.col("__op.op").isin("I", "D") & (F.col("__op.len") >= least))
    deleted = F.col("__op.op") == "D"
    at = F.col(pos) + F.col("__op.ref")
    return ops.select(*df.columns, F.when(deleted, at - F.col("__op.len")).otherwise(at).alias("start"), F.when(deleted, at).otherwise(at + 1).alias("stop"), F.col("__op.len").alias("size"), F.when(deleted, "Deletion").otherwise("Insertion").alias("sv_type"), F.col("__op.i").alias("op_ix"))


def gap_share(variants: DataFrame, gaps: DataFrame, on: Sequence[str], span: tuple[str, str], gap: tuple[str, str], name: str, row: str) -> DataFrame:
    """Each variant with the share of its span that lies in gaps, overlapping gaps once; 0 without a gap or for an empty span."""
    s, e = span
    there = merge(gaps, on, gap[0], gap[1], 0).select(*on, F.col("start").alias("__gs"), F.col("end").alias("__ge"))
    hits = window_join(variants.select(row, *on, s, e), there, on, span, ("__gs", "__ge"))
    share = hits.groupBy(row).agg((F.sum(F.greatest(F.least(F.col(e), F.col("__ge")) - F.greatest(F.col(s), F.col("__gs")), F.lit(0))) / F.nullif(F.max(F.col(e) - F.col(s)), F.lit(0))).alias(name))
    return variants.join(share, [row], "left").withColumn(name, F.coalesce(name, F.lit(0.0)))


def n50(lengths: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """count, total, mean, min, max and N50 of lengths for each key: the greatest length such that sequences at least as long
    hold half of the total. Equal lengths are counted together, so memory follows the number of different lengths."""
    group = list(keys) or ["__all"]
    df = lengths if keys else lengths.withColumn("__all", F.lit(1))
    per = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy(*group).orderBy(F.col(value).desc())
    ranked = per.withColumn("upto", F.sum(F.col("n") * F.col(value)).over(down)).withColumn("total", F.sum(F.col("n") * F.col(value)).over(Window.partitionBy(*group)))
    out = ranked.groupBy(*group).agg(F.sum("n").alias("count"), F.max("total").alias("total"), (F.max("total") / F.sum("n")).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.max(F.when(F.col("upto") * 2 >= F.col("total"), F.col(value))).alias("n50"))
    return out.drop("__all")


def equivalent_reference(df: DataFrame, width: int = WIDTH) -> DataFrame:
    """For each query the reference that its alignments cover most (merged), ties by name."""
    spans = df.dropna(subset=["rid", "qid", "qstart", "qend"]).select("qid", "rid", F.least("qstart", "qend").alias("s"), F.greatest("qstart", "qend").alias("e"))
    covered = merge(spans, ["qid", "rid"], "s", "e", 0, width).groupBy("qid", "rid").agg(F.sum(F.col("end") - F.col("start")).alias("covered"))
    best = covered.groupBy("qid").agg(F.min_by(F.struct("rid", "covered"), F.struct(-F.col("covered"), "rid")).alias("b"))
    return best.select("qid", "b.rid", "b.covered")


def pair_flanks(df: DataFrame, ident: str, chrom: str, start: str, end: str, side: str, coverage: str, most: int = 20_000) -> DataFrame:
    """The place between the two lifted flanks of each id that has exactly two.

    Same chromosome and 0 <= R.start - L.end <= most: [L.end, R.start); negative down to -most: [R.start, L.end); else BAD. On
    different chromosomes the end of the flank with the better coverage (the left one on a tie) as a point, also BAD.
    """
    pair = df.groupBy(ident).agg(F.count(F.lit(1)).alias("n"), *[F.max(F.when(F.col(side) == x, F.struct(F.col(chrom).alias("c"), F.col(start).alias("s"), F.col(end).alias("e"), F.col(coverage).alias("v")))).alias(x) for x in "LR"]).filter("n = 2 and L is not null and R is not null")
    gap = F.col("R.s") - F.col("L.e")
    same = F.col("L.c") == F.col("R.c")
    near, crossed, left = same & gap.between(0, most), same & gap.between(-most, -1), F.col("L.v") >= F.col("R.v")
    pick = lambda a, b, c, e: F.when(near, a).when(crossed, b).when(~same & left, c).when(~same, e)
    return pair.select(ident, F.when(same | left, F.col("L.c")).otherwise(F.col("R.c")).alias("chrom"), pick(F.col("L.e"), F.col("R.s"), F.col("L.e"), F.col("R.s")).alias("start"), pick(F.col("R.s"), F.col("L.e"), F.col("L.e") + 1, F.col("R.s") + 1).alias("end"), F.when(near | crossed, "OK").otherwise("BAD").alias("state"))


def project_positions(elements: DataFrame, variants: DataFrame, key: str = "qseqid", element: str = "sseqid") -> DataFrame:
    """Elements found in assembly variants with the variant's place on the reference.

    ``elements``: a packed assembly key and the element; ``variants``: asm_id, chrom, start, stop, sv_type, of which the first by
    (chrom, start) counts for an id. An insertion is a point, anything else keeps its span. Elements of unknown ids are left out.
    """
    from strandloom.functions.text import assembly_key

    first = variants.groupBy("asm_id").agg(F.min(F.struct("chrom", "start", "stop", "sv_type")).alias("v"))
    e = elements.withColumn("asm_id", assembly_key(F.col(key)).getField("asm_id"))
    j = e.join(first, "asm_id")
    stop = F.when(F.col("v.sv_type") == "Insertion", F.col("v.start") + 1).otherwise(F.col("v.stop"))
    return j.select(key, F.concat_ws("|", element, "asm_id").alias("label"), F.col("v.chrom").alias("chrom"), F.col("v.start").alias("start"), stop.alias("stop"))


def pair_regions(df: DataFrame, ident: str, region: str, near: int = 100, long: int = 500) -> DataFrame:
    """The place of an element between the hits of its left and right region (J14), one hit for each side (the first line).

    Kept if the hits meet within ``near`` on the subject or one of them is longer than ``long`` on the query; the place is the end
    of the left hit if that one is long, else the start of the right one.
    """
    side = lambda s: F.min(F.when(F.col(region) == s, F.struct("line_no", "sseqid", "sstart", "send", "qstart", "qend")))
    p = df.groupBy(ident).agg(side("LEFT").alias("l"), side("RIGHT").alias("r")).filter("l is not null and r is not null")
    size = lambda x: F.abs(F.col(f"{x}.qend") - F.col(f"{x}.qstart"))
    kept = p.filter((F.abs(F.col("l.send") - F.col("r.sstart")) <= near) | (size("l") > long) | (size("r") > long))
    left = size("l") > long
    return kept.select(ident, F.when(left, F.col("l.sseqid")).otherwise(F.col("r.sseqid")).alias("chrom"), F.when(left, F.col("l.send")).otherwise(F.col("r.sstart")).alias("position"))
