"""The steps of a run, with what a configuration says about them (``Params``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.operators import evidence as ev
from strandloom.operators import generations, tsd
from strandloom.operators import hits as ht
from strandloom.operators import intervals as iv
from strandloom.operators.merge import merge_calls
from strandloom.params import Params


def chromosomes(df: DataFrame, chrom: Column, p: Params) -> DataFrame:
    """Rows of the chromosomes that the configuration keeps: patterns with commas between them, found anywhere; ``.`` keeps all (P5)."""
    return df if p.chrom_keep == "." else df.filter(chrom.rlike(p.chrom_keep.replace(",", "|")))


def elements(hits: DataFrame, sizes: DataFrame, p: Params) -> DataFrame:
    """Elements in variants by the floors of the configuration (B)."""
    d = p.detection
    kept = chromosomes(hits, F.split_part("qseqid", F.lit(":"), F.lit(1)), p)
    return ht.detect(kept, sizes, types=d.types, least_support=d.least_read_support, least_pident=d.least_pident, least_size=d.least_size_percent, fold=d.fold)


def read_clusters(evidence: DataFrame, p: Params) -> DataFrame:
    """Read evidence with the cluster of its place."""
    return iv.cluster(chromosomes(evidence, F.col("chrom"), p), ["chrom"], "pos", "pos1", p.clusters.reads)


def call_sets(calls: DataFrame, source: str, order: Sequence[str], p: Params) -> DataFrame:
    """Calls of all sources merged by priority (D)."""
    return merge_calls(chromosomes(calls, F.col("chrom"), p), source, order, p.clusters.calls, p.clusters.window)


def classes(sites: DataFrame, reads: DataFrame, p: Params) -> DataFrame:
    """Classes of evidence of the usable reads at sites."""
    s = p.sites
    return ev.read_classes(chromosomes(sites, F.col("chrom"), p), ev.usable(reads, s.least_mapq), s.window, s.least_percent(p.detection), s.least_clip)


def duplications(flanks: DataFrame, p: Params) -> DataFrame:
    """Duplications in the ``flank`` bases of either side that are nearest to the element (F3); fk_l, fk_r are cut to them.

    The left flank has one base more.
    """
    n = p.sites.flank
    return tsd.duplications(flanks.withColumn("fk_l", F.right("fk_l", F.lit(n + 1))).withColumn("fk_r", F.left("fk_r", F.lit(n))))


def generation_points(points: DataFrame, p: Params) -> DataFrame:
    """Points of generations near each other at one position (Q7)."""
    return generations.merge_positions(points, p.clusters.generations)
