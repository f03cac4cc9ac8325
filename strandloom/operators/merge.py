"""Merging call sets of several sources by priority."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators.intervals import cluster, consecutive_dedupe, window_join
from strandloom.session import checkpointed


def merge_calls(calls: DataFrame, source: str, order: Sequence[str], d: int = 100, window: int = 100) -> DataFrame:
    """Calls (chrom, start, end, te, sv_id, source) of all sources, merged in ``order``.

    Each source is clustered at distance ``d`` and rows that repeat the family of the row before in their cluster are dropped.
    A call of a later source stays only if no call of an earlier one that stayed lies within ``window`` with the same family.
    A source may be empty. Calls of sources not in ``order``, or with NULLs in chrom, place or family, are left out.
    """
    calls = calls.filter(F.col("te").isNotNull())
    clustered = cluster(calls, [source, "chrom"], "start", "end", d)
    deduped = consecutive_dedupe(clustered, [source, "chrom", "cluster"], "te", ["start", "end", "te", "sv_id"]).drop("cluster")
    # Each source is read twice, to be merged and to be compared with; without a checkpoint that doubles at every step.
    deduped = checkpointed(deduped)
    kept = deduped.filter(F.col(source) == order[0])
    for name in order[1:]:
        later = deduped.filter(F.col(source) == name)
        kept = kept.unionByName(window_join(later, kept.select("chrom", "te", F.col("start").alias("__ks"), F.col("end").alias("__ke")), ["chrom", "te"], ("start", "end"), ("__ks", "__ke"), window, "left_anti", bin_size=max(1 << 14, window)))
        if name != order[-1]:
            kept = checkpointed(kept)
    return kept
