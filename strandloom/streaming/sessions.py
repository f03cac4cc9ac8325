"""Gap clusters of timed events as they arrive (an extension; no batch operator depends on it)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gap_sessions(events: DataFrame, keys: Sequence[str], at: str, gap: str, late: str) -> DataFrame:
    """Events of each key no farther apart than ``gap`` as one session: keys, start, stop (of the last event), n_events.

    For streams as for tables. A session is out when the watermark, ``late`` behind the latest event, has passed its end; later
    events are dropped then. The gap itself is open here: events exactly ``gap`` apart are two sessions, where the batch
    cluster at distance d takes them as one. Rows with a NULL time are left out.
    """
    seen = events.filter(F.col(at).isNotNull()).withWatermark(at, late)
    grouped = seen.groupBy(F.session_window(at, gap).alias("__w"), *keys)
    return grouped.agg(F.min(at).alias("start"), F.max(at).alias("stop"), F.count(F.lit(1)).alias("n_events")).drop("__w")
