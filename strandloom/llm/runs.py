"""Collapse runs of near-identical consecutive events into one event with its count and durations.

The events of an entity, in order, are cut into runs so that the dissimilarity within the runs plus a penalty for each boundary
is least. Events of another kind never share a run. Two dissimilarities are known:

* ``steps``: the sum over neighbours in the run of their largest difference in a field;
* ``spread``: the sum over the run of the squared differences from the run's mean, over all fields.

The optimum is found by pruned dynamic programming over the last boundary: F(t) = min over live s < t of F(s) + D(s, t) + penalty. A
candidate s stays live after t only while F(s) + D(s, t) <= F(t); otherwise a boundary at t can always take its place, since
D(s, u) >= D(s, t) + D(t, u) for both. With ``steps`` all candidates grow by the same amount when an event is added, so the best
of them stays the best and the others go too. Of equal optima the one whose last run begins first is taken. The recursion
runs for many stretches of one kind at a time, one event of each in a step.

Rows are range-partitioned by (entity, order), so an entity of any size is spread over tasks. With ``steps``, where costs add up
over neighbours, runs that meet at the border of two partitions are joined by the same rule from their ends alone. With
``spread`` the stretch of one kind that lies on a border is finished in one piece by the task of its entity, from its events.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.operators.ordered import stretches

COSTS = ("steps", "spread")


def dissimilarity(values: np.ndarray, weight: np.ndarray, begins: np.ndarray, cost: str):
    """D(a, b) of the events a to b - 1 (arrays of places), which lie in one stretch. ``values``: events x fields; ``weight``: how often
    each is there in a row; ``begins``: where stretches begin."""
    if cost == "steps":
        step = np.zeros(len(values), np.int64)
        step[1:] = np.abs(np.diff(values, axis=0)).max(1)
        step[begins] = 0
        upto = np.cumsum(step)
        return lambda a, b: upto[b - 1] - upto[a]
    size = np.diff(np.append(begins, len(values)))
    near = (values - np.repeat(values[begins], size, axis=0)).astype(np.float64)  # small numbers keep the sums exact
    count = np.append(0, np.cumsum(weight))
    one = np.vstack([np.zeros((1, values.shape[1])), np.cumsum(near * weight[:, None], axis=0)])
    two = np.append(0.0, np.cumsum((near * near).sum(1) * weight))
    return lambda a, b: np.maximum(two[b] - two[a] - ((one[b] - one[a]) ** 2).sum(1) / (count[b] - count[a]), 0.0)


def segment(values: np.ndarray, begins: np.ndarray, penalty: float, cost: str = "steps") -> np.ndarray:
    """Which events begin a run of the optimal segmentation. ``begins``: the places where stretches of one kind begin, the first one 0.

    Equal neighbours are taken as one event of their number: with either cost a boundary between them can move to an end of them
    without loss.
    """
    if len(values) < 2:
        return np.ones(len(values), bool)
    other = np.append(True, (values[1:] != values[:-1]).any(1))
    other[begins] = True
    place = np.flatnonzero(other)
    weight = np.diff(np.append(place, len(values)))
    starts = np.zeros(len(values), bool)
    starts[place[_segment(values[place], weight, np.searchsorted(place, begins), penalty, cost)]] = True
    return starts


def _segment(values: np.ndarray, weight: np.ndarray, begins: np.ndarray, penalty: float, cost: str) -> np.ndarray:
    n = len(values)
    starts = np.zeros(n, bool)
    starts[begins] = True
    size = np.diff(np.append(begins, n))
    longer = np.flatnonzero(size > 1)
    if not len(longer):
        return starts
    longer = longer[np.argsort(-size[longer], kind="stable")]
    at, size = begins[longer], size[longer]  # stretches, the longest first
    within = dissimilarity(values, weight, begins, cost)
    last = np.zeros(n, np.int64)  # for each event where, in its stretch, the last run begins if the stretch ended with it
    best = np.zeros(len(at), np.int64 if cost == "steps" and isinstance(penalty, int) else np.float64)  # F(t)
    lane, start, base = np.zeros(0, np.int64), np.zeros(0, np.int64), best[:0]  # live candidates by stretch: s and F(s) + penalty
    for t in range(1, int(size[0]) + 1):
        going = int(np.searchsorted(-size, -t, "right"))  # stretches of t events or more
        kept = lane < going
        fresh = best[:going] + penalty if t > 1 else best[:going]  # the first run has no boundary before it
        lane = np.append(lane[kept], np.arange(going))
        order = np.argsort(lane, kind="stable")
        lane, start, base = lane[order], np.append(start[kept], np.full(going, t - 1))[order], np.append(base[kept], fresh)[order]
        value = base + within(at[lane] + start, at[lane] + t)
        best[:going] = np.minimum.reduceat(value, np.flatnonzero(np.append(True, lane[1:] != lane[:-1])))
        least = np.flatnonzero(value == best[lane])
        least = least[np.append(True, lane[least][1:] != lane[least][:-1])]  # the earliest of equals
        last[at[:going] + t - 1] = start[least]
        live = least if cost == "steps" else np.flatnonzero(value - penalty <= best[lane])
        lane, start, base = lane[live], start[live], base[live]
    end = size.copy()
    while (open_ := end > 0).any():
        at, end = at[open_], end[open_]
        end = last[at + end - 1]
        starts[at + end] = True
    return starts


def runs(df: DataFrame, entity: str, order: str, kind: Sequence[str | Column], fields: Sequence[str], penalty: int = 10, partitions: int | None = None, least: int = 1, cost: str = "steps") -> DataFrame:
    """One row per run: entity, kind columns (``kind0``...), first and last of ``order``, n_events, and lo_ and hi_ of each field.

    ``kind`` must be equal within a run; ``fields`` are integers the dissimilarity ``cost`` is taken from, and ``penalty`` is the price
    of a boundary. With ``steps`` neighbours that differ by at most the penalty stay together.
    Rows with a NULL in any of these columns are left out first. Rows of one entity and order value are one event; should such
    copies differ, the least by (kind, fields) counts. An empty table gives no row; other columns are dropped. Only runs of at
    least ``least`` events are returned; shorter ones don't leave their partition, unless they may go on in the next. A task holds
    the events of the longest stretch of one kind in its partition.
    """
    if cost not in COSTS:
        raise ValueError(f"unknown cost {cost!r}")
    kinds = [f"kind{i}" for i in range(len(kind))]
    rows = df.select(
        F.col(entity).cast("string").alias("entity"), F.col(order).cast("bigint").alias("first"),
        *[(F.col(k) if isinstance(k, str) else k).cast("string").alias(n) for n, k in zip(kinds, kind, strict=True)],
        *[F.col(f).cast("bigint").alias(f"value_{f}") for f in fields],
    ).dropna()
    keys = ["entity", "first"]
    spread = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    spread = spread.sortWithinPartitions(*keys, *kinds, *[f"value_{f}" for f in fields])
    longs = ["first", "last", "n_events", *[f"{p}_{f}" for f in fields for p in ("lo", "hi", "begin", "end")]]
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in ("entity", *kinds)], *[T.StructField(c, T.LongType()) for c in longs], *[T.StructField(c, T.BooleanType()) for c in ("edge", "fresh")]])
    arrow = pa.schema([*[(c, pa.string()) for c in ("entity", *kinds)], *[(c, pa.int64()) for c in longs], ("edge", pa.bool_()), ("fresh", pa.bool_())])

    def collapsed(t: pa.Table, starts: np.ndarray, values: list[np.ndarray]) -> dict:
        begins = np.flatnonzero(starts)
        ends = np.append(begins[1:], t.num_rows) - 1
        first = t["first"].to_numpy()
        out = {c: t[c].combine_chunks().take(pa.array(begins)) for c in ("entity", *kinds)}
        out |= {"first": first[begins], "last": first[ends], "n_events": ends - begins + 1}
        for f, v in zip(fields, values, strict=True):
            out |= {f"lo_{f}": np.minimum.reduceat(v, begins), f"hi_{f}": np.maximum.reduceat(v, begins), f"begin_{f}": v[begins], f"end_{f}": v[ends]}
        return out

    def batch_of(columns: dict, edge: np.ndarray, fresh: np.ndarray, kept: np.ndarray) -> pa.RecordBatch:
        made = [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in (columns[f.name] for f in list(arrow)[:-2])]
        # What only the joining needs is left out of rows that take no part in it.
        made = [pc.if_else(pa.array(edge), c, pa.scalar(None, pa.int64())) if f.name.startswith(("begin_", "end_")) else c for c, f in zip(made, arrow, strict=False)]
        return pa.RecordBatch.from_arrays([*made, pa.array(edge), pa.array(fresh)], schema=arrow).filter(pa.array(kept))

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leading = True
        for t, begins, final in stretches(batches, ["entity", *kinds], ["entity", "first"]):
            values = [t[f"value_{f}"].to_numpy() for f in fields]
            starts = segment(np.stack(values, axis=1), begins, penalty, cost)
            open_ = np.zeros(t.num_rows, bool)  # events of stretches, or with steps of runs, on a border of the partition
            cuts = np.flatnonzero(starts) if cost == "steps" else begins
            if leading:
                open_[: cuts[1] if len(cuts) > 1 else None] = True
            if final:
                open_[cuts[-1] :] = True
            fresh = np.zeros(t.num_rows, bool)
            if cost == "spread":
                fresh[begins] = open_[begins]
                fresh[0] &= not leading
                starts |= open_  # their events go on one by one
            out = collapsed(t, starts, values)
            edge = open_[starts]
            yield batch_of(out, edge, fresh[starts], edge | (out["n_events"] >= least))
            leading = False

    found = spread.mapInArrow(first_pass, schema)
    kept = [F.col(c) for c in ("entity", *kinds, "first", "last", "n_events")] + [F.col(f"{p}_{f}") for f in fields for p in ("lo", "hi")]
    if cost == "spread":
        def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def edges() -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    edge = batch.column("edge")
                    done.append(batch.filter(pc.invert(edge)))
                    yield batch.filter(edge)

            done: list[pa.RecordBatch] = []
            for t, begins, _ in stretches(edges(), ["entity", *kinds], (), "fresh"):
                yield from done
                done.clear()
                values = [t[f"lo_{f}"].to_numpy() for f in fields]
                out = collapsed(t, segment(np.stack(values, axis=1), begins, penalty, cost), values)
                none = np.zeros(len(out["first"]), bool)
                yield batch_of(out, none, none, out["n_events"] >= least)
            yield from done

        part = F.when(F.col("edge"), F.xxhash64("entity")).otherwise(F.xxhash64(F.spark_partition_id()))
        return found.repartition(part).sortWithinPartitions("entity", "first").mapInArrow(second_pass, schema).select(*kept)

    # The first and last run of each partition meet in one group, two rows of a task; all others stay in groups of their partition.
    found = found.withColumn("__part", F.when(F.col("edge"), F.lit(-1)).otherwise(F.spark_partition_id()))
    line = Window.partitionBy("__part").orderBy("entity", "first")
    joins = F.col("edge") & (F.lag("entity").over(line) == F.col("entity"))
    for k in kinds:
        joins &= F.lag(k).over(line) == F.col(k)
    for f in fields:
        joins &= F.abs(F.lag(f"end_{f}").over(line) - F.col(f"begin_{f}")) <= penalty
    # Within a partition the first and the last run are different runs, unless they are the same row.
    joins &= F.lag("__source").over(line) != F.col("__source")
    found = found.withColumn("__source", F.spark_partition_id())
    found = found.withColumn("__new", F.when(joins, 0).otherwise(1)).withColumn("__run", F.sum("__new").over(line))
    return found.groupBy("__part", "__run").agg(
        F.min("entity").alias("entity"), *[F.min(k).alias(k) for k in kinds],
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n_events").alias("n_events"),
        *[g(f"{p}_{f}").alias(f"{p}_{f}") for f in fields for p, g in (("lo", F.min), ("hi", F.max))],
    ).select(*kept).filter(F.col("n_events") >= least)
