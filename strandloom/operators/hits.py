"""Similarity hits: the best hit of each locus, the fragments that continue it, and their ordered combination."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.functions.text import field, first_fields, size_percent, strand_of
from strandloom.operators.ordered import stretches


def known_elements(hits: DataFrame, sizes: DataFrame, element: str = "sseqid", name: str = "te_name") -> DataFrame:
    """Hits to elements of the dictionary (J1). Spark broadcasts it while it is small and shuffles beyond that."""
    return hits.join(sizes.select(F.col(name).alias(element)).distinct(), element, "left_semi")


def best_hits(hits: DataFrame, locus: Column) -> DataFrame:
    """The hit of the greatest bitscore of each locus, the first line on a tie (W1); a map-side aggregate, so heavy loci don't matter.

    Rows with a NULL locus or bitscore are left out. Columns: locus and all of the hit, so select what is needed first.
    """
    columns = hits.columns
    there = hits.withColumn("locus", locus).filter("locus is not null and bitscore is not null")
    best = there.groupBy("locus").agg(F.min_by(F.struct(*columns), F.struct(-F.col("bitscore"), F.col("line_no"))).alias("b"))
    return best.select("locus", "b.*")


FOLDED = ("sstart", "send", "qstart", "qend")


def fold_runs(t: pa.Table, begins: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray], np.ndarray]:
    """(place of the best hit, bounds stretched over the hits after it, place behind the run) of each run that has a best hit.

    ``t``: hits in file order; ``begins``: where runs begin. The best is that of the greatest bitscore, the first on a tie; NULL is
    none and NaN the least. All runs go one hit on in a step.
    """
    number = lambda c: pc.cast(t[c], pa.float64(), safe=False).to_numpy(zero_copy_only=False).astype(np.float64)
    score = number("bitscore")
    scored = pc.is_valid(t["bitscore"]).to_numpy(zero_copy_only=False)
    run = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, t.num_rows)))
    candidates = np.flatnonzero(scored)
    order = candidates[np.lexsort((candidates, -np.where(np.isnan(score[candidates]), -np.inf, score[candidates]), np.isnan(score[candidates]), run[candidates]))]
    best = order[np.append(True, run[order][1:] != run[order][:-1])] if len(order) else order
    stop = np.append(begins[1:], t.num_rows)[run[best]]
    order = np.argsort(-(stop - best), kind="stable")
    best, stop = best[order], stop[order]
    of = {c: number(c) for c in FOLDED}
    now = {c: v[best] for c, v in of.items()}
    forward = now["sstart"] < now["send"]
    for step in range(1, int((stop - best).max()) if len(best) else 0):
        k = int(np.searchsorted(-(stop - best), -step, "left"))  # the runs that go on, the longest first
        x, a, up = {c: v[best[:k] + step] for c, v in of.items()}, {c: v[:k] for c, v in now.items()}, forward[:k]
        below, above = (x["qstart"] < a["qstart"]) & (x["qend"] < a["qend"]), (x["qstart"] > a["qstart"]) & (x["qend"] > a["qend"])
        down = (x["sstart"] < a["sstart"]) & (x["send"] < a["send"])
        rise = (x["sstart"] > a["sstart"]) & (x["send"] > a["send"])
        head = below & np.where(up, down, rise)
        tail = above & np.where(up, rise, down) & ~head
        for c, moved in (("sstart", head), ("qstart", head), ("send", tail), ("qend", tail)):
            now[c][:k] = np.where(moved, x[c], a[c])
    return best, now, stop


def combine(hits: DataFrame, locus: Column, partitions: int | None = None) -> DataFrame:
    """The best hit of each locus, stretched over the hits that continue it in the file.

    In file order, a following hit of the same run stretches the bounds at one end only if it lies outside them on query and
    subject alike, towards that end in the direction of the best hit. ``locus`` is a function of qseqid. Columns: locus, qseqid,
    sseqid, pident, line_no of the best hit, sstart, send, qstart, qend as combined, n_hits looked at, and
    last_line, where the run ends. Rows of one line count once; NULL line numbers, loci and scores are left out, and without coordinates nothing is stretched.

    The file is sorted once, in ranges of lines. A run is folded where it lies, from its own best hit; the first and last run of
    each range are folded by one task, in file order, as they may be parts of one. A task holds the longest run. Of the runs of
    a locus the one with the best hit counts, which partial aggregates find.
    """
    numbers = ("pident", "bitscore")
    slim = hits.filter("line_no is not null").select("line_no", "qseqid", "sseqid", *[F.col(c).cast("double") for c in numbers], *[F.col(c).cast("bigint") for c in FOLDED])
    spread = slim.repartitionByRange(partitions, "line_no") if partitions else slim.repartitionByRange("line_no")
    spread = spread.sortWithinPartitions("line_no", "qseqid", "sseqid")
    columns = slim.columns
    kinds = {c: pa.string() if c in ("qseqid", "sseqid") else pa.float64() if c in numbers else pa.int64() for c in columns} | {"n_hits": pa.int64(), "last_line": pa.int64(), "edge": pa.bool_(), "fresh": pa.bool_()}
    names = {pa.string(): T.StringType(), pa.float64(): T.DoubleType(), pa.int64(): T.LongType(), pa.bool_(): T.BooleanType()}
    arrow, schema = pa.schema(list(kinds.items())), T.StructType([T.StructField(c, names[k]) for c, k in kinds.items()])

    def batch_of(t: pa.Table, n_hits, last, edge, fresh) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[t[c].combine_chunks().cast(kinds[c]) for c in columns], pa.array(n_hits, pa.int64()), pa.array(last, pa.int64()), pa.array(edge, pa.bool_()), pa.array(fresh, pa.bool_())], schema=arrow)

    def folded(t: pa.Table, begins: np.ndarray) -> pa.RecordBatch:
        best, bounds, stop = fold_runs(t, begins)
        rows = t.take(pa.array(best))
        for c in FOLDED:
            rows = rows.set_column(rows.schema.get_field_index(c), c, pa.array(bounds[c], pa.float64(), from_pandas=True).cast(pa.int64()))
        return batch_of(rows, stop - best, t["line_no"].to_numpy()[stop - 1], np.zeros(len(best), bool), np.zeros(len(best), bool))

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leading = True
        for t, begins, final in stretches(batches, ["qseqid", "sseqid"], ["line_no"]):
            cuts = np.append(begins, t.num_rows)
            a, z = int(leading), len(begins) - int(final)  # inner runs
            for edge in sorted({*([0] if leading else []), *([len(begins) - 1] if final else [])}):
                rows = t.slice(cuts[edge], cuts[edge + 1] - cuts[edge])
                n = rows.num_rows
                yield batch_of(rows, np.ones(n, np.int64), rows["line_no"].to_numpy(), np.ones(n, bool), np.append(not (leading and edge == 0), np.zeros(n - 1, bool)))
            if a < z:
                yield folded(t.slice(cuts[a], cuts[z] - cuts[a]), begins[a:z] - cuts[a])
            leading = False

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[pa.RecordBatch] = []

        def edges() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                edge = batch.column("edge")
                done.append(batch.filter(pc.invert(edge)))
                yield batch.filter(edge)

        for t, begins, _ in stretches(edges(), ["qseqid", "sseqid"], ["line_no"], "fresh"):
            yield from done
            done.clear()
            yield folded(t, begins)
        yield from done

    found = spread.mapInArrow(first_pass, schema)
    # What is folded is spread by blocks of lines, not by query, of which one may hold most.
    part = F.when(F.col("edge"), F.lit(-1).cast("bigint")).otherwise(F.expr("abs(line_no) div 4096"))
    whole = found.repartition(part).sortWithinPartitions("line_no").mapInArrow(second_pass, schema)
    return best_hits(whole.drop("edge", "fresh"), locus).select("locus", "qseqid", "sseqid", "pident", "line_no", *FOLDED, "n_hits", "last_line")


def continuing(hits: DataFrame, locus: Column, partitions: int | None = None) -> DataFrame:
    """(locus, line_no) of the best hit of each locus and the hits that continue it in the file (W2), each line once.

    Between the best hit and the end of its run lie only hits of the same query and element, so those are found by that pair.
    """
    best = combine(hits, locus, partitions).select("locus", "qseqid", "sseqid", F.col("line_no").alias("__from"), F.col("last_line").alias("__to"))
    return hits.select("qseqid", "sseqid", "line_no").join(best, ["qseqid", "sseqid"]).filter("line_no between __from and __to").select("locus", "line_no").distinct()


def detect(hits: DataFrame, sizes: DataFrame, fields: int = 7, types: str = "INS", least_support: int = 1, least_pident: float = 94.0, least_size: float = 90.0, fold: bool = True, digits: int = 2) -> DataFrame:
    """Elements in variants: dictionary, best hit of each locus, type and support floors, (combined) size and identity floors.

    Type and support are tested after the best hit of a locus is chosen: a failing best hit removes the locus and never
    promotes the next one. Columns: those of ``combine`` with strand, size_el, size_per.
    """
    known = known_elements(hits, sizes)
    locus = first_fields(F.col("qseqid"), fields)
    if fold:
        found = combine(known, locus)
    else:
        found = best_hits(known, locus).select("locus", "qseqid", "sseqid", "pident", "line_no", "sstart", "send", "qstart", "qend", F.lit(1).cast("bigint").alias("n_hits"), F.col("line_no").alias("last_line"))
    found = found.filter(field(F.col("qseqid"), 2).rlike(types) & (field(F.col("qseqid"), 6).try_cast("bigint") >= least_support))
    sized = found.join(sizes.select(F.col("te_name").alias("sseqid"), F.col("size_bp").alias("__size")), "sseqid")
    sized = sized.withColumn("strand", strand_of(F.col("sstart"), F.col("send"))).withColumn("size_el", F.abs(F.col("qend") - F.col("qstart"))).withColumn("size_per", size_percent(F.col("qstart"), F.col("qend"), F.col("__size"), digits))
    return sized.filter((F.col("size_per") >= least_size) & (F.col("pident") >= least_pident)).drop("__size", "last_line")


def elements_per_variant(hits: DataFrame) -> DataFrame:
    """How many different query sequences of a variant carry each element (A5): (ident, te, n)."""
    pairs = hits.select(field(F.col("qseqid"), 5).alias("ident"), F.col("sseqid").alias("te"), "qseqid").filter("ident is not null").distinct()
    return pairs.groupBy("ident", "te").agg(F.count(F.lit(1)).alias("n"))
