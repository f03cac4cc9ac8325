"""Sequence functions as Spark expressions: complements, exact search, common substrings, slices."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Nucleotide codes and their complements.
PLAIN, PLAIN_COMPLEMENT = "ACGT", "TGCA"
AMBIGUOUS, AMBIGUOUS_COMPLEMENT = "ACGTRYKMBVDHSWN", "TGCAYRMKVBHDSWN"


def reverse_complement(seq: Column) -> Column:
    """Upper-case reverse complement; anything but A, C, G, T becomes N."""
    return F.reverse(F.translate(F.regexp_replace(F.upper(seq), "[^ACGT]", "N"), PLAIN, PLAIN_COMPLEMENT))


def reverse_complement_ambiguous(seq: Column) -> Column:
    """Upper-case reverse complement that keeps ambiguity codes; anything else stays as it is."""
    return F.reverse(F.translate(F.upper(seq), AMBIGUOUS, AMBIGUOUS_COMPLEMENT))


def slice_of(seq: Column, start: Column, end: Column) -> Column:
    """seq[start:end], 0-based and half-open, clamped to the sequence."""
    lo = F.greatest(start, F.lit(0))
    return F.substring(seq, (lo + 1).cast("int"), F.greatest(F.least(end, F.length(seq)) - lo, F.lit(0)).cast("int"))


def stranded_slice(seq: Column, start: Column, end: Column, strand: Column) -> Column:
    part = slice_of(seq, start, end)
    return F.when(strand == "-", reverse_complement(part)).otherwise(part)


def occurrences(text: Column, pattern: Column) -> Column:
    """0-based places of every occurrence of a pattern, overlapping ones too; empty for an empty pattern."""
    last = F.length(text) - F.length(pattern)
    places = F.when((last >= 0) & (F.length(pattern) > 0), F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: F.substring(text, i + 1, F.length(pattern)) == pattern)


@F.arrow_udf(T.ArrayType(T.LongType()))
def places(texts: pa.Array, patterns: pa.Array) -> pa.Array:
    """``occurrences`` in texts of any length, in proportion to them; NULL for NULL."""

    def find(text: str | None, pattern: str | None):
        if text is None or pattern is None:
            return None
        out, at = [], text.find(pattern) if pattern else -1
        while at >= 0:
            out.append(at)
            at = text.find(pattern, at + 1)
        return out

    return pa.array([find(t, p) for t, p in zip(texts.to_pylist(), patterns.to_pylist(), strict=True)], pa.list_(pa.int64()))


def _longest(main: str, other: str, least: int) -> str | None:
    """The longest common substring, leftmost in ``main``: whether there is one of a length is bisected, since a shorter one is in it."""
    def at(size: int) -> int:
        there = {other[i : i + size] for i in range(len(other) - size + 1)}
        return next((i for i in range(len(main) - size + 1) if main[i : i + size] in there), -1)

    lo, hi = least - 1, min(len(main), len(other))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if at(mid) >= 0 else (lo, mid - 1)
    return main[(i := at(lo)) : i + lo] if lo >= least else None


@F.arrow_udf(T.StringType())
def longest_common_long(main: pa.Array, other: pa.Array, least: pa.Array) -> pa.Array:
    """``longest_common`` for long texts."""
    rows = zip(main.to_pylist(), other.to_pylist(), least.to_pylist(), strict=True)
    return pa.array([None if m is None or o is None else _longest(m, o, n) for m, o, n in rows], pa.string())


def longest_common(main: Column, other: Column, least: int = 4) -> Column:
    """The longest substring of ``main``, leftmost among equals, that also stands in ``other``; NULL below ``least`` letters.

    A walk of 2 x length(main) steps: where one letter more than the best still stands in ``other``, the best grows, else the
    walk goes on to the next place. The texts are part of the state so that each is computed once.
    """
    state = lambda m, o, p, best, at: F.struct(m.alias("m"), o.alias("o"), p.alias("p"), best.alias("best"), at.alias("at"))

    def step(x: Column, _: Column) -> Column:
        grows = (x["p"] + x["best"] <= F.length(x["m"])) & (F.instr(x["o"], F.substring(x["m"], x["p"], x["best"] + 1)) > 0)
        return F.when(grows, state(x["m"], x["o"], x["p"], x["best"] + 1, x["p"])).otherwise(state(x["m"], x["o"], x["p"] + 1, x["best"], x["at"]))

    walk = F.sequence(F.lit(1), F.greatest(2 * F.length(main), F.lit(1)))
    return F.aggregate(walk, state(main, other, F.lit(1), F.lit(least - 1), F.lit(0)), step, lambda x: F.when(x["best"] >= least, F.substring(x["m"], x["at"], x["best"])))


def nearest_occurrence(text: Column, pattern: Column, at: Column) -> Column:
    """The place of the occurrence for which |place - at + len(pattern)| is least, the first of equals; NULL without one."""
    return F.array_min(F.transform(occurrences(text, pattern), lambda i: F.struct(F.abs(i - at + F.length(pattern)).alias("d"), i.alias("place")))).getField("place")


def trimmed_clip(seq: Column, side: Column, most: Column) -> Column:
    """A clipped sequence cut to ``most`` letters at the end next to the alignment: of a left clip the end, of a right the beginning."""
    return F.when(side == "L", F.right(seq, most)).otherwise(F.left(seq, most))


def valid_sequence(seq: Column) -> Column:
    return F.upper(seq).rlike("^[ACGTURYKMSWBDHVN.-]+$")
