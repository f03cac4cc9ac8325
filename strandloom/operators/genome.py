"""Sequences by name: slices of intervals, and genomes with elements spliced in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.sequence import reverse_complement, reverse_complement_ambiguous


def slices(intervals: DataFrame, sequences: DataFrame, name: str, start: str, end: str, strand: str | None = None, out: str = "seq_slice", tile: int = 1 << 16) -> DataFrame:
    """Each interval with its piece of the named sequence, clamped; reverse complement on the - strand if ``strand`` is given.

    ``sequences``: name, seq (one row for a name). Intervals of unknown sequences are left out, and those with NULLs in name or
    place. Sequences are cut into tiles of ``tile`` bases and joined on (name, tile), so an interval meets only what it touches
    and a chromosome is many rows. Intervals over several tiles are put together again; equal ones at once.
    """
    s = sequences.filter(F.col("seq").isNotNull()).select(F.col("name").alias(name), "seq", F.explode(F.expr(f"sequence(0L, greatest(length(seq) - 1, 0) div {tile})")).alias("__tile"))
    # Each tile with the length of the whole, so that intervals beyond the end can be clamped to its last tile.
    s = s.select(name, "__tile", F.length("seq").cast("bigint").alias("__size"), F.substring("seq", (F.col("__tile") * tile + 1).cast("int"), F.lit(tile)).alias("__seq"))
    sizes = s.filter("__tile = 0").select(name, "__size")
    kept = intervals.filter(F.col(start).isNotNull() & F.col(end).isNotNull()).join(sizes, name)
    lo = F.least(F.greatest(F.col(start), F.lit(0)), F.col("__size"))
    kept = kept.withColumn("__lo", lo).withColumn("__hi", F.greatest(F.least(F.col(end), F.col("__size")), F.col("__lo"))).drop("__size")
    kept = kept.withColumn("__first", F.expr(f"greatest(least(__lo, __hi - 1), 0) div {tile}")).withColumn("__last", F.expr(f"greatest(__hi - 1, 0) div {tile}"))
    here = F.substring("__seq", (F.greatest(F.col("__lo") - F.col("__tile") * tile, F.lit(0)) + 1).cast("int"), (F.least(F.col("__hi") - F.col("__tile") * tile, F.lit(tile)) - F.greatest(F.col("__lo") - F.col("__tile") * tile, F.lit(0))).cast("int"))
    tiles = s.drop("__size")
    one = kept.filter("__first = __last").withColumn("__tile", F.col("__first")).join(tiles, [name, "__tile"]).withColumn("__piece", here)
    many = kept.filter("__first < __last").groupBy(*kept.columns).agg(F.count(F.lit(1)).alias("__n")).withColumn("__tile", F.explode(F.sequence("__first", "__last")))
    many = many.join(tiles, [name, "__tile"]).groupBy(*kept.columns, "__n").agg(F.array_sort(F.collect_list(F.struct("__tile", here.alias("p")))).alias("__parts"))
    many = many.withColumn("__piece", F.array_join(F.transform("__parts", lambda x: x["p"]), "")).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))))
    piece = F.when(F.col(strand) == "-", reverse_complement(F.col("__piece"))).otherwise(F.col("__piece")) if strand else F.col("__piece")
    return one.select(*intervals.columns, piece.alias(out)).unionByName(many.select(*intervals.columns, piece.alias(out)))


def canonical_inserts(sites: DataFrame, elements: DataFrame) -> DataFrame:
    """Inserts (name, start, ident, insert) of the canonical element of each site, its identifier written before it (K3).

    ``sites``: chrom, start, te, ident, strand; ``elements``: name, seq, one row for each. Clipped identifiers (SOFT, HARD) and
    unknown elements are left out; anything but + is the reverse strand, where ambiguity codes are complemented too.
    """
    e = elements.select(F.col("name").alias("te"), F.col("seq").alias("__seq"))
    s = sites.filter(~F.col("ident").rlike("SOFT|HARD")).join(e, "te")
    seq = F.when(F.col("strand") == "+", F.upper("__seq")).otherwise(reverse_complement_ambiguous(F.col("__seq")))
    return s.select(F.col("chrom").alias("name"), "start", "ident", F.concat("ident", seq).alias("insert"))


def sizes_after(sequences: DataFrame, inserts: DataFrame) -> DataFrame:
    """(name, before, after, n_inserts): bases of each sequence before and after its inserts are put in."""
    n = inserts.filter(F.col("start").isNotNull() & F.col("insert").isNotNull()).groupBy("name").agg(F.sum(F.length("insert")).alias("__more"), F.count(F.lit(1)).alias("n"))
    before = F.length("seq").cast("bigint")
    return sequences.join(n, "name", "left").select("name", before.alias("before"), (before + F.coalesce("__more", F.lit(0))).alias("after"), F.coalesce("n", F.lit(0)).alias("n_inserts"))


def splice(sequences: DataFrame, inserts: DataFrame, tie: str) -> DataFrame:
    """Each sequence (name, seq) with all its inserts (name, start, insert, and ``tie``, which orders equal starts) put in.

    An insert goes before the base at its start, so the result is as long as all parts together. Starts beyond the end go to
    the end; a NULL or empty insert changes nothing. Columns: name, seq, n_inserts. Inserts of one sequence are gathered, as
    the sequence itself is one value.
    """
    good = inserts.filter(F.col("start").isNotNull() & F.col("insert").isNotNull())
    listed = good.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("start", tie, "insert"))).alias("__parts"))
    joined = sequences.join(listed, "name", "left").withColumn("__n", F.coalesce(F.size("__parts"), F.lit(0)))
    return joined.select("name", _woven(F.lit(0)).alias("seq"), F.col("__n").cast("bigint").alias("n_inserts"))


def splice_pieces(sequences: DataFrame, inserts: DataFrame, tie: str, width: int = 10_000) -> DataFrame:
    """``splice`` in ranges of ``width`` bases: the pieces of a name, joined by number, are its spliced sequence.

    Columns: name, piece, seq, n_inserts. An insert is in the piece of its start, also beyond the end, where a piece holds
    inserts alone, so what is gathered is the inserts of one range and not those of a sequence. Starts below 0 count as 0 but
    come first. Pieces of no bases and no inserts are left out, except the first of each sequence.
    """
    good = inserts.filter(F.col("start").isNotNull() & F.col("insert").isNotNull()).join(sequences.select("name"), "name", "left_semi")
    ranged = good.withColumn("piece", F.expr(f"greatest(start, 0) div {width}"))
    listed = ranged.groupBy("name", "piece").agg(F.array_sort(F.collect_list(F.struct("start", tie, "insert"))).alias("__parts"))
    cut = sequences.select("name", "seq", F.explode(F.expr(f"sequence(0L, greatest(length(seq) - 1, 0) div {width})")).alias("piece"))
    cut = cut.select("name", "piece", F.substring("seq", (F.col("piece") * width + 1).cast("int"), F.lit(width)).alias("seq"))
    joined = cut.join(listed, ["name", "piece"], "full").withColumn("seq", F.coalesce("seq", F.lit(""))).withColumn("__n", F.coalesce(F.size("__parts"), F.lit(0)))
    return joined.select("name", "piece", _woven(F.col("piece") * width).alias("seq"), F.col("__n").cast("bigint").alias("n_inserts"))


def _woven(first: Column) -> Column:
    """seq, whose first base is at ``first``, with the __n sorted inserts of __parts put in."""
    start = lambda i: F.least(F.greatest(F.get("__parts", i)["start"] - first, F.lit(0)), F.length("seq"))
    pieces = F.transform("__parts", lambda p, i: F.concat(
        F.substring("seq", (F.when(i == 0, F.lit(0)).otherwise(start(i - 1)) + 1).cast("int"), (start(i) - F.when(i == 0, F.lit(0)).otherwise(start(i - 1))).cast("int")), p["insert"],
    ))
    last = F.substring("seq", (start(F.col("__n") - 1) + 1).cast("int"), F.length("seq"))
    return F.when(F.col("__n") > 0, F.concat(F.array_join(pieces, ""), last)).otherwise(F.col("seq"))
