"""Read evidence at element sites: classes, frequencies, depth and deletion support."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.cigar import fold, length_over, operations, reference_length
from strandloom.operators.intervals import window_join

# Evidence classes, in the order in which one masks another for the same read.
CLASSES = ("D", "E", "H", "I", "S")


def usable(reads: DataFrame, least_mapq: int = 10, without: int = 4) -> DataFrame:
    """Alignments without any of the flag bits ``without`` and of at least ``least_mapq``."""
    return reads.filter((F.col("flag").bitwiseAND(without) == 0) & (F.col("mapq") >= least_mapq))


def in_regions(reads: DataFrame, regions: DataFrame) -> DataFrame:
    """Alignments (rname, pos, cigar, ...) that touch a region (chrom, start, end), with ``stop``, the end of what they cover (P10, SC9).

    Each alignment comes as often as it is there, however many regions it touches; one without CIGAR covers a base.
    """
    covered = F.coalesce(F.greatest(reference_length(F.col("cigar")), F.lit(1)), F.lit(1))
    r = reads.withColumn("stop", F.col("pos") + covered)
    return window_join(r, regions.select(F.col("chrom").alias("rname"), "start", "end"), ["rname"], ("pos", "stop"), ("start", "end"), 0, "left_semi")


def read_classes(sites: DataFrame, reads: DataFrame, window: int = 50, least_percent: int = 70, least_clip: int = 200) -> DataFrame:
    """One row (ident, read, code) for every alignment near a site and class of evidence it gives.

    ``sites``: chrom, start, end, ident, te_size, sv_size, sv_type. At an INS site an operation whose end lies within
    ``window`` of the site gives I (insertion of at least ``least_percent`` % of the element), H or S (hard or soft clip longer
    than ``least_clip``, with a sequence); at any other site D (deletion of at least sv_size that begins in the window). An
    alignment without evidence gives E.
    """
    r = reads.filter("cigar <> '*'").withColumn("r_start", F.col("pos")).withColumn("r_end", F.col("pos") + F.greatest(reference_length(F.col("cigar")), F.lit(1)))
    r = r.select(F.col("rname").alias("chrom"), "r_start", "r_end", F.col("qname").alias("read"), "cigar", "seq")
    near = window_join(sites, r, ["chrom"], ("start", "end"), ("r_start", "r_end"), window, bin_size=1 << 12)
    lo, hi = F.col("start") - window, F.col("end") + window

    def code(x: dict) -> Column:
        at = F.col("r_start") + x["ref"]
        inside = at.between(lo, hi)
        with_seq = F.coalesce(F.length("seq"), F.lit(0)) > 0
        ins = F.when(inside & (x["op"] == "I") & (x["len"] * 100 >= F.col("te_size") * least_percent), "I").when(inside & (x["op"] == "H") & (x["len"] > least_clip) & with_seq, "H").when(inside & (x["op"] == "S") & (x["len"] > least_clip) & with_seq, "S")
        gone = F.when((x["op"] == "D") & (x["len"] >= F.col("sv_size")) & (at - x["len"]).between(lo, hi), "D")
        return F.when(F.col("sv_type") == "INS", ins).otherwise(gone)

    add = lambda a, x: {"codes": F.when(a["codes"].contains(code(x)), a["codes"]).otherwise(F.concat(a["codes"], F.coalesce(code(x), F.lit(""))))}
    codes = fold(F.col("cigar"), {"codes": F.lit("")}, add, lambda a: F.filter(F.split(a["codes"], ""), lambda c: c != ""))
    return near.select("ident", "read", F.explode(F.when(F.size(codes) > 0, codes).otherwise(F.array(F.lit("E")))).alias("code"))


def frequencies(classes: DataFrame, sites: DataFrame) -> DataFrame:
    """Frequencies of every site from the classes of its reads.

    A read has the least of its codes, so E of one alignment masks I of another. ``sites``: ident, support, tool, sv_type.
    INS: I counts reads of any class but E, no less than the support; total no less than I. Columns: i_only, i_clipped,
    total_no_clipped, i_all, total, freq_no_clip, freq_all. DEL: both frequencies are (total - D) / total. Two aggregates: by
    (site, read), then by site, both combined on the map side.
    """
    per_read = classes.groupBy("ident", "read").agg(F.min("code").alias("code"))
    n = lambda *codes: F.count_if(F.col("code").isin(*codes))
    per_site = per_read.groupBy("ident").agg(F.count(F.lit(1)).alias("reads"), n("D", "H", "I", "S").alias("with_any"), n("H", "S").alias("clipped"), n("I").alias("inserted"))
    f = per_site.join(sites.select("ident", "support", "tool", "sv_type"), "ident")
    rs = F.col("support")
    i_all = F.greatest("with_any", rs)
    only = F.when(F.col("tool") == "snif", F.greatest("inserted", rs)).otherwise(F.col("inserted"))
    f = f.withColumn("i_all", i_all).withColumn("total", F.greatest("reads", i_all)).withColumn("i_only", F.when(only == 0, rs).otherwise(only)).withColumn("i_clipped", F.col("clipped"))
    rest = F.col("total") - F.col("i_clipped")
    f = f.withColumn("total_no_clipped", F.when((rest < F.col("i_only")) | (rest == 0), F.col("total")).otherwise(rest))
    deletion = F.col("sv_type") == "DEL"
    share = lambda a, b: F.round(F.col(a) * 100 / F.nullif(F.col(b), F.lit(0)), 4)
    f = f.withColumn("freq_no_clip", share("i_only", "total_no_clipped")).withColumn("freq_all", share("i_all", "total"))
    gone = F.round((F.col("total") - F.col("i_all")) * 100 / F.nullif(F.col("total"), F.lit(0)), 4)
    return f.select("ident", "sv_type", "i_only", "i_clipped", "total_no_clipped", F.when(deletion, F.col("total") - F.col("i_all")).otherwise(F.col("i_all")).alias("i_all"), "total", *[F.when(deletion, gone).otherwise(F.col(c)).alias(c) for c in ("freq_no_clip", "freq_all")])


def precise(freq: DataFrame, elements: DataFrame) -> DataFrame:
    """Frequencies from how many supporting sequences carry the element; the base ones where that is above 100 % (A4).

    ``elements``: ident, n (of its element). If n is the total plus one, both denominators grow by one. Ids without n are left out.
    """
    j = freq.join(elements.filter("n > 0"), "ident")
    more = F.when(F.col("n") == F.col("total_no_clipped") + 1, 1).otherwise(0)
    a = F.round(F.col("n") * 100 / F.nullif(F.col("total_no_clipped") + more, F.lit(0)), 4)
    b = F.round((F.col("n") + F.col("i_clipped")) * 100 / F.nullif(F.col("total") + more, F.lit(0)), 4)
    return j.select("ident", "n", F.when(a <= 100, a).otherwise(F.col("freq_no_clip")).alias("freq_no_clip"), F.when(b <= 100, b).otherwise(F.col("freq_all")).alias("freq_all"))


def depth_frequency(df: DataFrame, left: str, right: str, without: str) -> DataFrame:
    """Frequency of an element in the assembly from the depths beside it and the reads without it.

    Adds total_depth = (left + right) div 2, read_support = total - without, percent with four decimals, cut and not rounded at
    the sixth place before; no or unknown depth gives zeros.
    """
    mean = F.expr(f"(coalesce({left}, 0) + coalesce({right}, 0)) div 2")
    df = df.withColumn("total_depth", mean).withColumn("read_support", F.when(F.col("total_depth") > 0, F.col("total_depth") - F.coalesce(F.col(without), F.lit(0))).otherwise(0))
    return df.withColumn("read_support_percent", F.when(F.col("total_depth") > 0, F.round(F.expr("(1000000 * read_support) div total_depth") * 100 * 1e-6, 4)).otherwise(0.0))


def deletion_support(sites: DataFrame, reads: DataFrame, window: int = 30, near: int = 30) -> DataFrame:
    """Reads with a deletion of the size of the site (give or take ``window``) whose begin or end is nearer than ``near``.

    One per read; sites without one have 0. ``sites``: chrom, start, end, ident.
    """
    r = reads.filter("cigar <> '*'").select(F.col("rname").alias("chrom"), F.col("pos").alias("r_start"), (F.col("pos") + F.greatest(reference_length(F.col("cigar")), F.lit(1))).alias("r_end"), F.col("qname").alias("read"), "cigar")
    pairs = window_join(sites.select("chrom", "start", "end", "ident"), r, ["chrom"], ("start", "end"), ("r_start", "r_end"), window, bin_size=1 << 12)
    size = F.col("end") - F.col("start")

    def fits(x: dict) -> Column:
        stop = F.col("r_start") + x["ref"]
        begin = stop - x["len"]
        return (x["op"] == "D") & x["len"].between(size - window, size + window) & ((F.abs(begin - F.col("start")) < near) | (F.abs(stop - F.col("end")) < near))

    found = pairs.filter(fold(F.col("cigar"), {"fits": F.lit(False)}, lambda a, x: {"fits": a["fits"] | fits(x)}, lambda a: a["fits"])).select("ident", "read").distinct().groupBy("ident").agg(F.count(F.lit(1)).alias("n_reads"))
    return sites.select("ident").distinct().join(found, "ident", "left").select("ident", F.coalesce("n_reads", F.lit(0)).alias("n_reads"))


def mapping_stats(reads: DataFrame) -> DataFrame:
    """One row of what a mapping holds (A15): records by flag and quality, lengths, bases by CIGAR, mismatches and their rate.

    ``reads``: flag, mapq, cigar, seq, nm. Secondary and supplementary records count as records only. NULL lengths count as 0.
    """
    kept = F.col("flag").bitwiseAND(2304) == 0
    mapped = kept & (F.col("flag").bitwiseAND(4) == 0)
    size, ops = F.length("seq").cast("bigint"), operations(F.col("cigar"))
    total = lambda c, e: F.coalesce(F.sum(F.when(c, e)), F.lit(0)).cast("bigint")
    aligned = total(mapped, length_over(ops, "MI=X"))
    return reads.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(kept).alias("sequences"), F.count_if(mapped).alias("reads_mapped"), F.count_if(kept & ~mapped).alias("reads_unmapped"), F.count_if(mapped & (F.col("mapq") == 0)).alias("reads_mq0"),
        F.count_if(F.col("flag").bitwiseAND(256) != 0).alias("non_primary"), F.count_if(F.col("flag").bitwiseAND(2048) != 0).alias("supplementary"), F.count_if(mapped & (F.col("flag").bitwiseAND(16) != 0)).alias("reads_reverse"),
        total(kept, size).alias("total_length"), total(mapped, size).alias("bases_mapped"), aligned.alias("bases_mapped_cigar"), total(mapped, F.col("nm")).alias("mismatches"),
        F.round(total(mapped, F.col("nm")) / F.nullif(aligned, F.lit(0)), 6).alias("error_rate"), F.round(total(kept, size) / F.nullif(F.count_if(kept), F.lit(0)), 4).alias("average_length"), F.max(F.when(kept, size)).alias("maximum_length"),
    )


def clipped_sequences(clips: DataFrame, sequences: DataFrame) -> DataFrame:
    """Hard clips (read, side, len, ...) with the bases that were cut off, from the whole reads (name, seq) (A21, SC18).

    A left clip is the beginning of the read, a right one its end. Clips of reads that aren't there are left out; ``sequences`` has
    a read once.
    """
    s = sequences.select(F.col("name").alias("read"), F.col("seq").alias("__whole"))
    n = F.col("len").cast("int")
    return clips.join(s, "read").withColumn("clipped", F.when(F.col("side") == "L", F.left("__whole", n)).otherwise(F.right("__whole", n))).drop("__whole")


def clip_groups(clips: DataFrame, d: int = 50) -> DataFrame:
    """Soft clips within ``d`` of each other on a chromosome as one group (A20): per side the longest clip and the distinct reads.

    ``clips``: chrom, pos, side (L or R), read, seq. Equal lengths: the least sequence. Reads come sorted.
    """
    from strandloom.operators.intervals import cluster

    there = clips.filter("seq is not null and side is not null and read is not null").withColumn("__end", F.col("pos") + 1)
    c = cluster(there, ["chrom"], "pos", "__end", d)
    side = lambda s, e: F.when(F.col("side") == s, e)
    best = lambda s: F.min(side(s, F.struct(-F.length("seq"), F.col("seq")))).getField("seq")
    return c.groupBy("chrom", "cluster").agg(F.min("pos").alias("start"), F.max("__end").alias("end"), best("L").alias("best_l"), best("R").alias("best_r"), F.count_distinct(side("L", F.col("read"))).alias("reads_l"), F.count_distinct(side("R", F.col("read"))).alias("reads_r"), F.count_distinct("read").alias("n_reads"))
