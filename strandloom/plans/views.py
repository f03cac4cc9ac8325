"""Views over the project's tables that the queries of the core share, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.operators.eager import present
from strandloom.session import table

HIT_COLUMNS = ("line_no", "qseqid", "sseqid", "pident", "aln_len", "mismatch", "gapopen", "qstart", "qend", "sstart", "send", "evalue", "bitscore")


def stored_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole hits as stored, copies too; for operators that copies don't matter to."""
    df = table(spark, sf_dir, "blast_hits").filter(present("qseqid") & present("sseqid")).filter("sstart is not null and send is not null and line_no is not null and bitscore >= 0 and not isnan(bitscore)")
    return df.select(*HIT_COLUMNS)


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole hits, one row for each line of the hit file."""
    return stored_hits(spark, sf_dir).dropDuplicates(["line_no"])


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element sites with real coordinates, copies once: chrom, start, end, te, ident, strand, sv_id, sv_type and the numbers."""
    df = table(spark, sf_dir, "te_infos").filter(present("chrom")).filter("start_pos is not null and end_pos is not null and te_id is not null and sv_id is not null")
    number = lambda c, k="bigint": F.expr(f"try_cast({c} as {k})").alias(c)
    return df.select(
        "chrom", F.col("start_pos").alias("start"), F.greatest(F.col("end_pos"), F.col("start_pos") + 1).alias("end"),
        F.split_part("te_id", F.lit("|"), F.lit(1)).alias("te"), F.split_part("te_id", F.lit("|"), F.lit(2)).alias("ident"),
        "strand", "tsd", "pident", "psize_te", number("size_te"), "new_pos", number("freq", "double"), number("freq_with_clipped", "double"), number("sv_size"), "sv_id", "sv_type",
    ).distinct()


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read evidence with real places, copies once."""
    return table(spark, sf_dir, "ins_evidence").filter(present("chrom")).filter("pos is not null and op_len is not null and read_name is not null").select("chrom", "pos", F.col("pos1"), "read_name", "seq", "count_read", "count_read_real", "op_len").distinct()


def evidence_of(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The named columns of the read evidence where each of them is there, copies once; other columns don't matter."""
    df = table(spark, sf_dir, "ins_evidence").select(*columns)
    for c in columns:
        df = df.filter(present(c) if c == "chrom" else F.col(c).isNotNull())
    return df.distinct()


def stored_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments with all coordinates as stored, copies too; for operators that copies don't matter to."""
    return table(spark, sf_dir, "alignments").dropna(subset=["rstart", "rend", "qstart", "qend", "rid", "qid"])


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments with all coordinates, copies once."""
    return stored_alignments(spark, sf_dir).distinct()


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments of reads derived from the evidence: rname, pos, qname, flag, mapq, cigar, seq."""
    return evidence(spark, sf_dir).select(
        F.col("chrom").alias("rname"), "pos", F.col("read_name").alias("qname"), F.expr("case count_read % 7 when 0 then 4 when 1 then 2048 when 2 then 16 else 0 end").cast("bigint").alias("flag"), (F.col("op_len") % 60).alias("mapq"),
        F.expr("concat(count_read % 90 + 10, 'S', pos % 400 + 100, 'M', op_len, case when op_len % 2 = 0 then 'I' else 'D' end, count_read % 300 + 50, 'M', case when op_len % 3 = 0 then concat(pos % 500 + 50, 'H') else '' end)").alias("cigar"), "seq",
    ).distinct()


SQL = {
    "hits": "hits AS (SELECT DISTINCT line_no, qseqid, sseqid, pident, aln_len, mismatch, gapopen, qstart, qend, sstart, send, evalue, bitscore FROM blast_hits WHERE qseqid NOT IN ('.', 'NONE') AND sseqid NOT IN ('.', 'NONE') AND sstart IS NOT NULL AND send IS NOT NULL AND line_no IS NOT NULL AND bitscore >= 0 AND NOT isnan(bitscore))",
    "sites": """sites AS (SELECT DISTINCT chrom, start_pos AS "start", greatest(end_pos, start_pos + 1) AS "end", split_part(te_id, '|', 1) AS te, split_part(te_id, '|', 2) AS ident, strand, tsd, pident, psize_te, TRY_CAST(size_te AS BIGINT) AS size_te, new_pos,
  TRY_CAST(freq AS DOUBLE) AS freq, TRY_CAST(freq_with_clipped AS DOUBLE) AS freq_with_clipped, TRY_CAST(sv_size AS BIGINT) AS sv_size, sv_id, sv_type FROM te_infos WHERE chrom NOT IN ('.', 'NONE') AND start_pos IS NOT NULL AND end_pos IS NOT NULL AND te_id IS NOT NULL AND sv_id IS NOT NULL)""",
    "evidence": "evidence AS (SELECT DISTINCT chrom, pos, pos1, read_name, seq, count_read, count_read_real, op_len FROM ins_evidence WHERE chrom NOT IN ('.', 'NONE') AND pos IS NOT NULL AND op_len IS NOT NULL AND read_name IS NOT NULL)",
    "aligned": "aligned AS (SELECT DISTINCT * FROM alignments WHERE rstart IS NOT NULL AND rend IS NOT NULL AND qstart IS NOT NULL AND qend IS NOT NULL AND rid IS NOT NULL AND qid IS NOT NULL)",
}
SQL["reads"] = SQL["evidence"] + """, reads AS (SELECT DISTINCT chrom AS rname, pos, read_name AS qname, CAST(CASE count_read % 7 WHEN 0 THEN 4 WHEN 1 THEN 2048 WHEN 2 THEN 16 ELSE 0 END AS BIGINT) AS flag, op_len % 60 AS mapq,
  concat(count_read % 90 + 10, 'S', pos % 400 + 100, 'M', op_len, CASE WHEN op_len % 2 = 0 THEN 'I' ELSE 'D' END, count_read % 300 + 50, 'M', CASE WHEN op_len % 3 = 0 THEN concat(pos % 500 + 50, 'H') ELSE '' END) AS cigar, seq FROM evidence)"""


def sql(*names: str) -> str:
    """A WITH clause of the named views."""
    return "WITH " + ",\n".join(SQL[n] for n in names) + "\n"


def evidence_of_sql(name: str, *columns: str) -> str:
    """``evidence_of`` as a view of that name, for a WITH clause."""
    there = " AND ".join("chrom NOT IN ('.', 'NONE')" if c == "chrom" else f"{c} IS NOT NULL" for c in columns)
    return f"{name} AS (SELECT DISTINCT {', '.join(columns)} FROM ins_evidence WHERE {there})"
