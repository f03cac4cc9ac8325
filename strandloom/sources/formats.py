"""Text formats as DataFrames. ``parse_*`` take a DataFrame of lines (column ``value``), ``read_*`` a path.

Plain line formats are read by Spark's own splittable text and csv readers. Records of several lines (FASTA) are cut at their
marker by the reader; only FASTQ, whose quality lines may hold any marker, needs a reader that keeps state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.functions.text import attributes
from strandloom.session import bounded_rows


def _schema(*fields: tuple[str, str]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in fields)


HIT_SCHEMA = _schema(("qseqid", "string"), ("sseqid", "string"), ("pident", "double"), ("aln_len", "bigint"), ("mismatch", "bigint"), ("gapopen", "bigint"), ("qstart", "bigint"), ("qend", "bigint"), ("sstart", "bigint"), ("send", "bigint"), ("evalue", "double"), ("bitscore", "double"))
BED_SCHEMA = _schema(("chrom", "string"), ("start", "bigint"), ("end", "bigint"), ("te_id", "string"), ("size", "bigint"), ("strand", "string"))
PAF_SCHEMA = _schema(("qname", "string"), ("qlen", "bigint"), ("qstart", "bigint"), ("qend", "bigint"), ("strand", "string"), ("tname", "string"), ("tlen", "bigint"), ("tstart", "bigint"), ("tend", "bigint"), ("matches", "bigint"), ("block", "bigint"), ("mapq", "bigint"))
GFF_SCHEMA = _schema(("seqid", "string"), ("source", "string"), ("feature", "string"), ("start", "bigint"), ("end", "bigint"), ("score", "string"), ("strand", "string"), ("phase", "string"), ("attributes", "string"))
FACT_SCHEMA = _schema(("chrom", "string"), ("start", "bigint"), ("end", "bigint"), ("te_id", "string"), ("strand", "string"), ("tsd", "string"), ("pident", "double"), ("psize_te", "double"), ("size_te", "string"), ("new_pos", "bigint"), ("freq", "string"), ("freq_with_clipped", "string"), ("sv_size", "string"), ("sv_id", "string"), ("sv_type", "string"))


def parse_tabbed(lines: DataFrame, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """The fields of tab-separated lines (``value``) by position, with the columns ``keep``; what a line lacks or doesn't fit its type is NULL.

    Empty lines and those that begin with # are dropped.
    """
    parts = F.split("value", "\t")
    fields = T.StructType.fromDDL(schema).fields
    kept = lines.filter("value <> '' and value not like '#%'")
    return kept.select(*keep, *[F.get(parts, F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


def _tabbed(spark: SparkSession, path, schema: str) -> DataFrame:
    return parse_tabbed(spark.read.text(path), schema)


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """(name, seq): the whole header without its marker; sequence lines joined, blanks dropped, upper case. Records without a header are dropped."""
    records = spark.read.option("lineSep", "\n>").text(path)
    return parse_fasta_records(records)


def parse_fasta_records(records: DataFrame) -> DataFrame:
    body = F.regexp_replace("value", "\r", "")
    whole = F.regexp_replace(body, "^>", "")
    name = F.trim(F.substring_index(whole, "\n", 1))
    seq = F.when(F.instr(whole, "\n") > 0, F.upper(F.regexp_replace(F.substring(whole, F.instr(whole, "\n") + 1, F.length(whole)), r"\s", "")))
    return records.select(name.alias("name"), F.coalesce(seq, F.lit("")).alias("seq")).filter("name <> ''")


def read_numbered(spark: SparkSession, path) -> DataFrame:
    """(path, line_no, value): the lines of text files with their number in their file, from 1.

    Files are read in splits by as many tasks; the lines of a split are counted first, and what the splits before it hold is added.
    """
    m = F.col("_metadata")
    lines = spark.read.text(path).select("value", m["file_path"].alias("path"), m["file_block_start"].alias("__block"), F.monotonically_increasing_id().alias("__id"))
    blocks = lines.groupBy("path", "__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    # One row for each split of a file.
    before = Window.partitionBy("path").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blocks.select("path", "__block", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    return lines.join(shifts, ["path", "__block"]).select("path", (F.col("__id") + F.col("__shift")).alias("line_no"), "value")


def parse_hits(lines: DataFrame) -> DataFrame:
    """Similarity hits of lines (line_no, value)."""
    return parse_tabbed(lines, HIT_SCHEMA, ["line_no"])


def read_hits(spark: SparkSession, path) -> DataFrame:
    """Similarity hits with ``line_no``, the line in their file from 1 (order matters for the operators on hits)."""
    return parse_hits(read_numbered(spark, path))


def parse_bed(lines: DataFrame) -> DataFrame:
    """Intervals of three to six columns; missing ones are NULL. Adds te and ident, the parts of te_id."""
    bed = parse_tabbed(lines, BED_SCHEMA)
    return bed.withColumn("te", F.get(F.split("te_id", r"\|"), F.lit(0))).withColumn("ident", F.get(F.split("te_id", r"\|"), F.lit(1)))


def read_bed(spark: SparkSession, path) -> DataFrame:
    return parse_bed(spark.read.text(path))


def parse_paf(lines: DataFrame) -> DataFrame:
    return parse_tabbed(lines, PAF_SCHEMA)


def read_paf(spark: SparkSession, path) -> DataFrame:
    return parse_paf(spark.read.text(path))


def read_gff(spark: SparkSession, path) -> DataFrame:
    return parse_gff(spark.read.text(path))


def parse_gff(lines: DataFrame) -> DataFrame:
    """Features, start 0-based, with their attributes as a map."""
    g = parse_tabbed(lines, GFF_SCHEMA)
    return g.withColumn("start", F.col("start") - 1).withColumn("attributes", attributes(F.col("attributes")))


def read_facts(spark: SparkSession, path) -> DataFrame:
    return _tabbed(spark, path, FACT_SCHEMA)


def read_sizes(spark: SparkSession, path) -> DataFrame:
    """(name, size_bp) of a sequence index."""
    return _tabbed(spark, path, "name string, size_bp bigint, a string, b string, c string").select("name", "size_bp")


def sequence_index(sequences: DataFrame) -> DataFrame:
    return sequences.select("name", F.length("seq").cast("bigint").alias("size_bp"))


def read_manifest(spark: SparkSession, path) -> list[tuple[str, str, int]]:
    """(folder, group, number) of each generation: lines ``folder:G7``, or folders alone, which are numbered by line.

    Named ones are sorted by number. More than 10,000 lines raise.
    """
    lines = [r[0].strip() for r in bounded_rows(spark.read.text(path), 10_000, "a manifest of generations") if r[0].strip()]
    out = []
    for i, line in enumerate(lines, 1):
        folder, _, group = line.partition(":")
        group = group or f"G{i}"
        out.append((folder.rstrip("/"), group, int(group.lstrip("G"))))
    return sorted(out, key=lambda x: x[2])


def parse_vcf(lines: DataFrame) -> DataFrame:
    """Variant lines: chrom, pos (1-based), id, ref, alt, qual, filter, info as a map; comment and short lines are dropped."""
    parts = F.split("value", "\t")
    kept = lines.filter("value not like '#%'").filter(F.size(parts) >= 8)
    at = lambda i: F.get(parts, F.lit(i))
    return kept.select(at(0).alias("chrom"), at(1).try_cast("bigint").alias("pos"), *[at(i).alias(n) for i, n in ((2, "id"), (3, "ref"), (4, "alt"), (5, "qual"), (6, "filter"))], attributes(at(7)).alias("info"))


def contigs(lines: DataFrame) -> DataFrame:
    """(name, size_bp) of the ##contig lines of a variant file; the size is NULL where it isn't given."""
    head = lines.filter("value like '##contig=%'")
    return head.select(F.regexp_extract("value", "[<,]ID=([^,>]+)", 1).alias("name"), F.regexp_extract("value", "[<,]length=([0-9]+)", 1).try_cast("bigint").alias("size_bp"))


def read_vcf(spark: SparkSession, path, chrom: str = ".") -> tuple[str, DataFrame]:
    """The version of a variant file (4.1, 4.2 or 4.3; others raise) and its parsed lines.

    A file that names its contigs must name one that matches ``chrom`` (patterns with commas between them), or this raises.
    """
    lines = spark.read.text(path)
    heads = lines.filter("value like '##fileformat=%'").limit(1).collect()
    version = heads[0][0].strip().partition("VCFv")[2] if heads else ""
    if version not in ("4.1", "4.2", "4.3"):
        raise ValueError(f"unknown variant format {version!r}")
    named = contigs(lines).agg(F.count(F.lit(1)), F.count_if(F.col("name").rlike(chrom.replace(",", "|")))).collect()[0]
    if named[0] and not named[1]:
        raise ValueError(f"no contig of the file matches {chrom!r}")
    return version, parse_vcf(lines)


def variant_sequences(variants: DataFrame, version: str, least: int = 1000, most: int = -1, without: Sequence[str] = ("DEL",), chrom: str = ".", keep_all_n: bool = False) -> DataFrame:
    """(name, seq) of the sequences of variants, the name being the packed variant key; N becomes A.

    4.1: the alternative of an insertion, the reference of a deletion; 4.2: each of SEQS; 4.3: the alternative, support from
    SUPPORT. Lengths must exceed ``least`` and not exceed ``most`` (-1: any). Sequences of N only are dropped unless kept.
    """
    info = lambda k: F.element_at("info", F.lit(k))
    v = variants.withColumn("kind", info("SVTYPE")).filter(F.col("chrom").rlike(chrom.replace(",", "|")) & ~F.col("kind").isin(*without))
    support = info("SUPPORT") if version == "4.3" else info("RE")
    if version == "4.2":
        v = v.withColumn("seq", F.explode(F.split(info("SEQS"), ",")))
        ident = F.col("id")
    else:
        v = v.withColumn("seq", F.when(F.col("kind") == "INS", F.col("alt")).when((F.col("kind") == "DEL") & F.lit(version == "4.1"), F.col("ref")).otherwise(F.col("alt")))
        ident = F.concat(F.lit("sniffles."), "kind", F.lit("."), "id")
    v = v.filter(F.col("seq").rlike("^[A-Za-z]+$") & (F.length("seq") > least))
    if most >= 0:
        v = v.filter(F.length("seq") <= most)
    if not keep_all_n:
        v = v.filter(~F.upper("seq").rlike("^N+$"))
    precision = F.when(F.map_contains_key("info", "IMPRECISE"), "IMPRECISE").otherwise("PRECISE")
    name = F.concat_ws(":", "chrom", F.concat(F.lit("<"), "kind", F.lit(">")), F.col("pos").cast("string"), info("END"), ident, F.coalesce(support, F.lit("1")), precision)
    return v.select(name.alias("name"), F.translate(F.upper("seq"), "N", "A").alias("seq"))


def supporting_reads(variants: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """(chrom, pos, id, kind, read_name): the reads named in RNAMES or READS; ``only``: a DataFrame of ids to keep."""
    names = F.coalesce(F.element_at("info", F.lit("RNAMES")), F.element_at("info", F.lit("READS")))
    out = variants.select("chrom", "pos", "id", F.element_at("info", F.lit("SVTYPE")).alias("kind"), F.explode(F.split(names, ",")).alias("read_name"))
    return out if only is None else out.join(only.select("id").distinct(), "id", "left_semi")


def parse_sam(lines: DataFrame) -> DataFrame:
    """Alignments: qname, flag, rname, pos (0-based), mapq, cigar, seq, qual, nm; header lines and rows without CIGAR are dropped."""
    parts = F.split("value", "\t")
    at = lambda i: F.get(parts, F.lit(i))
    nm = F.nullif(F.regexp_extract("value", r"\tNM:i:(-?\d+)", 1), F.lit(""))
    kept = lines.filter("value not like '@%'").filter((F.size(parts) >= 11) & (at(5) != "*"))
    return kept.select(at(0).alias("qname"), at(1).cast("bigint").alias("flag"), at(2).alias("rname"), (at(3).cast("bigint") - 1).alias("pos"), at(4).cast("bigint").alias("mapq"), at(5).alias("cigar"), at(9).alias("seq"), at(10).alias("qual"), nm.cast("bigint").alias("nm"))


def parse_sam_sizes(lines: DataFrame) -> DataFrame:
    """(name, size_bp) from the @SQ lines."""
    sq = lines.filter("value like '@SQ%'")
    return sq.select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("name"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("bigint").alias("size_bp"))


def read_sam(spark: SparkSession, path, need_nm: bool = False) -> DataFrame:
    return _with_nm(parse_sam(spark.read.text(path)), need_nm)


def _with_nm(out: DataFrame, need_nm: bool) -> DataFrame:
    if need_nm:
        out = out.withColumn("nm", F.when(F.col("nm").isNull(), F.raise_error(F.lit("an alignment has no NM tag"))).otherwise(F.col("nm")).cast("bigint"))
    return out


def read_bam(spark: SparkSession, path, need_nm: bool = False) -> DataFrame:
    """Alignments of binary files, with the columns of ``parse_sam`` (SC9); a task reads a file. Regions: ``evidence.in_regions``."""
    register(spark)
    return _with_nm(spark.read.format("bam_alignments").load(path), need_nm)


def alignment_coords(sam: DataFrame, sizes: DataFrame) -> DataFrame:
    """Coordinates of alignments on reference and query (rstart, rend, qstart, qend, rlen, qlen, rid, qid); reverse ones run down."""
    from strandloom.functions.cigar import length_over, operations

    ops = operations(F.col("cigar"))
    first, last = F.get(ops, F.lit(0)), F.element_at(ops, -1)
    clip = lambda x: F.when(x["op"].isin("S", "H"), x["len"]).otherwise(0)
    qlen = length_over(ops, "MI=XSH")
    span = length_over(ops, "MI=X")
    reverse = F.col("flag").bitwiseAND(16) != 0
    s = F.when(reverse, clip(last)).otherwise(clip(first))
    rend = F.col("pos") + length_over(ops, "MD=XN")
    a = sam.join(sizes.select(F.col("name").alias("rname"), F.col("size_bp").alias("rlen")), "rname", "left")
    return a.select(F.col("pos").alias("rstart"), rend.alias("rend"), F.when(reverse, s + span).otherwise(s).alias("qstart"), F.when(reverse, s).otherwise(s + span).alias("qend"), "rlen", qlen.alias("qlen"), F.col("rname").alias("rid"), F.col("qname").alias("qid"))


def read_fastq(spark: SparkSession, path, four_lines: bool = False) -> DataFrame:
    """(name, seq, qual) of reads; sequences and qualities may run over several lines, files may be gzipped.

    Only whoever read a file from its beginning knows where a read of any number of lines begins, so a task reads a file, which
    must be local or on a mount of all executors. With ``four_lines`` every read has four lines, as ``write_fastq`` makes them;
    then files are read in splits and from any file system, and lines meet by their number. A file cut off within a read raises.
    """
    if not four_lines:
        register(spark)
        return spark.read.format("reads_fastq").load(path)
    part = F.pmod(F.col("line_no") - 1, F.lit(4))
    at = lambda i: F.max(F.when(part == i, F.col("value")))
    lines = read_numbered(spark, path).withColumn("value", F.regexp_replace("value", "\r$", ""))
    reads = lines.groupBy("path", F.expr("(line_no - 1) div 4").alias("n")).agg(at(0).alias("a"), at(1).alias("b"), at(2).alias("c"), at(3).alias("d"))
    whole = F.col("a").startswith("@") & F.col("c").startswith("+") & F.col("d").isNotNull() & (F.length("b") == F.length("d"))
    name = F.when(whole, F.substring("a", 2, 1 << 30)).otherwise(F.raise_error(F.concat(F.lit("no read of four lines: "), F.coalesce("a", F.lit("")))))
    return reads.select(name.cast("string").alias("name"), F.upper("b").alias("seq"), F.col("d").alias("qual"))


def parse_fastq(texts: DataFrame) -> DataFrame:
    """(name, seq, qual) of the reads in texts (``value``) that each hold whole reads."""
    from strandloom.sources.readers import fastq_records

    return texts.select(F.explode(fastq_records("value")).alias("r")).select("r.*")


def read_delta(spark: SparkSession, path) -> DataFrame:
    """Alignments of a delta file with their indel offsets: rid, qid, rlen, qlen, rstart, rend, qstart, qend, errors, offsets."""
    register(spark)
    return spark.read.format("delta_alignments").load(path)


def parse_delta(texts: DataFrame) -> DataFrame:
    """The same of texts (``value``) that each hold a whole delta file."""
    from strandloom.sources.readers import delta_records

    return texts.select(F.explode(delta_records("value")).alias("r")).select("r.*")


def register(spark: SparkSession) -> None:
    from strandloom.session import importable
    from strandloom.sources import readers

    importable(spark)
    for source in readers.SOURCES:
        spark.dataSource.register(source)


def tabbed_text(df: DataFrame) -> DataFrame:
    """The tab-separated line of each row in one value; NULL is an empty field."""
    return df.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]).alias("value"))


# -- sinks -------------------------------------------------------------------------------------------------------------
def fasta_text(sequences: DataFrame) -> DataFrame:
    """The two lines of each sequence in one value."""
    return sequences.select(F.concat(F.lit(">"), "name", F.lit("\n"), "seq").alias("value"))


def write_fasta(sequences: DataFrame, path: str) -> None:
    """Two lines for each sequence; part files in a folder."""
    fasta_text(sequences).write.mode("overwrite").text(path)


def fastq_text(reads: DataFrame) -> DataFrame:
    """The four lines of each read in one value (SC3)."""
    return reads.select(F.concat(F.lit("@"), "name", F.lit("\n"), "seq", F.lit("\n+\n"), F.coalesce("qual", F.lit(""))).alias("value"))


def write_fastq(reads: DataFrame, path: str) -> None:
    fastq_text(reads).write.mode("overwrite").text(path)


def write_tabbed(df: DataFrame, path: str, header: bool = False) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", header).option("quote", "").option("emptyValue", "").csv(path)


def write_facts(df: DataFrame, path: str, by: str = "chrom") -> None:
    """The fact table by chromosome, which is also its index for reading one of them."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def write_json_parts(df: DataFrame, path: str, parts: int) -> None:
    df.repartition(parts).write.mode("overwrite").json(path)
