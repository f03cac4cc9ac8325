"""Queries of the text formats: lines made from the tables, parsed as a file's would be, with SQL for what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.operators import report
from strandloom.plans.views import HIT_COLUMNS, aligned, evidence_of, evidence_of_sql, reads, sites, sql, stored_alignments
from strandloom.session import table
from strandloom.sources import formats

QUERIES, SQL = {}, {}


def query(text: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, text
        return f

    return add


def _line(*fields):
    """A tab-separated line; NULL is an empty field."""
    return F.concat_ws("\t", *[F.coalesce((F.col(f) if isinstance(f, str) else f).cast("string"), F.lit("")) for f in fields]).alias("value")


_READS = "WITH " + evidence_of_sql("e", "read_name", "pos", "seq") + "\n"


def _fastq_texts(spark, d):
    """Two reads in each text: one of the evidence, folded to lines of ten, and one whose quality looks like a header."""
    e = evidence_of(spark, d, "read_name", "pos", "seq").filter("seq <> ''")
    folded = lambda c: F.regexp_replace(c, "(.{10})", "$1\n")
    return e.select(F.concat(F.lit("@"), "read_name", F.lit(" "), F.col("pos").cast("string"), F.lit("\n"), folded(F.lower("seq")), F.lit("\n+\n"), folded(F.expr("repeat('@', length(seq))")), F.lit("\n@last\nAC\n+\n@+\n")).alias("value"))


@query(_READS + "SELECT read_name || ' ' || pos AS name, upper(seq) AS seq, repeat('@', length(seq)) AS qual FROM e WHERE seq <> '' UNION SELECT 'last', 'AC', '@+' FROM e WHERE seq <> ''")
def sc2_fastq_reads(spark, d):
    """Reads of several lines (SC2)."""
    return formats.parse_fastq(_fastq_texts(spark, d)).distinct()


@query(_READS + "SELECT '@' || read_name || ' ' || pos || chr(10) || upper(seq) || chr(10) || '+' || chr(10) || repeat('@', length(seq)) AS record FROM e WHERE seq <> ''")
def sc3_fastq_lines(spark, d):
    """Reads of several lines written with four (SC3)."""
    return formats.fastq_text(formats.parse_fastq(_fastq_texts(spark, d)).filter("name <> 'last'")).select(F.col("value").alias("record"))


def _coded(name: str):
    """A name that fits a field: % and its bytes in hex where it is empty, begins like a comment or like this, or holds a tab."""
    c = F.col(name)
    # One pattern: with four conditions the query's generated method passes the 8000 bytes that Java compiles.
    return F.when(c.rlike("^([#%]|$)|\t"), F.concat(F.lit("%"), F.hex(c))).otherwise(c)


def _decoded(name: str):
    c = F.col(name)
    return F.when(c.startswith("%"), F.unhex(F.expr(f"substring({name}, 2)")).cast("string")).when(c != "", c).alias(name)


@query("SELECT " + ", ".join(HIT_COLUMNS) + ", coalesce(isnan(bitscore), false) AS bitscore_nan FROM blast_hits WHERE line_no IS NOT NULL")
def sc4_hit_lines(spark, d):
    """Every line of the hit file, all of its fields (SC4)."""
    names = ("qseqid", "sseqid")
    lines = table(spark, d, "blast_hits").filter("line_no is not null").select("line_no", _line(*[_coded(c) if c in names else c for c in HIT_COLUMNS[1:]]))
    h = formats.parse_hits(lines)
    return h.select("line_no", *[_decoded(c) if c in names else c for c in HIT_COLUMNS[1:]], F.coalesce(F.isnan("bitscore"), F.lit(False)).alias("bitscore_nan"))


@query("SELECT chrom AS name, size_bp FROM chrom_sizes WHERE chrom IS NOT NULL")
def sc5_contigs(spark, d):
    """The contigs that the header of a variant file names (SC5)."""
    c = table(spark, d, "chrom_sizes").filter("chrom is not null")
    return formats.contigs(c.select(F.concat(F.lit("##contig=<ID="), "chrom", F.lit(",length="), F.col("size_bp").cast("string"), F.lit(">")).alias("value")))


_VARIANTS = """, v AS (SELECT DISTINCT chrom, "start" + 1 AS pos, ident, "end", CASE WHEN sv_type LIKE 'INS%' THEN 'INS' ELSE 'DEL' END AS kind, coalesce(sv_size, 0) AS n FROM sites)
"""


def _variants(spark, d, version: str):
    s = sites(spark, d).select("chrom", (F.col("start") + 1).alias("pos"), "ident", "end", F.when(F.col("sv_type").startswith("INS"), "INS").otherwise("DEL").alias("kind"), F.coalesce("sv_size", F.lit(0)).alias("n")).distinct()
    text = lambda c: F.col(c).cast("string")
    info = [F.lit("SVTYPE="), F.col("kind"), F.lit(";END="), text("end"), F.lit(";RE="), (1 + F.col("n") % 9).cast("string"), F.lit(";SUPPORT="), (2 + F.col("n") % 7).cast("string"), F.when(F.col("n") % 2 == 0, ";IMPRECISE").otherwise(";PRECISE")]
    if version == "4.2":
        info += [F.lit(";SEQS="), F.expr("concat(repeat('ACGN', cast(1 + n % 300 as int)), ',', repeat('NN', cast(1 + n % 250 as int)), ',', repeat('GT', cast(1 + n % 400 as int)))")]
    lines = s.select(_line("chrom", "pos", "ident", F.lit("N"), F.when(F.col("kind") == "INS", F.expr("repeat('acgtn', cast(1 + n % 300 as int))")).otherwise("<DEL>"), F.lit("."), F.lit("PASS"), F.concat(*info)))
    return formats.parse_vcf(lines)


@query(sql("sites") + _VARIANTS + """, q AS (SELECT *, unnest([repeat('ACGN', (1 + n % 300)::INT), repeat('NN', (1 + n % 250)::INT), repeat('GT', (1 + n % 400)::INT)]) AS seq FROM v)
SELECT chrom || ':<' || kind || '>:' || pos || ':' || "end" || ':' || ident || ':' || (1 + n % 9) || ':' || CASE WHEN n % 2 = 0 THEN 'IMPRECISE' ELSE 'PRECISE' END AS name, replace(seq, 'N', 'A') AS seq FROM q WHERE length(seq) > 200 AND length(seq) <= 900 AND NOT regexp_full_match(seq, 'N+')""")
def sc6_variant_sequences_42(spark, d):
    """Each sequence of a variant from a file of version 4.2, those of N alone left out (SC6)."""
    return formats.variant_sequences(_variants(spark, d, "4.2"), "4.2", least=200, most=900, without=[])


@query(sql("sites") + _VARIANTS + """SELECT chrom || ':<INS>:' || pos || ':' || "end" || ':sniffles.INS.' || ident || ':' || (2 + n % 7) || ':' || CASE WHEN n % 2 = 0 THEN 'IMPRECISE' ELSE 'PRECISE' END AS name, replace(upper(repeat('acgtn', (1 + n % 300)::INT)), 'N', 'A') AS seq FROM v WHERE kind = 'INS' AND length(repeat('acgtn', (1 + n % 300)::INT)) > 500 AND regexp_matches(chrom, 'A|scf')""")
def sc6_variant_sequences_43(spark, d):
    """Alternatives of a file of version 4.3, of some chromosomes, without deletions (SC6)."""
    return formats.variant_sequences(_variants(spark, d, "4.3"), "4.3", least=500, without=["DEL"], chrom="A,scf")


@query(sql("reads") + "SELECT rname, pos, qname, flag, mapq, cigar, seq, pos % 50 AS nm FROM reads WHERE seq IS NOT NULL AND seq <> ''")
def sc8_alignment_lines(spark, d):
    """Alignments with their NM tag; header lines and rows without CIGAR are dropped (SC8)."""
    r = reads(spark, d).filter("seq is not null and seq <> ''")
    lines = r.select(_line("qname", "flag", "rname", F.col("pos") + 1, "mapq", "cigar", F.lit("*"), F.lit(0), F.lit(0), "seq", F.lit("*"), F.concat(F.lit("NM:i:"), (F.col("pos") % 50).cast("string"))))
    header = r.select(_line(F.lit("@SQ"), F.concat(F.lit("SN:"), "rname"), F.lit("LN:9"))).union(r.select(_line("qname", F.lit(4), F.lit("*"), F.lit(0), F.lit(0), F.lit("*"), F.lit("*"), F.lit(0), F.lit(0), "seq", F.lit("*"))))
    return formats.parse_sam(lines.union(header)).select("rname", "pos", "qname", "flag", "mapq", "cigar", "seq", "nm")


@query(sql("sites") + 'SELECT DISTINCT chrom, "start", "end", te || \'|\' || ident AS te_id, sv_size AS size, strand, te, ident FROM sites')
def sc10_bed_lines(spark, d):
    """Intervals of six columns with the parts of their name (SC10)."""
    s = sites(spark, d).select("chrom", "start", "end", F.concat("te", F.lit("|"), "ident").alias("te_id"), "sv_size", "strand").distinct()
    b = formats.parse_bed(s.select(_line(*s.columns)))
    return b.withColumn("strand", F.nullif("strand", F.lit("")))


@query(sql("aligned") + """, a AS (SELECT DISTINCT rid, qid, rlen, qlen, rstart, rend, qstart, qend FROM aligned WHERE rlen IS NOT NULL AND qlen IS NOT NULL)
SELECT rid, qid, rlen, qlen, rstart, rend, qstart, qend, abs(rend - rstart) % 40 AS errors, CASE WHEN rstart % 2 = 0 THEN 2 ELSE 0 END AS n_offsets, CASE WHEN rstart % 2 = 0 THEN 9 - rend ELSE 0 END AS sum_offsets FROM a""")
def sc12_delta_alignments(spark, d):
    """Alignments of delta files, one pair of sequences in each, with their offsets (SC12)."""
    a = stored_alignments(spark, d).filter("rlen is not null and qlen is not null").select("rid", "qid", "rlen", "qlen", "rstart", "rend", "qstart", "qend").distinct()
    text = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    head = F.concat(F.lit("/ref /qry\nNUCMER\n>"), F.concat_ws(" ", "rid", "qid", text("rlen"), text("qlen")), F.lit("\n"))
    errors = text(F.abs(F.col("rend") - F.col("rstart")) % 40)
    body = F.concat(F.concat_ws(" ", *[text(c) for c in ("rstart", "rend", "qstart", "qend")], errors, errors, F.lit("0")), F.when(F.col("rstart") % 2 == 0, F.concat(F.lit("\n10\n"), text(-F.col("rend") - 1))).otherwise(F.lit("")), F.lit("\n0\n"))
    found = formats.parse_delta(a.select(F.concat(head, body).alias("value")))
    total = F.aggregate("offsets", F.lit(0).cast("bigint"), lambda x, y: x + y)
    return found.select("rid", "qid", "rlen", "qlen", "rstart", "rend", "qstart", "qend", "errors", F.size("offsets").cast("bigint").alias("n_offsets"), total.alias("sum_offsets"))


@query(sql("aligned") + """SELECT qid AS qname, qlen, least(qstart, qend) AS qstart, greatest(qstart, qend) AS qend, CASE WHEN qend < qstart THEN '-' ELSE '+' END AS strand, rid AS tname, rlen AS tlen, least(rstart, rend) AS tstart, greatest(rstart, rend) AS tend, abs(rend - rstart) AS matches, abs(rend - rstart) + 5 AS block, 60 AS mapq FROM aligned""")
def sc13_paf_lines(spark, d):
    """Pairwise alignments, twelve columns and tags behind them (SC13)."""
    a = aligned(spark, d)
    span = F.abs(F.col("rend") - F.col("rstart"))
    lines = a.select(_line("qid", "qlen", F.least("qstart", "qend"), F.greatest("qstart", "qend"), F.when(F.col("qend") < F.col("qstart"), "-").otherwise("+"), "rid", "rlen", F.least("rstart", "rend"), F.greatest("rstart", "rend"), span, span + 5, F.lit(60), F.lit("tp:A:P")))
    return formats.parse_paf(lines)


@query(sql("sites") + """SELECT DISTINCT chrom AS seqid, "start", "end", CASE WHEN strand = '-' THEN 'R' ELSE 'L' END AS side, te AS name, ident FROM sites""")
def sc14_feature_lines(spark, d):
    """Features with their attributes; places in the file count from 1 (SC14)."""
    s = sites(spark, d).select("chrom", "start", "end", "te", "ident", F.when(F.col("strand") == "-", "R").otherwise("L").alias("side")).distinct()
    lines = s.select(_line("chrom", F.lit("x"), F.lit("flank"), F.col("start") + 1, "end", F.lit("."), F.lit("+"), F.lit("."), F.concat(F.lit("ID="), "ident", F.lit(";NAME="), "te", F.lit(";SIDE="), "side", F.lit(";done"))))
    g = formats.parse_gff(lines)
    at = lambda k: F.element_at("attributes", F.lit(k))
    return g.select("seqid", "start", "end", at("SIDE").alias("side"), at("NAME").alias("name"), at("ID").alias("ident"))


@query(sql("sites") + """SELECT DISTINCT chrom || chr(9) || "start" || chr(9) || "end" || chr(9) || te || '|' || ident || chr(9) || coalesce(sv_size::VARCHAR, '') || chr(9) || coalesce(strand, '') AS line FROM sites""")
def k2_interval_text(spark, d):
    """Sites as lines of an interval file (K2)."""
    s = sites(spark, d).select("chrom", "start", "end", F.concat("te", F.lit("|"), "ident").alias("te_id"), "sv_size", "strand").distinct()
    return formats.tabbed_text(s).withColumnRenamed("value", "line")


@query(_READS + "SELECT DISTINCT '>' || read_name || ' ' || pos || chr(10) || seq AS record FROM e")
def k2_sequence_text(spark, d):
    """Sequences as records of two lines (K2)."""
    e = evidence_of(spark, d, "read_name", "pos", "seq")
    return formats.fasta_text(e.select(F.concat_ws(" ", "read_name", "pos").alias("name"), "seq")).withColumnRenamed("value", "record").distinct()


@query(" UNION ALL ".join(f"SELECT '{n}' AS by, {e} AS key, count(*) AS n_rows, min(start_pos) AS lowest, max(start_pos) AS highest FROM te_infos WHERE {e} IS NOT NULL GROUP BY 2" for n, e in (("chrom", "chrom"), ("te", "split_part(te_id, '|', 1)"))))
def k6_indexes(spark, d):
    """Where the facts of each chromosome and of each family lie (K6)."""
    t = table(spark, d, "te_infos").withColumn("te", F.split_part("te_id", F.lit("|"), F.lit(1)))
    return report.row_index(t, "chrom", "start_pos").withColumn("by", F.lit("chrom")).unionByName(report.row_index(t, "te", "start_pos").withColumn("by", F.lit("te")))
