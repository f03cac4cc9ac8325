"""Queries of positions, names and records of several lines, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions import cigar as cg
from strandloom.functions import text as tx
from strandloom.operators import assembly
from strandloom.plans.views import evidence, evidence_of, evidence_of_sql, hits, reads, sites, sql
from strandloom.session import table
from strandloom.sources import formats

QUERIES, SQL = {}, {}


def query(text: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if text is not None:
            SQL[f.__name__] = text
        return f

    return add


@query("WITH " + evidence_of_sql("e", "read_name", "pos", "seq") + "\nSELECT DISTINCT read_name || ' ' || pos AS name, upper(seq) AS seq FROM e")
def sc1_fasta_records(spark, d):
    """The same of every sequence with a read and a position (SC1)."""
    text = F.concat(F.lit(">"), "read_name", F.lit(" "), F.col("pos").cast("string"), F.lit("\n"), F.regexp_replace(F.lower("seq"), "(.{10})", "$1\n"))
    return formats.parse_fasta_records(evidence_of(spark, d, "read_name", "pos", "seq").select(text.alias("value"))).distinct()


@query("WITH " + evidence_of_sql("e", "read_name", "seq") + "\nSELECT DISTINCT read_name AS name, length(seq) AS size_bp FROM e")
def sc11_sequence_index(spark, d):
    """The same of every sequence with a read (SC11)."""
    return formats.sequence_index(evidence_of(spark, d, "read_name", "seq").select(F.col("read_name").alias("name"), "seq")).distinct()


@query("WITH n AS (SELECT te_name AS original, 'ELEMENT' || row_number() OVER (ORDER BY te_name) AS pseudo FROM te_sizes), f AS (SELECT 'ELEMENT' || i AS pseudo FROM range(1, 120) AS t(i))\nSELECT coalesce(original, f.pseudo) AS name FROM f LEFT JOIN n ON f.pseudo = n.pseudo")
def rename_back(spark, d):
    """Pseudonyms as originals again; what isn't a pseudonym stays."""
    from pyspark.sql import Window

    names = table(spark, d, "te_sizes").select(F.col("te_name").alias("original"), F.concat(F.lit("ELEMENT"), F.row_number().over(Window.orderBy("te_name"))).alias("pseudo"))
    return tx.renamed(spark.range(1, 120).select(F.concat(F.lit("ELEMENT"), "id").alias("name")), "name", names)


_KEYS = """, e AS (SELECT DISTINCT ident || ':+:' || CASE WHEN sv_type = 'INSERTION' THEN 'Insertion' ELSE 'Repeat_expansion' END || '::' || chrom || ':' || "start" || '-' || "end" || ':' || coalesce(strand, '.') AS qseqid, te FROM sites),
v AS (SELECT ident AS asm_id, min({'c': chrom, 's': "start", 'e': "start" + 100, 't': CASE WHEN sv_type = 'INSERTION' THEN 'Insertion' ELSE 'Repeat_expansion' END}) AS v FROM sites GROUP BY ident)
"""


@query(sql("sites") + _KEYS + "SELECT qseqid, te || '|' || asm_id AS label, v.c AS chrom, v.s AS \"start\", CASE WHEN v.t = 'Insertion' THEN v.s + 1 ELSE v.e END AS stop FROM e JOIN v ON split_part(qseqid, ':', 1) = asm_id")
def j15_position_projection(spark, d):
    kind = F.when(F.col("sv_type") == "INSERTION", "Insertion").otherwise("Repeat_expansion")
    s = sites(spark, d)
    e = s.select(F.concat("ident", F.lit(":+:"), kind, F.lit("::"), "chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"), F.lit(":"), F.coalesce("strand", F.lit("."))).alias("qseqid"), F.col("te").alias("sseqid")).distinct()
    v = s.select(F.col("ident").alias("asm_id"), "chrom", "start", (F.col("start") + 100).alias("stop"), kind.alias("sv_type"))
    return assembly.project_positions(e, v)


@query(sql("hits") + """, h AS (SELECT split_part(qseqid, ':', 5) AS ident, CASE WHEN line_no % 2 = 0 THEN 'LEFT' ELSE 'RIGHT' END AS side, * FROM hits), p AS (SELECT ident, arg_min({'c': sseqid, 'a': sstart, 'b': send, 'z': abs(qend - qstart)}, line_no) FILTER (side = 'LEFT') AS l, arg_min({'c': sseqid, 'a': sstart, 'b': send, 'z': abs(qend - qstart)}, line_no) FILTER (side = 'RIGHT') AS r FROM h GROUP BY ident)
SELECT ident, CASE WHEN l.z > 500 THEN l.c ELSE r.c END AS chrom, CASE WHEN l.z > 500 THEN l.b ELSE r.a END AS position FROM p WHERE l IS NOT NULL AND r IS NOT NULL AND (abs(l.b - r.a) <= 100 OR l.z > 500 OR r.z > 500)""")
def j14_region_pairing(spark, d):
    h = hits(spark, d).withColumn("ident", tx.field(F.col("qseqid"), 5)).withColumn("region", F.when(F.col("line_no") % 2 == 0, "LEFT").otherwise("RIGHT"))
    return assembly.pair_regions(h, "ident", "region")


@query(sql("evidence") + """, s AS (SELECT DISTINCT pos, left(seq, 6) || pos || right(seq, 5) || (pos + 1) || 'ACGT' || pos || right(seq, 5) AS seq, left(seq, 6) AS a, right(seq, 5) AS b FROM evidence WHERE length(seq) >= 6 AND regexp_full_match(seq, '[A-Za-z]+'))
SELECT seq, CAST(pos AS VARCHAR) AS id, b AS piece, length(a) AS "start" FROM s UNION ALL SELECT seq, CAST(pos + 1 AS VARCHAR), 'ACGT', length(a) + length(CAST(pos AS VARCHAR)) + length(b) FROM s
UNION ALL SELECT seq, CAST(pos AS VARCHAR), b, length(a) + length(CAST(pos AS VARCHAR)) + length(b) + length(CAST(pos + 1 AS VARCHAR)) + 4 FROM s""")
def f15_embedded_identifiers(spark, d):
    s = evidence(spark, d).filter("length(seq) >= 6 and seq rlike '^[A-Za-z]+$'").select(F.concat(F.left("seq", F.lit(6)), F.col("pos").cast("string"), F.right("seq", F.lit(5)), (F.col("pos") + 1).cast("string"), F.lit("ACGT"), F.col("pos").cast("string"), F.right("seq", F.lit(5))).alias("seq"), "pos").distinct()
    return s.select("seq", F.explode(tx.embedded_pieces(F.col("seq"))).alias("p")).select("seq", "p.id", "p.piece", "p.start")


@query(sql("reads") + """, e AS (SELECT *, pos + coalesce(list_sum(list_transform(list_filter(regexp_extract_all(cigar, '[0-9]+[MIDNSHP=X]'), lambda o: right(o, 1) IN ('M', 'D', '=')), lambda o: CAST(left(o, length(o) - 1) AS BIGINT))), 0) - 300 AS site FROM reads WHERE seq IS NOT NULL),
r AS (SELECT *, coalesce(TRY_CAST(regexp_extract(cigar, '([0-9]+)[SH]$', 1) AS BIGINT), 0) AS n, site + 300 AS stop FROM e), a AS (SELECT *, n > 1 AND abs(stop - site) <= 300 AS rt FROM r),
b AS (SELECT *, CASE WHEN rt THEN regexp_replace(cigar, '[0-9]+[SH]$', '') || (n - 1) || 'I1M' ELSE cigar END AS c FROM a), d AS (SELECT *, coalesce(TRY_CAST(regexp_extract(c, '^([0-9]+)[SH]', 1) AS BIGINT), 0) AS m FROM b), x AS (SELECT *, m > 1 AND abs(pos - site) <= 300 AS lf FROM d)
SELECT rname, qname, CASE WHEN lf THEN pos - 1 ELSE pos END AS pos, CASE WHEN lf THEN '1M' || (m - 1) || 'I' || regexp_replace(c, '^[0-9]+[SH]', '') ELSE c END AS cigar, CASE WHEN lf AND regexp_matches(c, '^[0-9]+H') THEN repeat('N', m::INT) ELSE '' END || seq || CASE WHEN rt AND cigar LIKE '%H' THEN repeat('N', n::INT) ELSE '' END AS seq FROM x""")
def f14_clips_to_insertions(spark, d):
    """Clips beside a site rewritten as insertions, for all alignments of reads (F14); the site lies 300 before the end."""
    r = reads(spark, d).filter("seq is not null").withColumn("site", F.col("pos") + cg.reference_length(F.col("cigar")) - 300)
    x = cg.clips_to_insertions(F.col("pos"), F.col("cigar"), F.col("seq"), F.lit(None).cast("string"), F.col("site"), F.lit(300))
    return r.withColumn("x", x).select("rname", "qname", "x.pos", "x.cigar", "x.seq")
