"""Queries over hits and read evidence, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions import cigar as cg
from strandloom.functions import text as tx
from strandloom.operators import assembly
from strandloom.operators import evidence as ev
from strandloom.operators import hits as ht
from strandloom.operators.eager import present
from strandloom.params import Params, with_options
from strandloom.plans import configured
from strandloom.plans.views import HIT_COLUMNS, aligned, evidence, hits, reads, sites, sql, stored_hits, stored_alignments
from strandloom.session import table

QUERIES, SQL = {}, {}


def query(text: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if text is not None:
            SQL[f.__name__] = text
        return f

    return add


@query("SELECT line_no, qseqid, sseqid, pident, aln_len, mismatch, gapopen, qstart, qend, sstart, send, evalue, bitscore, coalesce(isnan(bitscore), false) AS bitscore_nan FROM blast_hits")
def sc4_hit_scan(spark, d):
    """Every row of the hit table as stored (SC4); a flag tells NaN of bitscore from NULL where a reader can't."""
    return table(spark, d, "blast_hits").select(*HIT_COLUMNS, F.coalesce(F.isnan("bitscore"), F.lit(False)).alias("bitscore_nan"))


@query(sql("hits") + "SELECT line_no, split_part(qseqid, ':', 1) AS chrom, regexp_replace(split_part(qseqid, ':', 2), '[<>]', '', 'g') AS sv_type, TRY_CAST(split_part(qseqid, ':', 3) AS BIGINT) AS \"start\", TRY_CAST(split_part(qseqid, ':', 4) AS BIGINT) AS \"end\", split_part(qseqid, ':', 5) AS id, TRY_CAST(split_part(qseqid, ':', 6) AS BIGINT) AS support, split_part(split_part(qseqid, ':', 5), '.', 1) AS tool FROM hits")
def key_split(spark, d):
    """The parts of the packed variant key of every hit."""
    k = hits(spark, d).select("line_no", tx.locus(F.col("qseqid")).alias("k"))
    return k.select("line_no", "k.chrom", "k.sv_type", "k.start", "k.end", "k.id", "k.support", F.split_part("k.id", F.lit("."), F.lit(1)).alias("tool"))



_SIZED = """, sized AS (SELECT h.*, size_bp, CASE WHEN send < sstart THEN '-' ELSE '+' END AS strand, abs(qend - qstart) AS size_el, round(abs(qend - qstart) / size_bp * 100, 2) AS size_per FROM hits h JOIN te_sizes t ON sseqid = te_name)
"""


@query(sql("hits") + ", x AS (SELECT *, split_part(qseqid, ':', 1) AS chrom, TRY_CAST(split_part(qseqid, ':', 3) AS BIGINT) AS s, TRY_CAST(split_part(qseqid, ':', 4) AS BIGINT) AS e FROM hits)\nSELECT line_no, chrom, s AS \"start\", CASE WHEN s >= e THEN s + 1 ELSE e END AS \"end\", sseqid || '|' || split_part(qseqid, ':', 5) AS te_id, CASE WHEN send < sstart THEN '-' ELSE '+' END AS strand, s + qstart AS te_start, e - ((e - s) - qend) AS te_end FROM x")
def hits_to_bed(spark, d):
    """Hits as intervals, and the element's bounds inside the variant."""
    k = hits(spark, d).withColumn("k", tx.locus(F.col("qseqid")))
    s, e = F.col("k.start"), F.col("k.end")
    return k.select("line_no", "k.chrom", s.alias("start"), F.when(s >= e, s + 1).otherwise(e).alias("end"), F.concat("sseqid", F.lit("|"), "k.id").alias("te_id"), tx.strand_of(F.col("sstart"), F.col("send")).alias("strand"), (s + F.col("qstart")).alias("te_start"), (e - ((e - s) - F.col("qend"))).alias("te_end"))


@query(sql("hits") + "SELECT line_no, qseqid FROM hits WHERE split_part(qseqid, ':', 2) LIKE '%INS%' AND TRY_CAST(split_part(qseqid, ':', 6) AS BIGINT) >= 5 AND regexp_matches(split_part(qseqid, ':', 1), 'A1|B')")
def keep_floors(spark, d):
    """Chromosome, type and read-support floors."""
    k = hits(spark, d)
    key = F.col("qseqid")
    return k.filter(tx.field(key, 2).rlike("INS") & (tx.field(key, 6).try_cast("bigint") >= 5) & tx.field(key, 1).rlike("A1|B")).select("line_no", "qseqid")




@query(sql("hits") + _SIZED + "SELECT line_no, sseqid, strand, size_el, size_per FROM sized WHERE pident >= 94 AND size_per >= 50")
def size_and_identity_floors(spark, d):
    """Strand, element size, percentage of the dictionary size, and the floors."""
    j = hits(spark, d).join(table(spark, d, "te_sizes").withColumnRenamed("te_name", "sseqid"), "sseqid")
    out = j.select("line_no", "sseqid", tx.strand_of(F.col("sstart"), F.col("send")).alias("strand"), F.abs(F.col("qend") - F.col("qstart")).alias("size_el"), tx.size_percent(F.col("qstart"), F.col("qend"), F.col("size_bp")).alias("size_per"), "pident")
    return out.filter("pident >= 94 and size_per >= 50").drop("pident")


@query(sql("hits") + "SELECT line_no, sseqid FROM hits WHERE sseqid IN (SELECT te_name FROM te_sizes WHERE size_bp >= 3000)")
def j1_semi_join_dictionary(spark, d):
    return ht.known_elements(hits(spark, d), table(spark, d, "te_sizes").filter("size_bp >= 3000")).select("line_no", "sseqid")


@query(sql("hits") + "SELECT line_no, qseqid FROM (SELECT *, first_value(sseqid) OVER (PARTITION BY qseqid ORDER BY line_no) AS f FROM hits) WHERE sseqid = f")
def first_element_prefilter(spark, d):
    """Hits of the first element of each query in file order."""
    h = hits(spark, d)
    first = h.groupBy("qseqid").agg(F.min_by("sseqid", "line_no").alias("sseqid"))
    return h.join(first, ["qseqid", "sseqid"], "left_semi").select("line_no", "qseqid")


_LOCUS = "array_to_string(list_slice(string_split(qseqid, ':'), 1, {n}), ':')"


def _best(n: int) -> str:
    return f", best AS (SELECT * FROM (SELECT *, {_LOCUS.format(n=n)} AS locus, row_number() OVER (PARTITION BY {_LOCUS.format(n=n)} ORDER BY bitscore DESC, line_no) AS r FROM known) WHERE r = 1)\n"


_KNOWN = ", known AS (SELECT * FROM hits WHERE sseqid IN (SELECT te_name FROM te_sizes))"


@query(sql("hits") + _KNOWN + _best(7) + "SELECT locus, line_no, sseqid, bitscore FROM best")
def w1_best_hit(spark, d):
    h = ht.known_elements(stored_hits(spark, d).select("line_no", "qseqid", "sseqid", "bitscore"), table(spark, d, "te_sizes"))
    return ht.best_hits(h, tx.first_fields(F.col("qseqid"), 7)).select("locus", "line_no", "sseqid", "bitscore")


_RUN = """, n AS (SELECT *, row_number() OVER (ORDER BY line_no) - row_number() OVER (PARTITION BY qseqid, sseqid ORDER BY line_no) AS run FROM known)
"""


@query(sql("hits") + _KNOWN + _RUN + ", best AS (SELECT * FROM (SELECT *, " + _LOCUS.format(n=7) + " AS locus, row_number() OVER (PARTITION BY " + _LOCUS.format(n=7) + """ ORDER BY bitscore DESC, line_no) AS r FROM n) WHERE r = 1)
SELECT b.locus, n.line_no FROM best b JOIN n ON b.qseqid = n.qseqid AND b.sseqid = n.sseqid AND b.run = n.run AND n.line_no >= b.line_no""")
def w2_contiguous_run(spark, d):
    """The hits that continue the best hit of each locus in the file."""
    return ht.continuing(ht.known_elements(stored_hits(spark, d), table(spark, d, "te_sizes")), tx.first_fields(F.col("qseqid"), 7))


_FOLD = """, best AS (SELECT * FROM (SELECT *, {locus} AS locus, row_number() OVER (PARTITION BY {locus} ORDER BY bitscore DESC, line_no) AS r FROM n) WHERE r = 1),
lists AS (SELECT b.locus, any_value(b.qseqid) AS qseqid, any_value(b.sseqid) AS sseqid, any_value(b.pident) AS pident, any_value(b.line_no) AS line_no, list({{'s': n.sstart, 'e': n.send, 'q': n.qstart, 'r': n.qend, 'f': b.sstart < b.send}} ORDER BY n.line_no) AS h
  FROM best b JOIN n ON b.qseqid = n.qseqid AND b.sseqid = n.sseqid AND b.run = n.run AND n.line_no >= b.line_no GROUP BY b.locus),
folded AS (SELECT locus, qseqid, sseqid, pident, line_no, len(h) AS n_hits, list_reduce(h, lambda a, x: CASE
  WHEN x.q < a.q AND x.r < a.r AND (CASE WHEN a.f THEN x.s < a.s AND x.e < a.e ELSE x.s > a.s AND x.e > a.e END) THEN {{'s': x.s, 'e': a.e, 'q': x.q, 'r': a.r, 'f': a.f}}
  WHEN x.q > a.q AND x.r > a.r AND (CASE WHEN a.f THEN x.s > a.s AND x.e > a.e ELSE x.s < a.s AND x.e < a.e END) THEN {{'s': a.s, 'e': x.e, 'q': a.q, 'r': x.r, 'f': a.f}} ELSE a END) AS c FROM lists)
"""


@query(sql("hits") + _KNOWN + _RUN + _FOLD.format(locus=_LOCUS.format(n=7)) + "SELECT locus, line_no, c.s AS sstart, c.e AS send, c.q AS qstart, c.r AS qend, CAST(n_hits AS BIGINT) AS n_hits FROM folded")
def w3_combine_fragments(spark, d):
    h = ht.known_elements(stored_hits(spark, d), table(spark, d, "te_sizes"))
    return ht.combine(h, tx.first_fields(F.col("qseqid"), 7)).select("locus", "line_no", "sstart", "send", "qstart", "qend", "n_hits")


@query(sql("hits") + _KNOWN + _RUN + _FOLD.format(locus=_LOCUS.format(n=7)) + """SELECT locus, sseqid, line_no, CASE WHEN c.e < c.s THEN '-' ELSE '+' END AS strand, abs(c.r - c.q) AS size_el, round(abs(c.r - c.q) / size_bp * 100, 2) AS size_per FROM folded JOIN te_sizes ON sseqid = te_name
  WHERE split_part(qseqid, ':', 2) LIKE '%INS%' AND TRY_CAST(split_part(qseqid, ':', 6) AS BIGINT) >= 2 AND round(abs(c.r - c.q) / size_bp * 100, 2) >= 40 AND pident >= 85""")
def detect_elements(spark, d):
    """The whole detection: dictionary, best hit, fold, floors."""
    p = with_options(Params(), "--min-size-percent 40 --min-pident 85 --min-read-support 2 -k INS")
    f = configured.elements(stored_hits(spark, d), table(spark, d, "te_sizes"), p)
    return f.select("locus", "sseqid", "line_no", "strand", "size_el", "size_per")


@query("SELECT sseqid AS te, count(DISTINCT line_no) AS n FROM blast_hits WHERE sseqid NOT IN ('.', 'NONE') AND line_no IS NOT NULL GROUP BY sseqid")
def a1_count_per_family(spark, d):
    """Lines of each family, whatever else they miss (A1)."""
    h = table(spark, d, "blast_hits").filter(present("sseqid") & F.col("line_no").isNotNull()).select("line_no", F.col("sseqid").alias("te")).distinct()
    return h.groupBy("te").agg(F.count(F.lit(1)).alias("n"))


@query(sql("hits") + "SELECT regexp_extract(split_part(qseqid, ':', 2), '(SOFT|HARD|DEL|INS)', 1) AS sv_type, count(DISTINCT sseqid) AS families, count(*) AS total FROM hits GROUP BY 1")
def a2_families_per_type(spark, d):
    return hits(spark, d).groupBy(tx.variant_type(tx.field(F.col("qseqid"), 2)).alias("sv_type")).agg(F.count_distinct("sseqid").alias("families"), F.count(F.lit(1)).alias("total"))


@query(sql("hits") + "SELECT split_part(qseqid, ':', 5) AS ident, sseqid AS te, count(DISTINCT qseqid) AS n FROM hits GROUP BY 1, 2")
def a5_elements_per_variant(spark, d):
    return ht.elements_per_variant(hits(spark, d))


@query(sql("hits") + "SELECT qseqid, te FROM (SELECT DISTINCT qseqid, sseqid AS te, min(sseqid) OVER (PARTITION BY qseqid) AS a, max(sseqid) OVER (PARTITION BY qseqid) AS b FROM hits) WHERE a <> b")
def a6_multiple_elements(spark, d):
    """Queries with two or more families, with their families."""
    pairs = hits(spark, d).select("qseqid", F.col("sseqid").alias("te")).distinct()
    several = pairs.groupBy("qseqid").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    return pairs.join(several.select("qseqid"), "qseqid", "left_semi")


_OPS = """, ops AS (SELECT DISTINCT rname, pos, qname, cigar, unnest(regexp_extract_all(cigar, '[0-9]+[A-Z=]')) AS o, generate_subscripts(regexp_extract_all(cigar, '[0-9]+[A-Z=]'), 1) AS i FROM (SELECT DISTINCT rname, pos, qname, cigar FROM reads)),
op AS (SELECT rname, pos, qname, cigar, i - 1 AS i, CAST(regexp_extract(o, '[0-9]+') AS BIGINT) AS len, right(o, 1) AS op FROM ops),
walked AS (SELECT *, CAST(sum(CASE WHEN op IN ('M', 'D', '=') THEN len ELSE 0 END) OVER w AS BIGINT) AS ref, CAST(sum(CASE WHEN op IN ('M', 'I', 'S', '=') THEN len ELSE 0 END) OVER w AS BIGINT) AS "read", CAST(sum(CASE WHEN op IN ('M', 'I', 'S', 'H', '=') THEN len ELSE 0 END) OVER w AS BIGINT) AS whole FROM op WINDOW w AS (PARTITION BY rname, pos, qname, cigar ORDER BY i ROWS UNBOUNDED PRECEDING))
"""


@query(sql("reads") + _OPS + 'SELECT rname, pos, qname, i, op, len, ref, "read", whole FROM walked')
def f5_f6_cigar_walk(spark, d):
    r = reads(spark, d).select("rname", "pos", "qname", "cigar").distinct()
    return r.select("rname", "pos", "qname", F.explode(cg.walk(F.col("cigar"))).alias("x")).select("rname", "pos", "qname", "x.*")


@query(sql("reads") + _OPS + "SELECT rname, pos, qname, CASE op WHEN 'D' THEN pos + ref - len ELSE pos + ref END AS \"start\", CASE op WHEN 'D' THEN pos + ref ELSE pos + ref + 1 END AS stop, len AS size, CASE op WHEN 'D' THEN 'Deletion' ELSE 'Insertion' END AS sv_type FROM walked WHERE op IN ('I', 'D') AND len >= 50")
def w8_within_alignment(spark, d):
    r = reads(spark, d).select("rname", "pos", "qname", "cigar").distinct()
    return assembly.within_alignment(r, "rname", "pos", "cigar").select("rname", "pos", "qname", "start", "stop", "size", "sv_type")


@query(sql("reads") + "SELECT rname, pos, qname, flag, mapq FROM reads WHERE (flag & 2052) = 0 AND mapq >= 10")
def flag_filter(spark, d):
    return ev.usable(reads(spark, d), 10, 2052).select("rname", "pos", "qname", "flag", "mapq")




@query(sql("reads") + _OPS + """, m AS (SELECT rname, pos, qname, cigar, CAST(sum(CASE WHEN op IN ('M', 'I', '=', 'X') THEN len ELSE 0 END) AS BIGINT) AS bases FROM op GROUP BY ALL), r AS (SELECT reads.*, bases, pos % 50 AS nm, (flag & 2304) = 0 AS k, (flag & 2308) = 0 AS al FROM reads JOIN m USING (rname, pos, qname, cigar))
SELECT count(*) AS records, count(*) FILTER (k) AS sequences, count(*) FILTER (al) AS reads_mapped, count(*) FILTER (k AND NOT al) AS reads_unmapped, count(*) FILTER (al AND mapq = 0) AS reads_mq0, count(*) FILTER ((flag & 256) <> 0) AS non_primary, count(*) FILTER ((flag & 2048) <> 0) AS supplementary, count(*) FILTER (al AND (flag & 16) <> 0) AS reads_reverse,
  CAST(coalesce(sum(length(seq)) FILTER (k), 0) AS BIGINT) AS total_length, CAST(coalesce(sum(length(seq)) FILTER (al), 0) AS BIGINT) AS bases_mapped, CAST(coalesce(sum(bases) FILTER (al), 0) AS BIGINT) AS bases_mapped_cigar, CAST(coalesce(sum(nm) FILTER (al), 0) AS BIGINT) AS mismatches,
  round(coalesce(sum(nm) FILTER (al), 0) / nullif(sum(bases) FILTER (al), 0), 6) AS error_rate, round(coalesce(sum(length(seq)) FILTER (k), 0) / nullif(count(*) FILTER (k), 0), 4) AS average_length, max(length(seq)) FILTER (k) AS maximum_length FROM r""")
def a15_mapping_stats(spark, d):
    """What the alignments of the reads hold."""
    return ev.mapping_stats(reads(spark, d).withColumn("nm", F.col("pos") % 50))


@query(sql("reads", "sites") + _OPS + """, sp AS (SELECT rname, pos, qname, cigar, pos + greatest(CAST(sum(CASE WHEN op IN ('M', 'D', '=') THEN len ELSE 0 END) AS BIGINT), 1) AS stop FROM op GROUP BY rname, pos, qname, cigar)
SELECT rname, pos, stop, qname, cigar FROM sp WHERE EXISTS (SELECT 1 FROM sites s WHERE s.chrom = rname AND s."start" < stop AND s."end" > pos)""")
def region_restrict(spark, d):
    """Alignments that touch any site, by the reference their CIGAR covers (P10, SC9)."""
    r = reads(spark, d).select("rname", "pos", "qname", "cigar").distinct()
    return ev.in_regions(r, sites(spark, d).select("chrom", "start", "end")).select("rname", "pos", "stop", "qname", "cigar")


_SITES = """, st AS (SELECT chrom, "start", "end", sv_id AS ident, s.te, coalesce(size_te, 0) AS te_size, coalesce(sv_size, 0) AS sv_size, CASE WHEN sv_type = 'INS' THEN 'INS' ELSE 'DEL' END AS sv_type, split_part(ident, '.', 1) AS tool, psize_te FROM sites s),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ident ORDER BY chrom, "start", "end", te, te_size, sv_size, sv_type, tool, psize_te) AS r FROM st) WHERE r = 1),
rl AS (SELECT rname, pos, qname, flag, mapq, cigar, seq FROM reads WHERE (flag & 4) = 0 AND mapq >= 10),
span AS (SELECT rl.*, pos + greatest(b.bases, 1) AS stop FROM rl JOIN (SELECT rname, pos, qname, cigar, sum(CASE WHEN op IN ('M', 'D', '=') THEN len ELSE 0 END) AS bases FROM op GROUP BY ALL) b USING (rname, pos, qname, cigar)),
near AS (SELECT one.*, span.qname, span.pos, span.cigar, span.rname, span.seq FROM one JOIN span ON one.chrom = span.rname AND span.pos < one."end" + 50 AND span.stop > one."start" - 50),
"""
_CODES = _SITES + """ev AS (SELECT n.ident, n.qname, n.pos, n.cigar, n.seq, CASE WHEN n.sv_type = 'INS' THEN CASE WHEN n.pos + w.ref NOT BETWEEN n."start" - 50 AND n."end" + 50 THEN NULL WHEN w.op = 'I' AND w.len * 100 >= n.te_size * 70 THEN 'I' WHEN w.op = 'H' AND w.len > 200 AND length(n.seq) > 0 THEN 'H' WHEN w.op = 'S' AND w.len > 200 AND length(n.seq) > 0 THEN 'S' END
  WHEN w.op = 'D' AND w.len >= n.sv_size AND n.pos + w.ref - w.len BETWEEN n."start" - 50 AND n."end" + 50 THEN 'D' END AS code FROM near n JOIN walked w ON n.rname = w.rname AND n.pos = w.pos AND n.qname = w.qname AND n.cigar = w.cigar),
classes AS (SELECT DISTINCT ident, qname, pos, cigar, seq, code FROM ev WHERE code IS NOT NULL UNION SELECT ident, qname, pos, cigar, seq, 'E' FROM ev GROUP BY ident, qname, pos, cigar, seq HAVING count(code) = 0),
per_read AS (SELECT ident, qname AS "read", min(code) AS code FROM classes GROUP BY ALL)
"""


def _one_site(spark, d):
    s = sites(spark, d).select("chrom", "start", "end", F.col("sv_id").alias("ident"), "te", F.coalesce("size_te", F.lit(0)).alias("te_size"), F.coalesce("sv_size", F.lit(0)).alias("sv_size"), F.when(F.col("sv_type") == "INS", "INS").otherwise("DEL").alias("sv_type"), F.split_part("ident", F.lit("."), F.lit(1)).alias("tool"), "psize_te")
    order = ["chrom", "start", "end", "te", "te_size", "sv_size", "sv_type", "tool", "psize_te"]
    return s.groupBy("ident").agg(F.min(F.struct(*order)).alias("b")).select("ident", "b.*")


def _classes(spark, d):
    return configured.classes(_one_site(spark, d), reads(spark, d), Params())


@query(sql("reads", "sites") + _OPS + _CODES + 'SELECT ident, "read", code FROM per_read')
def j11_read_classes(spark, d):
    """The class of every read at every site."""
    return _classes(spark, d).groupBy("ident", "read").agg(F.min("code").alias("code"))


_FREQ = """, s1 AS (SELECT ident, count(*) AS reads, count(*) FILTER (code <> 'E') AS with_any, count(*) FILTER (code IN ('H', 'S')) AS clipped, count(*) FILTER (code = 'I') AS inserted FROM per_read GROUP BY ident),
s2 AS (SELECT s1.*, sv_type, tool, CAST(1 + te_size % 4 AS BIGINT) AS rs FROM s1 JOIN one USING (ident)),
s3 AS (SELECT *, greatest(with_any, rs) AS i_all0, greatest(reads, greatest(with_any, rs)) AS total, CASE WHEN (CASE WHEN tool = 'snif' THEN greatest(inserted, rs) ELSE inserted END) = 0 THEN rs WHEN tool = 'snif' THEN greatest(inserted, rs) ELSE inserted END AS i_only FROM s2),
s4 AS (SELECT *, CASE WHEN total - clipped < i_only OR total - clipped = 0 THEN total ELSE total - clipped END AS tn FROM s3),
freqs AS (SELECT ident, sv_type, i_only, clipped AS i_clipped, tn AS total_no_clipped, CASE WHEN sv_type = 'DEL' THEN total - i_all0 ELSE i_all0 END AS i_all, total, CASE WHEN sv_type = 'DEL' THEN round((total - i_all0) * 100 / total, 4) ELSE round(i_only * 100 / tn, 4) END AS freq_no_clip, CASE WHEN sv_type = 'DEL' THEN round((total - i_all0) * 100 / total, 4) ELSE round(i_all0 * 100 / total, 4) END AS freq_all FROM s4)
"""


def _frequencies(spark, d):
    s = _one_site(spark, d).withColumn("support", (1 + F.col("te_size") % 4).cast("bigint"))
    return ev.frequencies(_classes(spark, d), s)


@query(sql("reads", "sites") + _OPS + _CODES + _FREQ + "SELECT * FROM freqs")
def a3_frequency(spark, d):
    return _frequencies(spark, d)


@query(sql("reads", "sites", "hits") + _OPS + _CODES + _FREQ + """, el AS (SELECT sv_id AS ident, max(1 + psize_te % 7)::BIGINT AS n FROM sites WHERE psize_te IS NOT NULL GROUP BY sv_id)
SELECT ident, n, CASE WHEN round(n * 100 / (total_no_clipped + m), 4) <= 100 THEN round(n * 100 / (total_no_clipped + m), 4) ELSE freq_no_clip END AS freq_no_clip, CASE WHEN round((n + i_clipped) * 100 / (total + m), 4) <= 100 THEN round((n + i_clipped) * 100 / (total + m), 4) ELSE freq_all END AS freq_all
FROM (SELECT f.*, n, CASE WHEN n = total_no_clipped + 1 THEN 1 ELSE 0 END AS m FROM freqs f JOIN el USING (ident) WHERE n > 0)""")
def a4_precise_frequency(spark, d):
    el = sites(spark, d).filter("psize_te is not null").groupBy(F.col("sv_id").alias("ident")).agg(F.expr("cast(round(max(1 + psize_te % 7)) as bigint)").alias("n"))
    return ev.precise(_frequencies(spark, d), el)


@query(sql("aligned", "sites") + """, b AS (SELECT rid AS chrom, least(rstart, rend) AS s, greatest(rstart, rend) AS e FROM aligned), st AS (SELECT DISTINCT chrom, "start", "end", sv_id FROM sites),
dl AS (SELECT st.*, (SELECT count(*) FROM b WHERE b.chrom = st.chrom AND b.s <= st."start" - 29 AND b.e > st."start" - 29) AS l, (SELECT count(*) FROM b WHERE b.chrom = st.chrom AND b.s <= st."end" + 30 AND b.e > st."end" + 30) AS r FROM st)
SELECT chrom, "start", sv_id, (l + r) // 2 AS total_depth, CASE WHEN (l + r) // 2 > 0 THEN (l + r) // 2 - 1 ELSE 0 END AS read_support, CASE WHEN (l + r) // 2 > 0 THEN round(((1000000 * ((l + r) // 2 - 1)) // ((l + r) // 2)) * 100 * 1e-6, 4) ELSE 0.0 END AS read_support_percent FROM dl""")
def a9_depth_frequency(spark, d):
    from strandloom.operators.intervals import depth_at

    b = aligned(spark, d).select(F.col("rid").alias("chrom"), F.least("rstart", "rend").alias("s"), F.greatest("rstart", "rend").alias("e"))
    st = sites(spark, d).select("chrom", "start", "end", "sv_id").distinct().withColumn("pl", F.col("start") - 29).withColumn("pr", F.col("end") + 30)
    both = st.select("chrom", F.col("pl").alias("at")).unionByName(st.select("chrom", F.col("pr").alias("at")))
    depth = depth_at(both, b, ["chrom"], "at", ("s", "e"))
    named = lambda at, n: depth.select("chrom", F.col("at").alias(at), F.col("depth").alias(n))
    j = st.join(named("pl", "l"), ["chrom", "pl"]).join(named("pr", "r"), ["chrom", "pr"]).withColumn("without", F.lit(1))
    return ev.depth_frequency(j, "l", "r", "without").select("chrom", "start", "sv_id", "total_depth", "read_support", "read_support_percent")


@query(sql("reads", "sites") + _OPS + """, st AS (SELECT DISTINCT chrom, "start", "start" + coalesce(sv_size, 0) AS "end", sv_id AS ident FROM sites), one AS (SELECT ident, min({'c': chrom, 's': "start", 'e': "end"}) AS b FROM st GROUP BY ident),
sp AS (SELECT rname, pos, qname, cigar, pos + greatest(sum(CASE WHEN op IN ('M', 'D', '=') THEN len ELSE 0 END), 1) AS stop FROM op GROUP BY rname, pos, qname, cigar),
f AS (SELECT DISTINCT one.ident, w.qname FROM one JOIN sp ON one.b.c = sp.rname AND sp.pos < one.b.e + 30 AND sp.stop > one.b.s - 30 JOIN walked w ON w.rname = sp.rname AND w.pos = sp.pos AND w.qname = sp.qname AND w.cigar = sp.cigar
  WHERE w.op = 'D' AND abs(w.len - (one.b.e - one.b.s)) <= 30 AND (abs(w.pos + w.ref - w.len - one.b.s) < 30 OR abs(w.pos + w.ref - one.b.e) < 30))
SELECT one.ident, count(qname) AS n_reads FROM one LEFT JOIN f USING (ident) GROUP BY one.ident""")
def j12_deletion_reads(spark, d):
    s = sites(spark, d).select("chrom", "start", (F.col("start") + F.coalesce("sv_size", F.lit(0))).alias("end"), F.col("sv_id").alias("ident")).distinct()
    one = s.groupBy("ident").agg(F.min(F.struct("chrom", "start", "end")).alias("b")).select("ident", "b.*")
    return ev.deletion_support(one, reads(spark, d).select("rname", "pos", "qname", "cigar").distinct())


@query(sql("evidence") + """, c AS (SELECT DISTINCT chrom, pos, pos + 1 AS pos1, CASE WHEN op_len % 2 = 0 THEN 'L' ELSE 'R' END AS side, read_name, seq FROM evidence WHERE seq IS NOT NULL),
reach AS (SELECT *, max(pos1) OVER (PARTITION BY chrom ORDER BY pos, pos1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM c), cl AS (SELECT *, sum(CASE WHEN reach IS NULL OR pos > reach + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY pos, pos1) AS cl FROM reach)
SELECT chrom, CAST(cl AS BIGINT) AS cluster, min(pos) AS "start", max(pos1) AS "end", arg_min(seq, {'l': -length(seq), 's': seq}) FILTER (side = 'L') AS best_l, arg_min(seq, {'l': -length(seq), 's': seq}) FILTER (side = 'R') AS best_r,
  count(DISTINCT read_name) FILTER (side = 'L') AS reads_l, count(DISTINCT read_name) FILTER (side = 'R') AS reads_r, count(DISTINCT read_name) AS n_reads FROM cl GROUP BY chrom, cl""")
def a20_soft_clip_groups(spark, d):
    c = evidence(spark, d).select("chrom", "pos", F.when(F.col("op_len") % 2 == 0, "L").otherwise("R").alias("side"), F.col("read_name").alias("read"), "seq").distinct()
    return ev.clip_groups(c)


_HARD = """, x AS (SELECT DISTINCT rname, pos + ref AS at, qname, len, CASE WHEN i = 0 THEN 'L' ELSE 'R' END AS side FROM walked WHERE op = 'H' AND len > 100)
"""


@query(sql("reads") + _OPS + _HARD + ", whole AS (SELECT read_name AS qname, repeat(min(seq), 20) AS seq FROM evidence WHERE seq <> '' GROUP BY read_name)\nSELECT rname, x.at, qname, len, side, CASE side WHEN 'L' THEN left(seq, len) ELSE right(seq, len) END AS clipped FROM x JOIN whole USING (qname)")
def a21_hard_clip_sequences(spark, d):
    """Hard clips with the bases that were cut off, from the whole reads (A21, SC18)."""
    clips = a21_hard_clips(spark, d).withColumnRenamed("qname", "read")
    whole = evidence(spark, d).filter("seq <> ''").groupBy(F.col("read_name").alias("name")).agg(F.repeat(F.min("seq"), F.lit(20)).alias("seq"))
    return ev.clipped_sequences(clips, whole).withColumnRenamed("read", "qname")


@query(sql("reads") + _OPS + """, x AS (SELECT *, max(i) OVER (PARTITION BY rname, pos, qname, cigar) AS last FROM walked)
SELECT DISTINCT rname, pos + ref AS at, qname, len, CASE WHEN i = 0 THEN 'L' ELSE 'R' END AS side FROM x WHERE op = 'H' AND len > 100""")
def a21_hard_clips(spark, d):
    """Hard clips longer than 100 with their side, each place once."""
    r = reads(spark, d).select("rname", "pos", "qname", "cigar").distinct().withColumn("x", F.explode(cg.walk(F.col("cigar"))))
    return r.filter("x.op = 'H' and x.len > 100").select("rname", (F.col("pos") + F.col("x.ref")).alias("at"), "qname", "x.len", F.when(F.col("x.i") == 0, "L").otherwise("R").alias("side")).distinct()


@query(sql("aligned") + """, a AS (SELECT DISTINCT rid, qid, rstart, rend, qstart, qend, least(qstart, qend) AS lo, qend > qstart AS f FROM aligned),
o AS (SELECT *, lag({'rid': rid, 'rs': rstart, 're': rend, 'qs': qstart, 'qe': qend, 'f': f}) OVER (PARTITION BY qid ORDER BY lo, rstart, rend, rid, qstart, qend) AS i FROM a),
x AS (SELECT *, CASE WHEN i.f AND f THEN rstart - i.re WHEN NOT i.f AND NOT f THEN i.rs - rend WHEN i.f THEN rstart - i.re ELSE i.rs - rend END AS ref_dist, CASE WHEN i.f AND f THEN qstart - i.qe WHEN NOT i.f AND NOT f THEN qend - i.qs WHEN i.f THEN qend - i.qe ELSE i.qe - qend END AS query_dist,
  CASE WHEN i.f THEN i.re ELSE i.rs END AS l, CASE WHEN f THEN rstart ELSE rend END AS r FROM o WHERE i IS NOT NULL),
y AS (SELECT *, abs(ref_dist - query_dist) AS size, CASE WHEN i.rid <> rid THEN NULL WHEN i.f <> f THEN NULL WHEN query_dist > ref_dist THEN CASE WHEN ref_dist > -50 AND ref_dist < 50 AND query_dist > -50 THEN 'Insertion' WHEN ref_dist < 0 OR query_dist < 0 THEN 'Tandem_expansion' ELSE 'Repeat_expansion' END
  WHEN query_dist < ref_dist THEN CASE WHEN ref_dist > -50 AND query_dist > -50 AND query_dist < 50 THEN 'Deletion' WHEN ref_dist < 0 OR query_dist < 0 THEN 'Tandem_contraction' ELSE 'Repeat_contraction' END END AS sv_type FROM x)
SELECT rid, least(l, r) AS "start", CASE WHEN l = r THEN greatest(l, r) + 1 ELSE greatest(l, r) END AS stop, size, sv_type, ref_dist, query_dist, qid FROM y WHERE sv_type IS NOT NULL AND size BETWEEN 50 AND 20000""")
def w7_between_alignments(spark, d):
    a = stored_alignments(spark, d).select("rid", "qid", "rstart", "rend", "qstart", "qend").distinct()
    return assembly.between_alignments(a)


@query(sql("aligned") + """, lens AS (SELECT rid, greatest(rstart, rend) - least(rstart, rend) AS l FROM aligned), r AS (SELECT rid, l, sum(l) OVER (PARTITION BY rid ORDER BY l DESC) AS upto, sum(l) OVER (PARTITION BY rid) AS total FROM lens)
SELECT rid, count(*) AS "count", CAST(max(total) AS BIGINT) AS total, max(total) / count(*) AS mean, min(l) AS "min", max(l) AS "max", max(CASE WHEN upto * 2 >= total THEN l END) AS n50 FROM r GROUP BY rid""")
def a13_assembly_stats(spark, d):
    lens = aligned(spark, d).select("rid", (F.greatest("rstart", "rend") - F.least("rstart", "rend")).alias("l"))
    return assembly.n50(lens, "l", ["rid"])


@query(sql("aligned") + """, a AS (SELECT qid, rid, least(qstart, qend) AS s, greatest(qstart, qend) AS e FROM aligned), reach AS (SELECT *, max(e) OVER (PARTITION BY qid, rid ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM a),
cov AS (SELECT qid, rid, CAST(sum(greatest(e - greatest(s, coalesce(reach, s)), 0)) AS BIGINT) AS covered FROM reach GROUP BY qid, rid) SELECT qid, rid, covered FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY covered DESC, rid) AS r FROM cov) WHERE r = 1""")
def j16_equivalent_reference(spark, d):
    return assembly.equivalent_reference(stored_alignments(spark, d))


@query(sql("aligned", "sites") + """, g0 AS (SELECT DISTINCT rid AS chrom, least(rstart, rend) AS s, greatest(rstart, rend) AS e FROM aligned), g1 AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM g0),
g2 AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY s, e) AS n FROM g1), g AS (SELECT chrom, min(s) AS s, max(e) AS e FROM g2 GROUP BY chrom, n), v AS (SELECT DISTINCT chrom, sv_id, "start", "end" + 500 AS "end" FROM sites),
x AS (SELECT v.chrom, v.sv_id, v."start", v."end", coalesce(sum(CASE WHEN g.s IS NOT NULL THEN greatest(least(v."end", g.e) - greatest(v."start", g.s), 0) END) / max(v."end" - v."start"), 0) AS share FROM v LEFT JOIN g ON v.chrom = g.chrom AND g.s < v."end" AND g.e > v."start" GROUP BY ALL) SELECT chrom, sv_id, "start", round(share, 6) AS share FROM x""")
def j10_gap_share(spark, d):
    """The share of each site's surroundings that intervals cover, overlaps once."""
    v = sites(spark, d).select("chrom", "sv_id", "start", (F.col("end") + 500).alias("end")).distinct().withColumn("row", F.concat_ws(":", "chrom", "sv_id", "start", "end"))
    g = stored_alignments(spark, d).select(F.col("rid").alias("chrom"), F.least("rstart", "rend").alias("s"), F.greatest("rstart", "rend").alias("e")).distinct()
    return assembly.gap_share(v, g, ["chrom"], ("start", "end"), ("s", "e"), "share", "row").select("chrom", "sv_id", "start", F.round("share", 6).alias("share"))


@query(sql("sites") + """, f AS (SELECT sv_id AS ident, chrom, "start", "end", CASE WHEN strand = '-' THEN 'R' ELSE 'L' END AS side, coalesce(psize_te, 0) AS cov FROM sites), g AS (SELECT DISTINCT te AS ident, chrom, min("start") AS s, max("end") AS e, count(*) AS v FROM sites GROUP BY te, chrom),
p AS (SELECT chrom || ':' || (s % 50) AS ident, chrom, s, e, CASE WHEN v % 2 = 0 THEN 'L' ELSE 'R' END AS side, v FROM g), q AS (SELECT ident, count(*) AS n, max({'c': chrom, 's': s, 'e': e, 'v': v}) FILTER (side = 'L') AS l, max({'c': chrom, 's': s, 'e': e, 'v': v}) FILTER (side = 'R') AS r FROM p GROUP BY ident HAVING count(*) = 2),
z AS (SELECT *, r.s - l.e AS gap FROM q WHERE l IS NOT NULL AND r IS NOT NULL)
SELECT ident, CASE WHEN l.c = r.c OR l.v >= r.v THEN l.c ELSE r.c END AS chrom, CASE WHEN l.c = r.c AND gap BETWEEN 0 AND 20000 THEN l.e WHEN l.c = r.c AND gap BETWEEN -20000 AND -1 THEN r.s WHEN l.c <> r.c AND l.v >= r.v THEN l.e WHEN l.c <> r.c THEN r.s END AS "start",
  CASE WHEN l.c = r.c AND gap BETWEEN 0 AND 20000 THEN r.s WHEN l.c = r.c AND gap BETWEEN -20000 AND -1 THEN l.e WHEN l.c <> r.c AND l.v >= r.v THEN l.e + 1 WHEN l.c <> r.c THEN r.s + 1 END AS "end", CASE WHEN l.c = r.c AND gap BETWEEN -20000 AND 20000 THEN 'OK' ELSE 'BAD' END AS state FROM z""")
def j18_flank_pairing(spark, d):
    g = sites(spark, d).groupBy("te", "chrom").agg(F.min("start").alias("s"), F.max("end").alias("e"), F.count(F.lit(1)).alias("v"))
    p = g.select(F.concat("chrom", F.lit(":"), F.col("s") % 50).alias("ident"), "chrom", "s", "e", F.when(F.col("v") % 2 == 0, "L").otherwise("R").alias("side"), "v")
    return assembly.pair_flanks(p, "ident", "chrom", "s", "e", "side", "v")
