"""Queries of sequences, formats, genomes, generations, reports and the viewer, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions import sequence as sq
from strandloom.functions import text as tx
from strandloom.operators import eager, generations, genome, report, tsd, viewer
from strandloom.operators import intervals as iv
from strandloom.params import params
from strandloom.plans import configured
from strandloom.plans.views import evidence, evidence_of, evidence_of_sql, hits, sites, sql, stored_hits
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


# -- sequences ---------------------------------------------------------------------------------------------------------
_RC = "reverse(translate(regexp_replace(upper({x}), '[^ACGT]', 'N', 'g'), 'ACGT', 'TGCA'))"


_ALL_SEQS = "WITH " + evidence_of_sql("seqs", "seq") + "\n"


@query(_ALL_SEQS + f"SELECT seq, {_RC.format(x='seq')} AS rc FROM seqs")
def f1_reverse_complement(spark, d):
    return evidence_of(spark, d, "seq").select("seq", sq.reverse_complement(F.col("seq")).alias("rc"))


@query(_ALL_SEQS + "SELECT seq, reverse(translate(upper(seq), 'ACGTRYKMBVDHSWN', 'TGCAYRMKVBHDSWN')) AS rc FROM seqs")
def f1_ambiguous_complement(spark, d):
    """The form that keeps ambiguity codes (F1)."""
    return evidence_of(spark, d, "seq").select("seq", sq.reverse_complement_ambiguous(F.col("seq")).alias("rc"))


@query(_ALL_SEQS + ", o AS (SELECT seq, i FROM seqs, unnest(range(0, greatest(length(seq) - 1, 0))) AS u(i) WHERE substr(seq, i + 1, 2) = 'GA')\nSELECT seq, count(*) AS n, min(i) AS first, max(i) AS last FROM o GROUP BY seq")
def f2_exact_search(spark, d):
    o = evidence_of(spark, d, "seq").withColumn("o", sq.places("seq", F.lit("GA"))).filter("size(o) > 0")
    return o.select("seq", F.size("o").cast("bigint").alias("n"), F.array_min("o").cast("bigint").alias("first"), F.array_max("o").cast("bigint").alias("last"))


# Both halves of each whole sequence as flanks, and as the two sides of its empty site.
_HALVES = """, f AS (SELECT chrom, pos, read_name, left(seq, (length(seq) + 1) // 2) AS fk_l, substr(seq, (length(seq) + 1) // 2 + 1) AS fk_r, fk_l AS gl, fk_r AS gr FROM e0),
c AS (SELECT *, length(fk_r) > length(fk_l) AS swap, CASE WHEN length(fk_r) > length(fk_l) THEN fk_l ELSE fk_r END AS m, CASE WHEN length(fk_r) > length(fk_l) THEN fk_r ELSE fk_l END AS s FROM f),
p AS (SELECT *, list_filter(flatten(list_transform(range(length(m), 3, -1), lambda k: list_transform(range(1, length(m) - k + 2), lambda p: substr(m, p, k)))), lambda w: instr(s, w) > 0)[1] AS tsd FROM c),
q AS (SELECT *, list_filter(range(0, length(s) - length(tsd) + 1), lambda i: substr(s, i + 1, length(tsd)) = tsd) AS places, instr(m, tsd) - 1 AS i FROM p WHERE tsd IS NOT NULL),
t AS (SELECT *, CASE WHEN swap THEN length(fk_l) - length(tsd) - i ELSE length(fk_l) - length(tsd) - list_max(places) END AS shift_l, CASE WHEN swap THEN list_min(places) ELSE i END AS shift_r FROM q)
"""
_PLACED = evidence_of_sql("e0", "chrom", "pos", "read_name", "seq")


def _tsd(spark, d):
    half = F.expr("(length(seq) + 1) div 2").cast("int")
    f = evidence_of(spark, d, "chrom", "pos", "read_name", "seq").select("chrom", "pos", "read_name", F.left("seq", half).alias("fk_l"), F.substring("seq", half + 1, F.length("seq")).alias("fk_r"))
    return tsd.duplications(f)


@query("WITH " + _PLACED + _HALVES + "SELECT chrom, pos, read_name, tsd, shift_l, shift_r, pos - shift_l AS new_pos FROM t")
def f3_duplications_genome(spark, d):
    """Duplications between the halves of whole sequences."""
    return tsd.place_from_genome(_tsd(spark, d), "pos").select("chrom", "pos", "read_name", "tsd", "shift_l", "shift_r", "new_pos")


@query("WITH " + _PLACED + _HALVES + """, e AS (SELECT *, list_filter(range(0, greatest(length(gl || gr) - length(tsd) + 1, 0)), lambda z: substr(gl || gr, z + 1, length(tsd)) = tsd) AS o FROM t),
n AS (SELECT *, list_min(list_transform(o, lambda z: {'d': abs(z - length(gl) + length(tsd)), 'p': z})).p AS hit FROM e)
SELECT chrom, pos, read_name, tsd, CASE WHEN hit IS NOT NULL THEN pos + hit - length(gl) + length(tsd) ELSE pos END AS new_pos FROM n""")
def f4_duplications_reads(spark, d):
    """The same placed by the whole empty site."""
    return tsd.place_from_reads(_tsd(spark, d), "fk_l", "fk_r", "pos").select("chrom", "pos", "read_name", "tsd", "new_pos")


@query(sql("evidence") + "SELECT DISTINCT seq, count_read % 40 AS p, op_len % 10 AS w, substr(seq, greatest(count_read % 40 - 10, 0) + 1, greatest(least(count_read % 40 + op_len % 10, length(seq)) - greatest(count_read % 40 - 10, 0), 0)) AS piece FROM evidence WHERE seq IS NOT NULL")
def f7_flank_slice(spark, d):
    p, w = F.col("count_read") % 40, F.col("op_len") % 10
    return evidence(spark, d).filter("seq is not null").select("seq", p.alias("p"), w.alias("w"), sq.slice_of(F.col("seq"), p - 10, p + w).alias("piece")).distinct()


@query(sql("evidence") + "SELECT DISTINCT seq, side, CASE WHEN side = 'L' THEN right(seq, 15) ELSE left(seq, 15) END AS kept FROM (SELECT seq, CASE WHEN op_len % 2 = 0 THEN 'L' ELSE 'R' END AS side FROM evidence WHERE seq IS NOT NULL)")
def f12_clip_trim(spark, d):
    s = evidence(spark, d).filter("seq is not null").select("seq", F.when(F.col("op_len") % 2 == 0, "L").otherwise("R").alias("side"))
    return s.select("seq", "side", sq.trimmed_clip(F.col("seq"), F.col("side"), F.lit(15)).alias("kept")).distinct()


@query(_ALL_SEQS + "SELECT seq, length(seq) AS n FROM seqs WHERE length(seq) > 30 AND regexp_full_match(upper(seq), '[ACGTURYKMSWBDHVN.-]+')")
def valid_long_sequences(spark, d):
    """Sequences over 30 letters of valid codes."""
    return evidence_of(spark, d, "seq").filter(sq.valid_sequence(F.col("seq")) & (F.length("seq") > 30)).select("seq", F.length("seq").cast("bigint").alias("n"))


@query(sql("evidence") + ", g AS (SELECT chrom AS name, min(seq) AS seq FROM evidence WHERE length(seq) > 20 GROUP BY chrom), v AS (SELECT DISTINCT chrom, read_name, pos % 20 AS s, pos % 20 + op_len % 30 AS e, CASE WHEN op_len % 2 = 0 THEN '-' ELSE '+' END AS strand FROM evidence), x AS (SELECT chrom, read_name, s, e, strand, substr(seq, s + 1, greatest(least(e, length(seq)) - s, 0)) AS p FROM v JOIN g ON chrom = name)\nSELECT chrom, read_name, s, e, strand, CASE WHEN strand = '-' THEN " + _RC.format(x="p") + " ELSE p END AS piece FROM x")
def j13_sequence_slices(spark, d):
    e = evidence(spark, d)
    g = e.filter(F.length("seq") > 20).groupBy(F.col("chrom").alias("name")).agg(F.min("seq").alias("seq"))
    v = e.select("chrom", "read_name", (F.col("pos") % 20).alias("s"), (F.col("pos") % 20 + F.col("op_len") % 30).alias("e"), F.when(F.col("op_len") % 2 == 0, "-").otherwise("+").alias("strand")).distinct()
    return genome.slices(v, g, "chrom", "s", "e", "strand", "piece").select("chrom", "read_name", "s", "e", "strand", "piece")


@query("WITH " + evidence_of_sql("e", "chrom", "pos", "read_name", "seq") + ", " + evidence_of_sql("b", "chrom", "seq") + """, g AS (SELECT chrom AS name, min(seq) AS seq FROM b WHERE length(seq) > 20 GROUP BY chrom),
i AS (SELECT g.name, pos // 10000 AS piece, pos AS s, least(pos, length(g.seq)) AS spot, least((pos // 10000 + 1) * 10000, length(g.seq)) AS hi, least(pos // 10000 * 10000, length(g.seq)) AS lo, read_name, e.seq AS ins, g.seq AS seq FROM e JOIN g ON chrom = name),
o AS (SELECT *, lead(spot) OVER w AS nxt, row_number() OVER w AS r FROM i WINDOW w AS (PARTITION BY name, piece ORDER BY s, read_name, ins)),
p AS (SELECT name, piece, string_agg(CASE WHEN r = 1 THEN substr(seq, lo + 1, spot - lo) ELSE '' END || ins || substr(seq, spot + 1, coalesce(nxt, hi) - spot), '' ORDER BY r) AS seq, count(*) AS n FROM o GROUP BY name, piece),
c AS (SELECT name, k AS piece, substr(seq, k * 10000 + 1, 10000) AS seq FROM g, unnest(range(0, (length(seq) - 1) // 10000 + 1)) AS u(k))
SELECT coalesce(p.name, c.name) AS name, coalesce(p.piece, c.piece) AS piece, coalesce(p.seq, c.seq) AS seq, coalesce(n, 0) AS n_inserts FROM c FULL JOIN p ON c.name = p.name AND c.piece = p.piece""")
def k3_genome_splice(spark, d):
    """All inserts, whole and at their positions, in pieces of 10,000 bases (K3)."""
    g = evidence_of(spark, d, "chrom", "seq").filter(F.length("seq") > 20).groupBy(F.col("chrom").alias("name")).agg(F.min("seq").alias("seq"))
    i = evidence_of(spark, d, "chrom", "pos", "read_name", "seq").select(F.col("chrom").alias("name"), F.col("pos").alias("start"), "read_name", F.col("seq").alias("insert"))
    return genome.splice_pieces(g, i, "read_name", 10_000)


_CANONICAL = evidence_of_sql("b", "chrom", "seq") + """, g AS (SELECT chrom AS name, min(seq) AS seq FROM b WHERE length(seq) > 20 GROUP BY chrom), el AS (SELECT te_name AS te, left(repeat('ACGTRN', 20), (10 + size_bp % 90)::INT) AS seq FROM te_sizes),
x AS (SELECT DISTINCT chrom, "start", te, ident, strand FROM sites), e AS (SELECT chrom, "start" AS pos, ident, ident || CASE WHEN strand = '+' THEN seq ELSE reverse(translate(seq, 'ACGTRYKMBVDHSWN', 'TGCAYRMKVBHDSWN')) END AS seq FROM x JOIN el USING (te) WHERE NOT regexp_matches(ident, 'SOFT|HARD'))
"""


def _canonical(spark, d):
    g = evidence_of(spark, d, "chrom", "seq").filter(F.length("seq") > 20).groupBy(F.col("chrom").alias("name")).agg(F.min("seq").alias("seq"))
    elements = table(spark, d, "te_sizes").select(F.col("te_name").alias("name"), F.expr("left(repeat('ACGTRN', 20), cast(10 + size_bp % 90 as int))").alias("seq"))
    return g, genome.canonical_inserts(sites(spark, d).select("chrom", "start", "te", "ident", "strand").distinct(), elements)


@query(sql("sites") + ", " + _CANONICAL + """, i AS (SELECT g.name, pos // 10000 AS piece, pos AS s, least(pos, length(g.seq)) AS spot, least((pos // 10000 + 1) * 10000, length(g.seq)) AS hi, least(pos // 10000 * 10000, length(g.seq)) AS lo, ident, e.seq AS ins, g.seq AS seq FROM e JOIN g ON chrom = name),
o AS (SELECT *, lead(spot) OVER w AS nxt, row_number() OVER w AS r FROM i WINDOW w AS (PARTITION BY name, piece ORDER BY s, ident, ins)),
p AS (SELECT name, piece, string_agg(CASE WHEN r = 1 THEN substr(seq, lo + 1, spot - lo) ELSE '' END || ins || substr(seq, spot + 1, coalesce(nxt, hi) - spot), '' ORDER BY r) AS seq, count(*) AS n FROM o GROUP BY name, piece),
c AS (SELECT name, k AS piece, substr(seq, k * 10000 + 1, 10000) AS seq FROM g, unnest(range(0, (length(seq) - 1) // 10000 + 1)) AS u(k))
SELECT coalesce(p.name, c.name) AS name, coalesce(p.piece, c.piece) AS piece, coalesce(p.seq, c.seq) AS seq, coalesce(n, 0) AS n_inserts FROM c FULL JOIN p ON c.name = p.name AND c.piece = p.piece""")
def k3_canonical_splice(spark, d):
    """The canonical element of every site, its identifier before it, in pieces of 10,000 bases (K3)."""
    g, i = _canonical(spark, d)
    return genome.splice_pieces(g, i, "ident", 10_000)


@query(sql("sites") + ", " + _CANONICAL + "SELECT name, length(g.seq) AS before, CAST(length(g.seq) + coalesce(sum(length(e.seq)), 0) AS BIGINT) AS after, count(e.seq) AS n_inserts FROM g LEFT JOIN e ON chrom = name GROUP BY name, g.seq")
def a12_sizes_after(spark, d):
    """Size of every sequence before and after the canonical elements are put in."""
    return genome.sizes_after(*_canonical(spark, d))


# -- formats -----------------------------------------------------------------------------------------------------------
_VCF = """, v AS (SELECT DISTINCT chrom, "start" + 1 AS pos, ident AS id, CASE WHEN sv_type = 'INS' THEN 'N' ELSE repeat('ACGN', CAST(1 + coalesce(sv_size, 0) % 300 AS INT)) END AS ref, CASE WHEN sv_type = 'INS' THEN repeat('ACGT', CAST(1 + coalesce(sv_size, 0) % 400 AS INT)) ELSE '<DEL>' END AS alt,
  'SVTYPE=' || CASE WHEN sv_type = 'INS' THEN 'INS' ELSE 'DEL' END || ';END=' || "end" || ';RE=' || (1 + coalesce(sv_size, 0) % 9) || ';PRECISE;RNAMES=' || te || '_1,' || te || '_2' AS info FROM sites)
"""


def _vcf_lines(spark, d):
    s = sites(spark, d).withColumn("n", F.coalesce("sv_size", F.lit(0))).withColumn("ins", F.col("sv_type") == "INS")
    rows = s.select(F.concat_ws("\t", "chrom", (F.col("start") + 1).cast("string"), "ident", F.when(F.col("ins"), "N").otherwise(F.expr("repeat('ACGN', cast(1 + n % 300 as int))")), F.when(F.col("ins"), F.expr("repeat('ACGT', cast(1 + n % 400 as int))")).otherwise("<DEL>"), F.lit("."), F.lit("PASS"), F.concat(F.lit("SVTYPE="), F.when(F.col("ins"), "INS").otherwise("DEL"), F.lit(";END="), F.col("end").cast("string"), F.lit(";RE="), (1 + F.col("n") % 9).cast("string"), F.lit(";PRECISE;RNAMES="), F.col("te"), F.lit("_1,"), F.col("te"), F.lit("_2"))).alias("value")).distinct()
    return rows


@query(sql("sites") + _VCF + "SELECT chrom, pos, id, ref, alt, regexp_extract(info, 'SVTYPE=([^;]*)', 1) AS sv_type, CAST(regexp_extract(info, 'END=([^;]*)', 1) AS BIGINT) AS stop, CAST(regexp_extract(info, 'RE=([^;]*)', 1) AS BIGINT) AS support FROM v")
def sc5_variant_scan(spark, d):
    """Variant lines parsed with their attributes (SC5, F11)."""
    v = formats.parse_vcf(_vcf_lines(spark, d))
    return v.select("chrom", "pos", "id", "ref", "alt", F.element_at("info", F.lit("SVTYPE")).alias("sv_type"), F.element_at("info", F.lit("END")).cast("bigint").alias("stop"), F.element_at("info", F.lit("RE")).cast("bigint").alias("support"))


@query(sql("sites") + _VCF + """, x AS (SELECT *, regexp_extract(info, 'SVTYPE=([^;]*)', 1) AS t, CASE WHEN regexp_extract(info, 'SVTYPE=([^;]*)', 1) = 'INS' THEN alt ELSE ref END AS seq FROM v)
SELECT chrom || ':<' || t || '>:' || pos || ':' || regexp_extract(info, 'END=([^;]*)', 1) || ':sniffles.' || t || '.' || id || ':' || regexp_extract(info, 'RE=([^;]*)', 1) || ':PRECISE' AS name, replace(seq, 'N', 'A') AS seq FROM x WHERE length(seq) > 400 AND t <> 'DUP' AND regexp_matches(chrom, '.')""")
def sc6_variant_sequences(spark, d):
    return formats.variant_sequences(formats.parse_vcf(_vcf_lines(spark, d)), "4.1", least=400, without=["DUP"])


@query(sql("sites") + _VCF + "SELECT DISTINCT id, unnest(string_split(regexp_extract(info, 'RNAMES=([^;]*)', 1), ',')) AS read_name FROM v")
def sc7_supporting_reads(spark, d):
    return formats.supporting_reads(formats.parse_vcf(_vcf_lines(spark, d))).select("id", "read_name").distinct()


@query(sql("sites") + ", l AS (SELECT DISTINCT 'ID=' || ident || ';NAME=' || te || ';SIDE=' || CASE WHEN strand = '-' THEN 'R' ELSE 'L' END || ';coverage=' || coalesce(psize_te, 0) AS a FROM sites)\nSELECT a AS attributes, regexp_extract(a, 'ID=([^;]*)', 1) AS ident, regexp_extract(a, 'NAME=([^;]*)', 1) AS te, regexp_extract(a, 'SIDE=([^;]*)', 1) AS side FROM l".replace("coalesce(psize_te, 0)", "CAST(floor(coalesce(psize_te, 0)) AS BIGINT)"))
def sc14_attributes(spark, d):
    a = sites(spark, d).select(F.concat(F.lit("ID="), "ident", F.lit(";NAME="), "te", F.lit(";SIDE="), F.when(F.col("strand") == "-", "R").otherwise("L"), F.lit(";coverage="), F.floor(F.coalesce("psize_te", F.lit(0.0))).cast("bigint").cast("string")).alias("attributes")).distinct()
    return a.select("attributes", *[tx.attribute(F.col("attributes"), k).alias(n) for k, n in (("ID", "ident"), ("NAME", "te"), ("SIDE", "side"))])


@query("SELECT te_name AS name, 'ELEMENT' || row_number() OVER (ORDER BY te_name) AS pseudo FROM te_sizes WHERE te_name IS NOT NULL AND EXISTS (SELECT 1 FROM te_sizes WHERE regexp_matches(te_name, '[:/\\\\|;!?\"''&]')) UNION ALL SELECT te_name, te_name FROM te_sizes WHERE te_name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM te_sizes WHERE regexp_matches(te_name, '[:/\\\\|;!?\"''&]'))")
def pseudonyms_of_names(spark, d):
    """Names as tools can take them: all renamed if any can't be taken."""
    from strandloom.session import bounded_rows

    names = sorted(r[0] for r in bounded_rows(table(spark, d, "te_sizes").select("te_name").filter("te_name is not null"), 1_000_000, "the element dictionary"))
    new = tx.pseudonyms(names)
    return spark.createDataFrame([(n, new.get(n, n)) for n in names], "name string, pseudo string")


@query(_ALL_SEQS + """, t AS (SELECT seq, list_reduce(list_concat([CAST(0 AS FLOAT)], list_transform(range(1, length(seq) + 1), lambda i: CAST(ord(substr(seq, i, 1)) AS FLOAT) + CAST(6 + i AS FLOAT) / CAST(5 - ord(substr(seq, i, 1)) AS FLOAT))), lambda a, b: a + b) AS v FROM seqs)
SELECT seq, CAST(CAST((v - CAST(trunc(v) AS FLOAT)) * CAST(100000 AS FLOAT) AS FLOAT) + CAST(trunc(v) AS FLOAT) AS DOUBLE) AS chain_id FROM t""")
def f10_chain_id(spark, d):
    """The number that identifiers carry, of every sequence."""
    return evidence_of(spark, d, "seq").select("seq", tx.chain_id(F.col("seq")).alias("chain_id"))


@query("SELECT chrom, size_bp, CASE WHEN size_bp >= 1000000000 THEN format('{:,.2f} Gb', size_bp / 1000000000) WHEN size_bp >= 1000000 THEN format('{:,.2f} Mb', size_bp / 1000000) WHEN size_bp >= 1000 THEN format('{:,.2f} Kb', size_bp / 1000) ELSE size_bp || ' bp' END AS shown FROM chrom_sizes")
def f13_sizes_shown(spark, d):
    return table(spark, d, "chrom_sizes").select("chrom", "size_bp", tx.si(F.col("size_bp")).alias("shown"))


# -- the fact table and summaries --------------------------------------------------------------------------------------
@query(sql("sites") + "SELECT te AS x, 'TSD OK' AS condition, count(*) FILTER (tsd IS NOT NULL AND tsd <> 'NONE') AS y FROM sites GROUP BY te UNION ALL SELECT te, 'TSD KO', count(*) FILTER (tsd IS NULL OR tsd = 'NONE') FROM sites GROUP BY te")
def a7_duplication_per_family(spark, d):
    return report.family_split(sites(spark, d), "te", F.col("tsd") != "NONE", "TSD OK", "TSD KO")


@query(sql("sites") + "SELECT te AS x, count(*) FILTER (strand IS NULL OR strand <> '-') AS forward, -count(*) FILTER (strand = '-') AS reverse FROM sites GROUP BY te")
def a8_strand_per_family(spark, d):
    return report.strand_counts(sites(spark, d), "te", "strand")


@query(sql("sites") + "SELECT ident, max(sv_size) AS sv_size FROM sites GROUP BY ident")
def a10_largest_size(spark, d):
    return sites(spark, d).groupBy("ident").agg(F.max("sv_size").alias("sv_size"))


@query(sql("evidence") + "SELECT chrom, count(*) AS n, CAST(sum(length(seq)) AS BIGINT) AS bases, max(length(seq)) AS longest FROM evidence GROUP BY chrom")
def a11_sequence_sizes(spark, d):
    """Sequences and bases by chromosome."""
    return evidence(spark, d).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("seq")).cast("bigint").alias("bases"), F.max(F.length("seq")).cast("bigint").alias("longest"))


@query(sql("sites") + "SELECT sv_type, count(DISTINCT chrom) AS n_chrom, array_to_string(list_sort(list(DISTINCT te)), ',') AS families FROM sites GROUP BY sv_type")
def a14_distinct_lists(spark, d):
    return sites(spark, d).groupBy("sv_type").agg(F.count_distinct("chrom").alias("n_chrom"), F.array_join(F.array_sort(F.collect_set("te")), ",").alias("families"))


@query(sql("sites") + "SELECT te AS x, condition, y FROM (SELECT te, count(*) FILTER (freq >= 0 AND freq <= 2) AS \"0-2(%)\", count(*) FILTER (freq > 2 AND freq <= 9) AS \"2-9(%)\", count(*) FILTER (freq > 9 AND freq <= 15) AS \"9-15(%)\", count(*) FILTER (freq > 15 AND freq <= 50) AS \"15-50(%)\", count(*) FILTER (freq > 50 AND freq <= 100) AS \"50-100(%)\" FROM sites WHERE freq BETWEEN 0 AND 100 GROUP BY te) UNPIVOT (y FOR condition IN (\"0-2(%)\", \"2-9(%)\", \"9-15(%)\", \"15-50(%)\", \"50-100(%)\"))")
def a16_frequency_bins(spark, d):
    return report.frequency_bins(sites(spark, d), "te", "freq")


@query(sql("sites") + """, w AS (SELECT te AS x, count(*) FILTER (sv_type = 'INS') AS "INS", count(*) FILTER (sv_type = 'DEL') AS "DEL", count(*) FILTER (sv_type NOT IN ('INS', 'DEL')) AS "OTHER", count(*) AS total FROM sites GROUP BY te) SELECT *, row_number() OVER (ORDER BY total, x) AS place FROM w""")
def a18_stacked_groups(spark, d):
    long = sites(spark, d).groupBy(F.col("te").alias("x"), F.when(F.col("sv_type").isin("INS", "DEL"), F.col("sv_type")).otherwise("OTHER").alias("condition")).agg(F.count(F.lit(1)).alias("y"))
    return report.stacked(long, ["INS", "DEL", "OTHER"])


@query(sql("evidence") + """, e AS (SELECT chrom, pos, pos + 1 AS pos1, read_name, seq FROM evidence), r AS (SELECT *, max(pos1) OVER (PARTITION BY chrom ORDER BY pos, pos1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e), c AS (SELECT *, sum(CASE WHEN reach IS NULL OR pos > reach + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY pos, pos1) AS cl FROM r),
o AS (SELECT chrom, cl, read_name, min(seq) AS seq FROM c WHERE seq IS NOT NULL GROUP BY chrom, cl, read_name)
SELECT chrom, CAST(cl AS BIGINT) AS cluster, read_name, seq, row_number() OVER (PARTITION BY chrom, cl ORDER BY read_name) AS number, count(*) OVER (PARTITION BY chrom, cl) AS support FROM o""")
def a19_cluster_members(spark, d):
    """One sequence for each read of a cluster, numbered, with the number of reads."""
    from pyspark.sql import Window

    c = iv.cluster(evidence(spark, d).withColumn("__end", F.col("pos") + 1), ["chrom"], "pos", "__end", 50)
    one = c.filter("seq is not null").groupBy("chrom", "cluster", "read_name").agg(F.min("seq").alias("seq"))
    w = Window.partitionBy("chrom", "cluster")
    return one.select("chrom", "cluster", "read_name", "seq", F.row_number().over(w.orderBy("read_name")).cast("bigint").alias("number"), F.count(F.lit(1)).over(w).alias("support"))


@query(sql("sites") + "SELECT sv_type, count(DISTINCT {'c': chrom, 's': \"start\"}) AS positions FROM sites GROUP BY sv_type")
def a22_type_histogram(spark, d):
    return sites(spark, d).groupBy("sv_type").agg(F.count_distinct("chrom", "start").alias("positions"))


@query(sql("sites") + "SELECT count(*) FILTER (tsd IS NOT NULL AND tsd <> 'NONE') AS ok, count(*) FILTER (tsd IS NULL OR tsd = 'NONE') AS ko, count(*) AS total FROM sites")
def a23_duplication_totals(spark, d):
    ok = F.coalesce(F.col("tsd") != "NONE", F.lit(False))
    return sites(spark, d).agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("ko"), F.count(F.lit(1)).alias("total"))


@query(sql("sites") + "SELECT sv_id, CASE WHEN regexp_matches(sv_id, 'SOFT|HARD|DEL|INS') THEN regexp_extract(sv_id, '(SOFT|HARD|DEL|INS)', 1) || CASE WHEN coalesce(sv_size, 0) > 6000 THEN '_DEL' ELSE '' END END AS kind FROM sites")
def variant_kinds(spark, d):
    """Kind of a variant from its identifier."""
    big = F.when(F.coalesce("sv_size", F.lit(0)) > 6000, "_DEL").otherwise("")
    return sites(spark, d).select("sv_id", F.concat(tx.variant_type(F.col("sv_id")), big).alias("kind"))


@query("SELECT sv_type, count(*) AS n_rows, count(*) FILTER (end_pos <= start_pos) AS bad FROM te_infos GROUP BY sv_type")
def bad_positions(spark, d):
    """Audit of the positions as stored (P15): facts that end where they begin or before, by kind."""
    return table(spark, d, "te_infos").groupBy("sv_type").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("end_pos") <= F.col("start_pos")).alias("bad"))


# The fact table: three kinds of sites, each with sources of its own. Matches come from the hits, the best of an identifier in each
# source; duplications and frequencies from the facts, raised by 20 where they stand for the precise ones, so that some exceed 100.
_MATCHES = """, m AS (SELECT split_part(qseqid, ':', 5) AS ident, regexp_replace(split_part(qseqid, ':', 2), '[<>]', '', 'g') AS kind, split_part(qseqid, ':', 7) AS prec, TRY_CAST(split_part(qseqid, ':', 6) AS BIGINT) AS support, split_part(qseqid, ':', 1) AS chrom, TRY_CAST(split_part(qseqid, ':', 3) AS BIGINT) AS s, TRY_CAST(split_part(qseqid, ':', 4) AS BIGINT) AS e,
  pident, round(abs(qend - qstart) / size_bp * 100, 2) AS psize_te, abs(qend - qstart) AS size_el, CASE WHEN send < sstart THEN '-' ELSE '+' END AS strand, sseqid AS te, bitscore, line_no FROM hits JOIN te_sizes ON sseqid = te_name),
src AS (SELECT *, unnest(list_filter([CASE WHEN kind = 'INS' AND prec = 'PRECISE' THEN 1 END, CASE WHEN kind = 'INS' THEN 2 END, CASE WHEN kind = 'SOFT' THEN 3 END, CASE WHEN kind = 'HARD' THEN 4 END, CASE WHEN kind = 'DEL' THEN 5 END], lambda x: x IS NOT NULL)) AS pr FROM m),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pr, ident ORDER BY bitscore DESC, line_no) AS r FROM src) WHERE r = 1),
know AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ident ORDER BY pr) AS k FROM best WHERE pr <= 4) WHERE k = 1),
dup AS (SELECT ident, min({'t': tsd, 'z': size_te, 'p': new_pos}) AS d FROM sites WHERE tsd IS NOT NULL AND tsd <> 'NONE' GROUP BY ident),
fr AS (SELECT ident, min(freq) AS f, min(freq_with_clipped) AS g FROM sites GROUP BY ident), vs AS (SELECT ident, max(sv_size) AS z, max(sv_size + 7) FILTER (sv_type = 'Repeat_expansion') AS q FROM sites GROUP BY ident),
cut AS (SELECT DISTINCT ident FROM sites WHERE sv_type = 'INS_DEL'), st AS (SELECT DISTINCT chrom, "start", "end", te, ident, strand, sv_id LIKE 'TE_ID_INSIDER%' AS inside FROM sites)
"""
_FACT = """SELECT st.chrom, st."start", st."end", st.te, st.ident, st.strand, d.t AS tsd, know.pident, know.psize_te, CASE WHEN d.t IS NOT NULL THEN d.z ELSE know.size_el END AS size_te, coalesce(d.p, st."start") AS new_pos, {freq}, {size} AS sv_size, {ident} AS sv_id, {kind} AS sv_type
FROM {sites} st LEFT JOIN {know} know ON know.ident = st.ident LEFT JOIN dup ON dup.ident = st.ident LEFT JOIN fr ON fr.ident = st.ident LEFT JOIN vs ON vs.ident = st.ident LEFT JOIN cut ON cut.ident = st.ident"""
_CALL = "regexp_extract(st.ident, '(SOFT|HARD|DEL|INS)', 1)"
_DELETIONS = "(SELECT chrom, s AS \"start\", e AS \"end\", te, ident, strand FROM best WHERE pr = 5 AND s IS NOT NULL AND e IS NOT NULL)"
_INSIDE = {"freq": "f AS freq, CAST(NULL AS DOUBLE) AS freq_with_clipped", "size": "vs.q", "ident": "'TE_ID_INSIDER.' || st.chrom || ':' || st.\"start\" || '.' || coalesce(know.kind, 'UNKNOWN')", "kind": "know.kind"}


@query(sql("sites", "hits") + _MATCHES + _FACT.format(
    sites="(SELECT * FROM st WHERE NOT inside)", know="know", freq="CASE WHEN f + 20 <= 100 AND g + 20 <= 100 THEN f + 20 ELSE f END AS freq, CASE WHEN f + 20 <= 100 AND g + 20 <= 100 THEN g + 20 ELSE g END AS freq_with_clipped", size="vs.z",
    ident=f"CASE WHEN regexp_matches(st.ident, 'SOFT|HARD') THEN 'TE_ID_OUTSIDER.' || st.ident ELSE concat_ws('.', 'TE_ID_OUTSIDER', st.chrom || ':' || st.\"start\", know.kind, coalesce(know.support, 0)::VARCHAR) END",
    kind=f"CASE WHEN {_CALL} <> '' THEN {_CALL} || CASE WHEN cut.ident IS NOT NULL THEN '_DEL' ELSE '' END END",
) + "\nUNION ALL " + _FACT.format(sites="(SELECT * FROM st WHERE inside)", know="(SELECT * FROM best WHERE pr = 2)", **_INSIDE) + "\nUNION ALL " + _FACT.format(sites=_DELETIONS, know="(SELECT * FROM best WHERE pr = 5)", **_INSIDE))
def j8_fact_table(spark, d):
    """The wide fact table with all its columns: sites seen in reads, those of the assembly, and its deletions."""
    s = sites(spark, d)
    sized = stored_hits(spark, d).join(table(spark, d, "te_sizes").withColumnRenamed("te_name", "sseqid"), "sseqid")
    k, key, size = tx.locus(F.col("qseqid")), F.col("qseqid"), F.abs(F.col("qend") - F.col("qstart"))
    found = sized.select(
        tx.field(key, 5).alias("ident"), k["sv_type"].alias("kind"), k["support"].alias("support"), "pident", tx.size_percent(F.col("qstart"), F.col("qend"), F.col("size_bp")).alias("psize_te"), size.alias("size_el"), "bitscore", "line_no",
        k["precision"].alias("precision"), k["chrom"].alias("chrom"), k["start"].alias("start"), k["end"].alias("end"), F.col("sseqid").alias("te"), tx.strand_of(F.col("sstart"), F.col("send")).alias("strand"),
    ).filter("ident is not null")
    first = lambda where: F.min_by(F.struct(*report.MATCHED, "chrom", "start", "end", "te", "strand"), F.when(where, F.struct(-F.col("bitscore"), "line_no")))
    is_ = lambda x: F.col("kind") == x
    sources = {"combined": is_("INS") & (F.col("precision") == "PRECISE"), "INS": is_("INS"), "SOFT": is_("SOFT"), "HARD": is_("HARD"), "DEL": is_("DEL")}
    # The best hit of an identifier in every source, by one aggregate.
    best = found.groupBy("ident").agg(*[F.when(F.count_if(where) > 0, first(where)).alias(n) for n, where in sources.items()])
    # What the facts say of an identifier, by one aggregate too.
    twenty = lambda c: F.min(c) + 20
    pair = lambda a, b: F.struct(a.alias("freq"), b.alias("freq_with_clipped"))
    about = s.groupBy("ident").agg(
        F.min(F.when(F.col("tsd") != "NONE", F.struct("tsd", "size_te", "new_pos"))).alias("duplication"), pair(F.min("freq"), F.min("freq_with_clipped")).alias("base"), pair(twenty("freq"), twenty("freq_with_clipped")).alias("sharp"),
        pair(F.min("freq"), F.lit(None).cast("double")).alias("depth"), F.max("sv_size").alias("size"), F.max(report.variant_size(F.col("sv_type"), F.col("sv_size"), F.col("sv_size") + 7)).alias("grown"),
        F.max(F.coalesce(F.col("sv_type") == "INS_DEL", F.lit(False))).alias("cut"),
    )
    place = ["chrom", "start", "end", "te", "ident", "strand"]
    places = s.select(*place, F.when(F.col("sv_id").startswith("TE_ID_INSIDER"), "inside").otherwise("outside").alias("part")).distinct()
    gone = best.filter("DEL is not null").select("ident", "DEL.*").filter("start is not null and end is not null").select(*place, F.lit("deleted").alias("part"))
    part = lambda outside, inside, deleted: F.when(F.col("part") == "outside", outside).when(F.col("part") == "inside", inside).otherwise(deleted)
    only = lambda c: F.struct(*[c[x].alias(x) for x in report.MATCHED])
    match = part(only(report.first_match("combined", "INS", "SOFT", "HARD")), only(F.col("INS")), only(F.col("DEL")))
    text, call = lambda c: c, tx.variant_type(F.col("ident"))
    kind = part(F.concat(call, F.when(F.col("cut"), "_DEL").otherwise("")), F.col("kind"), F.col("kind"))
    inner = report.insider_id(text)
    return report.fact_table(
        places.unionByName(gone), best.join(about, "ident", "full"), match, part(report.first_frequency("sharp", "base"), F.col("depth"), F.col("depth")), part(F.col("size"), F.col("grown"), F.col("grown")), part(report.outsider_id(text), inner, inner), kind,
    )


@query(sql("sites") + """, s AS (SELECT DISTINCT chrom, te, sv_id, split_part(ident, '.', 1) AS tool FROM sites), k AS (SELECT *, chrom || te AS key FROM s), a AS (SELECT * FROM k WHERE tool = 'snif'), b AS (SELECT * FROM k WHERE tool = 'rdins' AND key NOT IN (SELECT key FROM a)), c AS (SELECT * FROM k WHERE tool NOT IN ('snif', 'rdins') AND key NOT IN (SELECT key FROM a) AND key NOT IN (SELECT key FROM b))
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""")
def u2_priority_union(spark, d):
    """Call sets in order of trust; a later one adds only what no earlier one has."""
    s = sites(spark, d).select("chrom", "te", "sv_id", F.split_part("ident", F.lit("."), F.lit(1)).alias("tool")).distinct().withColumn("key", F.concat("chrom", "te"))
    return report.priority_union([s.filter("tool = 'snif'"), s.filter("tool = 'rdins'"), s.filter("tool not in ('snif', 'rdins')")], "key")


_MERGE = """, s AS (SELECT DISTINCT chrom, te, "start" AS s, "end" AS e, sv_id, CASE WHEN regexp_matches(sv_id, 'SOFT') THEN 'SOFT' WHEN regexp_matches(sv_id, 'HARD') THEN 'HARD' WHEN split_part(ident, '.', 1) = 'snif' THEN 'CALLER' ELSE 'READS' END AS src FROM sites),
r AS (SELECT *, max(e) OVER (PARTITION BY src, chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s), c AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY src, chrom ORDER BY s, e) AS cl FROM r),
d AS (SELECT *, lag(te) OVER (PARTITION BY src, chrom, cl ORDER BY s, e, te, sv_id) AS b FROM c), k AS (SELECT chrom, te, s, e, sv_id, src FROM d WHERE b IS NULL OR b <> te),
m1 AS (SELECT * FROM k WHERE src = 'CALLER'), m2 AS (SELECT * FROM m1 UNION ALL SELECT * FROM k WHERE src = 'READS' AND NOT EXISTS (SELECT 1 FROM m1 WHERE m1.chrom = k.chrom AND m1.te = k.te AND m1.s < k.e + 100000 AND m1.e > k.s - 100000)),
m3 AS (SELECT * FROM m2 UNION ALL SELECT * FROM k WHERE src = 'SOFT' AND NOT EXISTS (SELECT 1 FROM m2 WHERE m2.chrom = k.chrom AND m2.te = k.te AND m2.s < k.e + 100000 AND m2.e > k.s - 100000)),
m4 AS (SELECT * FROM m3 UNION ALL SELECT * FROM k WHERE src = 'HARD' AND NOT EXISTS (SELECT 1 FROM m3 WHERE m3.chrom = k.chrom AND m3.te = k.te AND m3.s < k.e + 100000 AND m3.e > k.s - 100000))
"""


@query(sql("sites") + _MERGE + "SELECT chrom, te, s AS \"start\", sv_id, src FROM m4")
def merge_call_sets(spark, d):
    """Calls of four sources merged by priority: clustered and deduped each, then what lies near no better one of its family."""
    src = F.when(F.col("sv_id").contains("SOFT"), "SOFT").when(F.col("sv_id").contains("HARD"), "HARD").when(F.split_part("ident", F.lit("."), F.lit(1)) == "snif", "CALLER").otherwise("READS")
    s = sites(spark, d).select("chrom", "te", "start", "end", "sv_id", src.alias("src")).distinct()
    return configured.call_sets(s, "src", ["CALLER", "READS", "SOFT", "HARD"], params({"clusters": {"window": 100_000}})).select("chrom", "te", "start", "sv_id", "src")


@query(sql("sites") + "SELECT chrom, te FROM sites GROUP BY chrom, te HAVING count(*) = 2")
def u4_exactly_twice(spark, d):
    """Keys that occur exactly twice, distinct."""
    return sites(spark, d).groupBy("chrom", "te").agg(F.count(F.lit(1)).alias("n")).filter("n = 2").select("chrom", "te")


@query(sql("sites") + ", c AS (SELECT te AS x, sv_type AS y, count(*) AS z FROM sites GROUP BY te, sv_type), t AS (SELECT x FROM c GROUP BY x ORDER BY sum(z) DESC, x LIMIT 50), ys AS (SELECT DISTINCT y FROM c WHERE x IN (SELECT x FROM t))\nSELECT t.x, ys.y, coalesce(c.z, 0) AS z FROM t CROSS JOIN ys LEFT JOIN c ON c.x = t.x AND c.y = ys.y")
def t6_top_families_grid(spark, d):
    return report.top_grid(sites(spark, d), "te", "sv_type", 50)


@query(sql("sites") + "SELECT chrom, te, n, n2 FROM (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY n DESC, n2 DESC, te) AS r FROM (SELECT chrom, te, count(*) AS n, count(DISTINCT \"start\") AS n2 FROM sites GROUP BY chrom, te)) WHERE r = 1")
def t4_max_with_cascade(spark, d):
    """The commonest family of each chromosome, ties by a second count, then by name."""
    c = sites(spark, d).groupBy("chrom", "te").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("start").alias("n2"))
    best = c.groupBy("chrom").agg(F.min(F.struct((-F.col("n")).alias("a"), (-F.col("n2")).alias("b"), "te")).alias("m"))
    return best.select("chrom", "m.te", (-F.col("m.a")).alias("n"), (-F.col("m.b")).alias("n2"))


@query("SELECT event_id, user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS stop, CAST(floor(epoch(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) - floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def w9_durations(spark, d):
    """Each event lasts until the next one of its user."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    return report.durations(e, ["user_id"], "ts", ["event_id"])


@query("WITH e AS (SELECT user_id, event_id, date_trunc('second', ts) AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE ts IS NOT NULL)\nSELECT user_id, 'step' || event_id AS category, s AS \"start\", lead(s) OVER w AS stop, CAST(epoch(lead(s) OVER w) - epoch(s) AS BIGINT) AS seconds FROM e WINDOW w AS (PARTITION BY user_id ORDER BY n)")
def f16_run_log(spark, d):
    """Logs of runs, one for each user, as timelines: each step until the next one (F16)."""
    from pyspark.sql import Window

    e = table(spark, d, "events").filter("ts is not null").withColumn("n", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    both = F.array(F.concat(F.lit("["), F.date_format("ts", "E MMM d HH:mm:ss yyyy"), F.lit("]")), F.concat(F.lit("rule step"), F.col("event_id").cast("string"), F.lit(":")), F.lit("    input: x"))
    lines = e.select("user_id", "n", F.posexplode(both).alias("i", "value")).select("user_id", (F.col("n") * 3 + F.col("i")).alias("line_no"), "value")
    return report.durations(report.run_log(lines, ["user_id"]), ["user_id"], "start", ["line_no"]).select("user_id", "category", "start", "stop", "seconds")


@query(sql("sites") + "SELECT '{\"group\":\"' || te || '\",\"value\":' || count(*) || '}' AS datum FROM sites GROUP BY te")
def f17_json_rows(spark, d):
    c = sites(spark, d).groupBy(F.col("te").alias("group")).agg(F.count(F.lit(1)).alias("value"))
    return report.json_rows(c, ["group", "value"])


@query(sql("sites") + "SELECT DISTINCT '{\"chr\":\"' || chrom || '\",\"start\":\"' || \"start\" || '\",\"end\":\"' || \"end\" || '\",\"name\":\"' || te || '\",\"des\":\"' || sv_type || '\"}' AS datum FROM sites WHERE sv_type IS NOT NULL")
def f18_plot_scatter(spark, d):
    s = sites(spark, d).filter("sv_type is not null").select(F.col("chrom").alias("chr"), "start", "end", F.col("te").alias("name"), F.col("sv_type").alias("des")).distinct()
    return report.plot_data(s, "SCATTER")


_DATA = {
    "SNP": {"chr": "chrom", "pos": "start", "value": "size", "des": "te", "color": "strand"}, "ARC": {"chr": "chrom", "start": "start", "end": "end", "color": "strand", "des": "te"}, "HEATMAP": {"chr": "chrom", "start": "start", "end": "end", "name": "te", "value": "size"},
    "LINE": {"chr": "chrom", "pos": "start", "value": "size"}, "HISTOGRAM": {"chr": "chrom", "start": "start", "end": "end", "name": "te", "value": "size"}, "CNV": {"chr": "chrom", "start": "start", "end": "end", "value": "size"},
    "LINK": {"fusion": "ident", "g1chr": "chrom", "g1start": "start", "g1end": "end", "g1name": "te", "g2chr": "chrom", "g2start": "new_pos", "g2end": "new_pos", "g2name": "te"},
}


@query(sql("sites") + """, s AS (SELECT DISTINCT chrom, "start", "end", te, ident, coalesce(strand, '.') AS strand, coalesce(size_te, 0) AS size, coalesce(new_pos, 0) AS new_pos FROM sites)
""" + "\nUNION ALL ".join(f"SELECT '{layout}' AS layout, '{{' || " + " || ',' || ".join(f"""'"{f}":"' || "{c}" || '"'""" for f, c in fields.items()) + " || '}' AS datum FROM s" for layout, fields in _DATA.items()))
def f18_plot_layouts(spark, d):
    """The sites as data of the other layouts of circular plots."""
    s = sites(spark, d).select("chrom", "start", "end", "te", "ident", F.coalesce("strand", F.lit(".")).alias("strand"), F.coalesce("size_te", F.lit(0)).alias("size"), F.coalesce("new_pos", F.lit(0)).alias("new_pos")).distinct()
    made = [report.plot_data(s.select(*[F.col(c).alias(f) for f, c in fields.items()]), layout).select(F.lit(layout).alias("layout"), "datum") for layout, fields in _DATA.items()]
    out = made[0]
    for m in made[1:]:
        out = out.unionByName(m)
    return out


@query("SELECT '[\"' || chrom || '\",' || size_bp || ']' AS datum FROM chrom_sizes")
def f19_genome_layout(spark, d):
    return table(spark, d, "chrom_sizes").select(F.concat(F.lit('["'), "chrom", F.lit('",'), F.col("size_bp").cast("string"), F.lit("]")).alias("datum"))


@query("""WITH h AS (SELECT DISTINCT line_no, sseqid, qstart, qend, sstart, send FROM blast_hits WHERE sseqid NOT IN ('.', 'NONE') AND line_no IS NOT NULL AND sstart IS NOT NULL AND send IS NOT NULL),
g AS (SELECT line_no, sstart > send AS down, size_bp AS sz, 4000 + line_no % 5000 AS ql, least(sstart, send) AS s, greatest(sstart, send) AS e, least(qstart, qend) AS q FROM h JOIN te_sizes ON sseqid = te_name),
r AS (SELECT *, CAST(floor((200 * CASE WHEN down THEN sz - e ELSE s - 1 END + sz) / (2 * sz)) AS BIGINT) AS lead, CAST(floor((200 * (e - s) + sz) / (2 * sz)) AS BIGINT) AS share, CAST(floor((200 * (q - 1) + ql) / (2 * ql)) AS BIGINT) AS place FROM g)
SELECT line_no, CAST(CASE WHEN down THEN -1 ELSE 1 END AS BIGINT) AS strand, 500 * lead // 100 AS lead0, 500 * sz * lead // (100 * ql) AS lead1, 500 * place // 100 - 500 * lead // 100 AS posq0, 500 * place // 100 - 500 * sz * lead // (100 * ql) AS posq1, 500 * share // 100 AS size0, 500 * sz * share // (100 * ql) AS size1 FROM r""")
def f20_hit_geometry(spark, d):
    """All hits of a known element (F20); those that begin before 1 or end beyond it have parts outside the axis."""
    h = table(spark, d, "blast_hits").filter(eager.present("sseqid")).filter("line_no is not null and sstart is not null and send is not null").select("line_no", "sseqid", "qstart", "qend", "sstart", "send").distinct()
    j = h.join(table(spark, d, "te_sizes").withColumnRenamed("te_name", "sseqid"), "sseqid").withColumn("ql", 4000 + F.col("line_no") % 5000)
    return viewer.geometry(j, "sstart", "send", "qstart", "qend", "size_bp", "ql").select("line_no", "strand", "lead0", "lead1", "posq0", "posq1", "size0", "size1")


@query(sql("hits") + "SELECT DISTINCT sseqid FROM hits WHERE lower(sseqid) LIKE '%ro%' OR lower(sseqid) LIKE '%xa%' ORDER BY sseqid LIMIT 20")
def t3_completion(spark, d):
    """Up to 20 element names that hold one of the parts in any case."""
    return viewer.complete(hits(spark, d), "sseqid", ["ro", "XA"])


@query(sql("hits") + "SELECT qseqid, sseqid, max(bitscore) AS best, count(*) AS n_hits, min(line_no) AS line_no FROM hits GROUP BY qseqid, sseqid ORDER BY best DESC")
def t2_groups_by_score(spark, d):
    """Hit groups of all chromosomes, best first."""
    return viewer.groups(hits(spark, d)).orderBy(F.col("best").desc(), "qseqid", "sseqid")


@query(sql("hits") + "SELECT split_part(qseqid, ':', 1) AS chrom, count(DISTINCT {'q': qseqid, 's': sseqid}) AS n_groups, count(*) AS n_hits FROM hits GROUP BY 1")
def k5_chromosomes(spark, d):
    """The chromosomes the viewer offers, with what lies on them (K5)."""
    return viewer.chromosomes(hits(spark, d))


@query(sql("hits") + "SELECT split_part(qseqid, ':', 1) AS chrom, TRY_CAST(split_part(qseqid, ':', 3) AS BIGINT) AS \"start\", qseqid, sseqid, max(bitscore) AS best, count(*) AS n_hits, min(line_no) AS line_no FROM hits GROUP BY qseqid, sseqid")
def k5_groups_by_position(spark, d):
    """Hit groups in the order of their places (K5)."""
    return viewer.by_position(hits(spark, d))


_FACTS = ("chrom", "start_pos", "end_pos", "te_id", "strand", "tsd", "pident", "psize_te", "size_te", "new_pos", "freq", "freq_with_clipped", "sv_size", "sv_id", "sv_type")
_SIGNS = dict.fromkeys(_FACTS, "NONE") | {"strand": "."}


@query("SELECT " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{_SIGNS[c]}') AS {c}" for c in _FACTS) + " FROM te_infos")
def k1_export_signs(spark, d):
    """All facts with all their columns as text, with the signs of missing for export (K1)."""
    return report.sentinels(table(spark, d, "te_infos").select(*_FACTS), _SIGNS)


@query(sql("hits") + "SELECT * FROM (SELECT line_no, CAST((line_no - 1) % 7 AS BIGINT) AS part FROM hits)")
def k7_parts(spark, d):
    """Rows dealt to a number of parts (K7, SC17)."""
    return hits(spark, d).select("line_no", ((F.col("line_no") - 1) % 7).alias("part"))


# -- generations -------------------------------------------------------------------------------------------------------
MANIFEST = (("G17", 17), ("G11", 11), ("G31", 31), ("G73", 73), ("G88", 88), ("G100", 100))
_POINTS = """, src AS (SELECT DISTINCT chrom, start_pos, te_id, TRY_CAST(freq AS DOUBLE) AS f, TRY_CAST(freq_with_clipped AS DOUBLE) AS g, sv_id, sv_type FROM te_infos WHERE chrom NOT IN ('.', 'NONE')),
pt AS (SELECT chrom, start_pos AS x, f / 100 AS y1, g / 100 AS y2, ['G17', 'G11', 'G31', 'G73', 'G88', 'G100'][1 + start_pos % 6] AS "group", split_part(te_id, '|', 1) AS te, split_part(te_id, '|', 2) AS id, chrom || ':' || (start_pos // 2000000) || ':' || split_part(te_id, '|', 1) AS name FROM src
  WHERE sv_id LIKE '%OUTSIDER%' AND NOT regexp_matches(sv_id, 'HARD|SOFT') AND NOT regexp_matches(sv_type, 'HARD|SOFT|^DEL$') AND f IS NOT NULL AND g IS NOT NULL)
"""
_TRENDS = """, one AS (SELECT name, "group", min({'a': y1, 'b': y2}) AS y FROM pt GROUP BY name, "group"), m AS (SELECT * FROM (VALUES ('G17', 0, 17), ('G11', 1, 11), ('G31', 2, 31), ('G73', 3, 73), ('G88', 4, 88), ('G100', 5, 100)) t(g, ix, num)),
o AS (SELECT name, g, ix, num, y.a AS y1, y.b AS y2, lead(ix) OVER w AS nix, lead(num) OVER w AS nnum, lead(y.a) OVER w AS n1, lead(y.b) OVER w AS n2, row_number() OVER w AS r FROM one JOIN m ON "group" = g WINDOW w AS (PARTITION BY name ORDER BY ix)),
q AS (SELECT *, (n1 * 100 - y1 * 100) / (nnum - num) AS rate1, (n2 * 100 - y2 * 100) / (nnum - num) AS rate2 FROM o),
tr AS (SELECT name, sum(CASE WHEN r = 1 THEN y1 / num ELSE 0 END + coalesce(rate1 * (nix - ix), 0)) AS sum1, sum(CASE WHEN r = 1 THEN y2 / num ELSE 0 END + coalesce(rate2 * (nix - ix), 0)) AS sum2,
  CASE WHEN bool_or(rate1 > 0) AND NOT bool_or(rate1 < 0) THEN '+' WHEN bool_or(rate1 < 0) AND NOT bool_or(rate1 > 0) THEN '-' WHEN NOT bool_or(rate1 > 0) AND NOT bool_or(rate1 < 0) THEN '=' ELSE '~' END AS type1,
  CASE WHEN bool_or(rate2 > 0) AND NOT bool_or(rate2 < 0) THEN '+' WHEN bool_or(rate2 < 0) AND NOT bool_or(rate2 > 0) THEN '-' WHEN NOT bool_or(rate2 > 0) AND NOT bool_or(rate2 < 0) THEN '=' ELSE '~' END AS type2, arg_min(g, ix) || '-' || arg_max(g, ix) AS gen_inter, count(*) AS nb_gen FROM q GROUP BY name HAVING count(*) >= 2)
"""


def _scatter(spark, d):
    """Points of six generations made from the facts, named by windows of 2 Mb so that names recur."""
    f = table(spark, d, "te_infos").filter(eager.present("chrom")).select("chrom", F.col("start_pos").alias("start"), "te_id", "freq", "freq_with_clipped", "sv_id", "sv_type").distinct()
    p = generations.points(f, "G")
    te = F.element_at(F.split("name", ":"), -1)
    return p.withColumn("group", F.get(F.array(*[F.lit(g) for g, _ in MANIFEST]), (F.col("x") % 6).cast("int"))).withColumn("name", F.concat_ws(":", "chrom", F.expr("x div 2000000"), te))


@query('WITH z AS (SELECT 1)' + _POINTS + 'SELECT chrom, x, round(y1, 6) AS y1, round(y2, 6) AS y2, "group", name, id FROM pt')
def generation_points(spark, d):
    """Points of the generations from the filtered facts (SC16, P18)."""
    return _scatter(spark, d).select("chrom", "x", F.round("y1", 6).alias("y1"), F.round("y2", 6).alias("y2"), "group", "name", "id")


@query('WITH z AS (SELECT 1)' + _POINTS + _TRENDS + "SELECT name, round(sum1, 4) AS sum1, round(sum2, 4) AS sum2, type1, type2, gen_inter, nb_gen FROM tr")
def a17_generation_trends(spark, d):
    t = generations.trends(_scatter(spark, d), MANIFEST)
    return t.select("name", F.round("sum1", 4).alias("sum1"), F.round("sum2", 4).alias("sum2"), "type1", "type2", "gen_inter", "nb_gen")


@query('WITH z AS (SELECT 1)' + _POINTS + _TRENDS + "SELECT chrom, x, \"group\", pt.name, pt.id, coalesce(type1, 'NONE') AS type1, coalesce(type2, 'NONE') AS type2, coalesce(CAST(nb_gen AS VARCHAR), 'NONE') AS nb_gen FROM pt LEFT JOIN tr ON pt.name = tr.name")
def j17_points_with_trends(spark, d):
    s = _scatter(spark, d)
    return generations.with_trends(s, generations.trends(s, MANIFEST)).select("chrom", "x", "group", "name", "id", "type1", "type2", "nb_gen")


@query('WITH z AS (SELECT 1)' + _POINTS + _TRENDS + "SELECT name, nb_gen FROM tr WHERE type1 = '~' AND nb_gen >= 3 AND split_part(name, ':', 1) = 'A1'")
def k9_trend_filter(spark, d):
    return generations.keep_trends(generations.trends(_scatter(spark, d), MANIFEST), trend="~", least_generations=3, chrom="A1").select("name", "nb_gen")


@query('WITH z AS (SELECT 1)' + _POINTS + """, r AS (SELECT *, max(x + 1) OVER (PARTITION BY chrom ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM pt), c AS (SELECT *, sum(CASE WHEN reach IS NULL OR x > reach + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY x) AS cl FROM r)
SELECT chrom, min(x) OVER (PARTITION BY chrom, cl) AS x, "group", id, chrom || ':' || min(x) OVER (PARTITION BY chrom, cl) || ':' || te AS name FROM c""")
def generation_positions_merged(spark, d):
    """Points within 200 bases take one position (Q7)."""
    s = _scatter(spark, d)
    return configured.generation_points(s, params({})).select("chrom", "x", "group", "id", "name")
