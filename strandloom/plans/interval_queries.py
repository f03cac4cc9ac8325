"""Queries of interval algebra (I1-I10, J3-J6, P2-P4, W4, W6, U2) with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.operators import intervals as iv

from strandloom.params import Params
from strandloom.plans import configured
from strandloom.plans.views import aligned, evidence, sites, sql, stored_alignments
from strandloom.session import table

QUERIES, SQL = {}, {}


def query(text: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if text is not None:
            SQL[f.__name__] = text
        return f

    return add


def _clusters(view: str, keys: str, start: str, end: str, d: int) -> str:
    return f"""reach AS (SELECT *, max({end}) OVER (PARTITION BY {keys} ORDER BY {start}, {end} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {view}),
clustered AS (SELECT *, sum(CASE WHEN reach IS NULL OR {start} > reach + {d} THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY {start}, {end}) AS cl FROM reach)"""


@query(sql("sites") + """SELECT chrom, "start", "end", te, CAST(row_number() OVER (PARTITION BY chrom ORDER BY "start", "end", sv_id) AS BIGINT) AS rank FROM sites""")
def i1_sort_rank(spark, d):
    """Place of every site in chromosome order, from ranks in ranges of coordinates."""
    s = sites(spark, d)
    placed = iv.carried(s, ["chrom"], "start", ["end", "sv_id"], {"rank": ("sum", F.lit(1), 0)})
    return placed.select("chrom", "start", "end", "te", "rank")


@query(sql("evidence") + ", e AS (SELECT chrom, pos, pos + 1 AS pos1, read_name, op_len FROM evidence), " + _clusters("e", "chrom", "pos", "pos1", 50) + "SELECT chrom, pos, read_name, op_len, CAST(cl AS BIGINT) AS cluster FROM clustered")
def i2_cluster_d50(spark, d):
    e = evidence(spark, d).select("chrom", "pos", (F.col("pos") + 1).alias("pos1"), "read_name", "op_len")
    return configured.read_clusters(e, Params()).select("chrom", "pos", "read_name", "op_len", "cluster")


@query(sql("sites") + ", " + _clusters("sites", "chrom", '"start"', '"end"', 100) + """SELECT chrom, min("start") AS "start", max("end") AS "end", count(*) AS n FROM clustered GROUP BY chrom, cl""")
def i3_merge_d100(spark, d):
    return iv.merge(sites(spark, d), ["chrom"], "start", "end", 100).select("chrom", "start", "end", "n")


_R = ", a AS (SELECT rid AS chrom, least(rstart, rend) AS lo, greatest(rstart, rend) AS hi FROM aligned WHERE rstart <> rend)"
_FREE = """, known AS (SELECT a.chrom, greatest(lo, 0) AS lo, least(hi, size_bp) AS hi FROM a JOIN chrom_sizes c ON a.chrom = c.chrom WHERE greatest(lo, 0) < least(hi, size_bp)),
ends AS (SELECT chrom, lo, hi FROM known UNION ALL SELECT chrom, -1, 0 FROM chrom_sizes UNION ALL SELECT chrom, size_bp, size_bp + 1 FROM chrom_sizes),
reach AS (SELECT chrom, lo, max(hi) OVER (PARTITION BY chrom ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ends),
free AS (SELECT chrom, reach AS "start", lo AS "end" FROM reach WHERE lo > reach)
"""


def _on_reference(spark, d):
    return aligned(spark, d).filter("rstart <> rend").select(F.col("rid").alias("chrom"), F.least("rstart", "rend").alias("start"), F.greatest("rstart", "rend").alias("end"))


@query(sql("aligned") + _R + _FREE + 'SELECT chrom, "start", "end" FROM free')
def i4_complement(spark, d):
    return iv.complement(_on_reference(spark, d), table(spark, d, "chrom_sizes"), ["chrom"], "start", "end", "size_bp")


@query(sql("sites", "evidence") + """, b AS (SELECT DISTINCT chrom, pos AS s, pos + greatest(op_len, 1) AS e FROM evidence),
w AS (SELECT chrom, sv_id, "start" - 2000 AS "start", "end" + 2000 AS "end" FROM sites),
cuts AS (SELECT w.chrom, sv_id, w."start", w."end", greatest(b.s, w."start") AS s, least(b.e, w."end") AS e FROM w JOIN b ON w.chrom = b.chrom AND b.s < w."end" AND b.e > w."start"
  UNION ALL SELECT chrom, sv_id, "start", "end", "start" - 1, "start" FROM w UNION ALL SELECT chrom, sv_id, "start", "end", "end", "end" + 1 FROM w),
reach AS (SELECT *, max(e) OVER (PARTITION BY chrom, sv_id, "start", "end" ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM cuts)
SELECT DISTINCT chrom, sv_id, reach AS piece_start, s AS piece_end FROM reach WHERE s > reach""")
def i5_subtract(spark, d):
    """What read evidence leaves of the surroundings of each site."""
    b = evidence(spark, d).select("chrom", F.col("pos").alias("start"), (F.col("pos") + F.greatest("op_len", F.lit(1))).alias("end")).distinct()
    a = sites(spark, d).select("chrom", "sv_id", (F.col("start") - 2000).alias("start"), (F.col("end") + 2000).alias("end")).distinct()
    return iv.subtract(a, b, ["chrom"]).select("chrom", "sv_id", "piece_start", "piece_end").distinct()


_PAIR = """, a AS (SELECT chrom, sv_id, "start", "end" FROM sites), b AS (SELECT DISTINCT chrom, pos, pos + 1 AS pos1, read_name, op_len FROM evidence)
SELECT a.chrom, a.sv_id, b.pos, b.read_name, b.op_len FROM a JOIN b ON a.chrom = b.chrom AND b.pos < a."end" + {w} AND b.pos1 > a."start" - {w}"""


@query(sql("sites", "evidence") + _PAIR.format(w=5000))
def j3_window_join(spark, d):
    a = sites(spark, d).select("chrom", "sv_id", "start", "end")
    b = evidence(spark, d).select("chrom", "pos", (F.col("pos") + 1).alias("pos1"), "read_name", "op_len").distinct()
    return iv.window_join(a, b, ["chrom"], ("start", "end"), ("pos", "pos1"), 5000).select("chrom", "sv_id", "pos", "read_name", "op_len")


@query(sql("sites") + """, a AS (SELECT chrom, te, sv_id, "start" AS s, "end" AS e FROM sites WHERE sv_type = 'INS'), b AS (SELECT chrom, te, sv_id AS other, "start" AS t, "end" AS u FROM sites WHERE sv_type <> 'INS')
SELECT a.chrom, a.te, sv_id, other FROM a JOIN b ON a.chrom = b.chrom AND a.te = b.te AND t < e + 3000 AND u > s - 3000""")
def j3_same_family_window(spark, d):
    s = sites(spark, d).select("chrom", "te", "sv_id", F.col("start").alias("s"), F.col("end").alias("e"), "sv_type")
    a = s.filter("sv_type = 'INS'").drop("sv_type")
    b = s.filter("sv_type <> 'INS'").select("chrom", "te", F.col("sv_id").alias("other"), F.col("s").alias("t"), F.col("e").alias("u"))
    return iv.window_join(a, b, ["chrom", "te"], ("s", "e"), ("t", "u"), 3000).select("chrom", "te", "sv_id", "other")


@query(sql("aligned", "sites") + ", a AS (SELECT DISTINCT rid AS chrom, qid, least(rstart, rend) AS lo, greatest(rstart, rend) AS hi FROM aligned), b AS (SELECT chrom, sv_id, \"start\" AS t, \"end\" AS u FROM sites)"
       "SELECT a.chrom, qid, lo, hi, sv_id, greatest(least(hi, u) - greatest(lo, t), 0) AS bases FROM a JOIN b ON a.chrom = b.chrom AND t < hi AND u > lo")
def j4_intersect_overlap(spark, d):
    a = stored_alignments(spark, d).select(F.col("rid").alias("chrom"), "qid", F.least("rstart", "rend").alias("lo"), F.greatest("rstart", "rend").alias("hi")).distinct()
    b = sites(spark, d).select("chrom", "sv_id", F.col("start").alias("t"), F.col("end").alias("u"))
    return iv.window_join(a, b, ["chrom"], ("lo", "hi"), ("t", "u")).withColumn("bases", iv.overlap("lo", "hi", "t", "u")).drop("t", "u")


_RESTRICT = """, a AS (SELECT *, pos + 1 AS pos1 FROM evidence)
SELECT chrom, pos, read_name, op_len, count_read FROM a WHERE {no} EXISTS (SELECT 1 FROM sites s WHERE s.chrom = a.chrom AND s."start" < a.pos1 + 5000 AND s."end" > a.pos - 5000)"""


def _near(spark, d, how):
    e = evidence(spark, d).withColumn("pos1", F.col("pos") + 1)
    return iv.window_join(e, sites(spark, d).select("chrom", "start", "end"), ["chrom"], ("pos", "pos1"), ("start", "end"), 5000, how).select("chrom", "pos", "read_name", "op_len", "count_read")


@query(sql("evidence", "sites") + _RESTRICT.format(no=""))
def j5_semi_interval_join(spark, d):
    return _near(spark, d, "left_semi")


@query(sql("evidence", "sites") + _RESTRICT.format(no="NOT"))
def j6_anti_interval_join(spark, d):
    return _near(spark, d, "left_anti")


@query(sql("sites", "aligned") + """, p AS (SELECT DISTINCT chrom, "start" AS at FROM sites), b AS (SELECT rid AS chrom, least(rstart, rend) AS s, greatest(rstart, rend) AS e FROM aligned)
SELECT p.chrom, p.at, count(b.s) AS depth FROM p LEFT JOIN b ON p.chrom = b.chrom AND b.s <= p.at AND b.e > p.at GROUP BY p.chrom, p.at""")
def i9_depth_at_points(spark, d):
    blocks = aligned(spark, d).select(F.col("rid").alias("chrom"), F.least("rstart", "rend").alias("s"), F.greatest("rstart", "rend").alias("e"))
    return iv.depth_at(sites(spark, d).select("chrom", F.col("start").alias("at")), blocks, ["chrom"], "at", ("s", "e"))


_SHIFT = """SELECT chrom, sv_id, "start", CAST("start" + coalesce(sum(size_te) OVER (PARTITION BY chrom ORDER BY "start", sv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS new_start FROM (SELECT DISTINCT chrom, sv_id, "start", size_te FROM sites WHERE size_te IS NOT NULL)"""


@query(sql("sites") + _SHIFT)
def i10_insert_with_offset(spark, d):
    s = sites(spark, d).select("chrom", "sv_id", "start", "size_te").distinct()
    return iv.running_offset(s, ["chrom"], "start", "size_te", ["sv_id"]).select("chrom", "sv_id", "start", "new_start")


@query(sql("sites") + """, c AS (SELECT DISTINCT chrom, te, "start", "end", sv_id FROM sites), """ + _clusters("c", "chrom", '"start"', '"end"', 100) + """,
l AS (SELECT *, lag(te) OVER (PARTITION BY chrom, cl ORDER BY "start", "end", te, sv_id) AS before FROM clustered)
SELECT chrom, "start", te, sv_id FROM l WHERE before IS NULL OR before <> te""")
def w4_consecutive_dedupe(spark, d):
    s = sites(spark, d).select("chrom", "te", "start", "end", "sv_id").distinct()
    c = iv.cluster(s, ["chrom"], "start", "end", 100)
    return iv.consecutive_dedupe(c, ["chrom", "cluster"], "te", ["start", "end", "te", "sv_id"]).select("chrom", "start", "te", "sv_id")


@query(sql("sites") + """, f AS (SELECT chrom, sv_id, 'L' AS side, greatest("start" - 30, 0) AS flank_start, "start" AS flank_end FROM sites UNION ALL SELECT chrom, sv_id, 'R', "end", "end" + 30 FROM sites)
SELECT f.chrom, sv_id, side, flank_start, least(flank_end, size_bp) AS flank_end FROM f JOIN chrom_sizes c ON f.chrom = c.chrom""")
def flank_windows(spark, d):
    sizes = table(spark, d, "chrom_sizes").withColumnRenamed("size_bp", "limit")
    return iv.flanks(sites(spark, d).join(sizes, "chrom"), "start", "end", 30, F.col("limit")).select("chrom", "sv_id", "side", "flank_start", "flank_end")


@query(sql("aligned") + """, o AS (SELECT *, lag(rend) OVER w AS r0, lag(qend) OVER w AS q0 FROM (SELECT DISTINCT rid, qid, least(rstart, rend) AS rstart, greatest(rstart, rend) AS rend, least(qstart, qend) AS qstart, greatest(qstart, qend) AS qend FROM aligned) WINDOW w AS (PARTITION BY rid, qid ORDER BY qstart, qend, rstart, rend))
SELECT rid, qid, least(r0, rstart) AS r_from, greatest(r0, rstart) AS r_to, least(q0, qstart) AS q_from, greatest(q0, qstart) AS q_to FROM o WHERE r0 IS NOT NULL""")
def i7_gap_pairs(spark, d):
    """Between consecutive alignments of a pair the gap on both axes."""
    from strandloom.operators.assembly import neighbours

    a = stored_alignments(spark, d).select("rid", "qid", F.least("rstart", "rend").alias("rstart"), F.greatest("rstart", "rend").alias("rend"), F.least("qstart", "qend").alias("qstart"), F.greatest("qstart", "qend").alias("qend")).distinct()
    n = neighbours(a, ["rid", "qid"], "qstart", ["qend", "rstart", "rend"], ["rend", "qend"])
    return n.filter("before.rend is not null").select("rid", "qid", F.least("before.rend", "rstart").alias("r_from"), F.greatest("before.rend", "rstart").alias("r_to"), F.least("before.qend", "qstart").alias("q_from"), F.greatest("before.qend", "qstart").alias("q_to"))


@query(sql("aligned") + """, a AS (SELECT rid, qid, rstart, rend, qstart, qend, least(qstart, qend) AS s, greatest(qstart, qend) AS e FROM (SELECT DISTINCT rid, qid, rstart, rend, qstart, qend FROM aligned) WHERE qstart <> qend),
ev AS (SELECT qid, s AS pt, 1 AS step FROM a UNION ALL SELECT qid, e, -1 FROM a), st AS (SELECT qid, pt, sum(step) AS step FROM ev GROUP BY qid, pt),
cov AS (SELECT qid, pt, sum(step) OVER (PARTITION BY qid ORDER BY pt) AS cover, lead(pt) OVER (PARTITION BY qid ORDER BY pt) AS after FROM st),
u AS (SELECT a.rid, a.qid, a.rstart, a.rend, a.qstart, a.qend, coalesce(sum(c.after - c.pt), 0) AS unique_length FROM a LEFT JOIN cov c ON c.qid = a.qid AND cover = 1 AND c.pt >= s AND c.after <= e GROUP BY ALL)
SELECT * REPLACE (CAST(unique_length AS BIGINT) AS unique_length), CASE WHEN unique_length >= 5000 THEN 'unique' ELSE 'repetitive' END AS tag FROM u""")
def i8_unique_anchors(spark, d):
    a = stored_alignments(spark, d).select("rid", "qid", "rstart", "rend", "qstart", "qend").distinct()
    a = a.withColumn("row", F.concat_ws(":", *a.columns))
    return iv.unique_anchors(a, "qid", "qstart", "qend", 5000, "row").drop("row")
