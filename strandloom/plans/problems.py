"""Queries of the general problems p1, p4 and p5 over the project's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.operators import eager, periods, shred
from strandloom.session import table

MISSING = "NULL or '.' or 'NONE'"
KEYED = (("blast_hits", "sseqid"), ("te_infos", "chrom"), ("ins_evidence", "chrom"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = None
    for name, key in KEYED:
        part = table(spark, sf_dir, name).select(F.lit(name).alias("table_name"), F.lit(key).alias("key_field"), F.col(key).alias("key_value"))
        rows = part if rows is None else rows.unionByName(part)
    return eager.heavy_keys(rows, ["table_name", "key_field"], "key_value", 5).drop("n_rows")


def p1_chrom_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates of te_infos joined with ins_evidence on chrom, without the join's rows."""
    infos, evidence = table(spark, sf_dir, "te_infos"), table(spark, sf_dir, "ins_evidence")
    left = eager.compact(infos.filter(eager.present("chrom")), ["chrom"], sums={"sum_new_pos": "new_pos"}, mins={"min_start": "start_pos"})
    right = eager.compact(evidence.filter(eager.present("chrom")), ["chrom"], sums={"sum_op_len": "op_len"}, maxs={"max_op_len": "op_len"})
    out = eager.join_states(left, right, ["chrom"], left_sums=["sum_new_pos"], right_sums=["sum_op_len"])
    return out.select("chrom", *[F.col(c).cast("bigint").alias(c) for c in ("n_pairs", "sum_new_pos", "sum_op_len", "min_start", "max_op_len")])


def p1_type_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites joined with read evidence on chrom, by kind of site and size class of evidence: pairs, and sums of either side.

    Each side is reduced to states by chrom and its own column; after the join the chromosomes are rolled up.
    """
    infos, evidence = table(spark, sf_dir, "te_infos"), table(spark, sf_dir, "ins_evidence")
    left = eager.compact(infos.filter(eager.present("chrom") & F.col("sv_type").isNotNull()), ["chrom", "sv_type"], sums={"sum_new_pos": "new_pos"}, mins={"min_start": "start_pos"})
    right = eager.compact(evidence.filter(eager.present("chrom") & F.col("op_len").isNotNull()).withColumn("size_class", F.expr("op_len div 500")), ["chrom", "size_class"], sums={"sum_op_len": "op_len"}, maxs={"max_op_len": "op_len"})
    joined = eager.join_states(left, right, ["chrom"], left_sums=["sum_new_pos"], right_sums=["sum_op_len"], products={"sum_products": ("sum_new_pos", "sum_op_len")})
    out = eager.rollup(joined, ["sv_type", "size_class"], sums=["n_pairs", "sum_new_pos", "sum_op_len", "sum_products"], mins=["min_start"], maxs=["max_op_len"])
    return out.select("sv_type", "size_class", *[F.col(c).cast("bigint").alias(c) for c in ("n_pairs", "sum_new_pos", "sum_op_len", "min_start", "max_op_len")], F.col("sum_products").cast("string").alias("sum_products"))


def p1_family_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits, aligned bases and query bases of every family that te_sizes knows, with bases over the family's size."""
    hits, sizes = table(spark, sf_dir, "blast_hits"), table(spark, sf_dir, "te_sizes")
    left = eager.compact(hits.filter(eager.present("sseqid")).withColumnRenamed("sseqid", "te_name"), ["te_name"], sums={"aligned": "aln_len", "query_bases": F.abs(F.col("qend") - F.col("qstart"))})
    right = eager.compact(sizes, ["te_name"], sums={"te_size": "size_bp"})
    out = eager.join_states(left, right, ["te_name"], left_sums=["aligned", "query_bases"])
    return out.select("te_name", F.col("n_pairs").cast("bigint").alias("hits"), F.col("aligned").cast("bigint").alias("aligned"), F.col("query_bases").cast("bigint").alias("query_bases"), F.expr("cast(aligned as bigint) div cast(te_size as bigint)").alias("copies"))


P4_GROUPS, P4_WRAPPERS = ("data", "data.positions"), ("result",)
P4_HSP = {"sstart": "bigint", "send": "bigint", "qstart": "bigint", "qend": "bigint", "strand": "bigint", "mismatch": "bigint", "gapopen": "bigint", "evalue": "double", "bitscore": "bigint", "pident": "double", "subject_seq_size": "bigint", "query_seq_size": "bigint", "no_match_start": "bigint", "no_match_send": "bigint"}
P4_ARRAYS = ("no_match_size", "posq", "size", "rest_size")


def _chunks(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    docs = shred.latest(table(spark, sf_dir, "viewer_docs"), "rec_id", "received_at", "body")
    return shred.shred(docs, "rec_id", "body", P4_GROUPS, P4_WRAPPERS, columns)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(spark, sf_dir, ["data[].#", "data[].positions[].#"])
    return shred.assemble(chunks, "rec_id", "data[].positions[]", places=["data_ix", "pos_ix"])


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each record: its latest row, with the number of groups in it."""
    docs = shred.latest(table(spark, sf_dir, "viewer_docs"), "rec_id", "received_at", "body", ["sample_code", "received_at"])
    chunks = shred.shred(docs, "rec_id", "body", P4_GROUPS, P4_WRAPPERS, ["data[].#"])
    counts = shred.assemble(chunks, "rec_id", "data[]", places=["data_ix"]).groupBy("rec_id").agg(F.count(F.lit(1)).alias("n_groups"))
    return docs.drop("body").join(counts, "rec_id", "left").select("rec_id", "sample_code", "received_at", F.coalesce("n_groups", F.lit(0)).alias("n_groups"))


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"qseqid": "string", "sseqid": "string", "chrom": "string", "start": "bigint"}
    return shred.assemble(_chunks(spark, sf_dir, ["data[].#", *[f"data[].{f}" for f in fields]]), "rec_id", "data[]", fields, ["data_ix"])


def p4_hsps(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["data[].#", "data[].positions[].#", *[f"data[].positions[].{f}" for f in P4_HSP]]
    return shred.assemble(_chunks(spark, sf_dir, columns), "rec_id", "data[].positions[]", P4_HSP, ["data_ix", "pos_ix"])


def p4_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["data[].#", "data[].positions[].#", *[f"data[].positions[].{f}{end}" for f in P4_ARRAYS for end in ("[]", "[].#")]]
    return shred.assemble_values(_chunks(spark, sf_dir, columns), "rec_id", "data[].positions[]", P4_ARRAYS, ["data_ix", "pos_ix"])


P5_AXES = {"r": ("rstart", "rend"), "q": ("qstart", "qend")}


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    intervals = periods.axis_intervals(table(spark, sf_dir, "alignments"), ["rid", "qid"], P5_AXES)
    return periods.periods_and_gaps(intervals, ["rid", "qid", "axis"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir).select("axis", "kind", "rid", "qid", "seg_start", "seg_end")


def p5_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covered and missing length of every pair on every axis."""
    n = lambda kind, c: F.sum(F.when(F.col("kind") == kind, c).otherwise(0)).cast("bigint")
    size = F.col("seg_end") - F.col("seg_start")
    return _segments(spark, sf_dir).groupBy("axis", "rid", "qid").agg(n("period", size).alias("covered"), n("gap", size).alias("missing"), n("period", F.lit(1)).alias("periods"), n("gap", F.lit(1)).alias("gaps"))


QUERIES = {f.__name__: f for f in (p1_found, p1_chrom_pairs, p1_type_pairs, p1_family_load, p4_found, p4_records, p4_groups, p4_hsps, p4_values, p5_found, p5_coverage)}

_HEAVY = """SELECT '{t}' AS table_name, '{k}' AS key_field, {k} AS key_value FROM {t} WHERE {k} NOT IN ('.', 'NONE')
  GROUP BY {k} HAVING count(*) * 100 >= 5 * (SELECT count(*) FROM {t} WHERE {k} NOT IN ('.', 'NONE'))"""

_SEGMENTS = """WITH sides AS (
  SELECT 'r' AS axis, rid, qid, least(rstart, rend) AS lo, greatest(rstart, rend) AS hi FROM alignments WHERE rid IS NOT NULL AND qid IS NOT NULL AND rstart <> rend
  UNION ALL SELECT 'q', rid, qid, least(qstart, qend), greatest(qstart, qend) FROM alignments WHERE rid IS NOT NULL AND qid IS NOT NULL AND qstart <> qend),
reach AS (SELECT *, max(hi) OVER (PARTITION BY axis, rid, qid ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM sides),
numbered AS (SELECT *, sum(CASE WHEN before IS NULL OR lo > before THEN 1 ELSE 0 END) OVER (PARTITION BY axis, rid, qid ORDER BY lo, hi) AS n FROM reach),
per AS (SELECT axis, rid, qid, min(lo) AS seg_start, max(hi) AS seg_end FROM numbered GROUP BY axis, rid, qid, n),
segments AS (SELECT axis, 'period' AS kind, rid, qid, seg_start, seg_end FROM per UNION ALL
  SELECT axis, 'gap', rid, qid, seg_end, nxt FROM (SELECT *, lead(seg_start) OVER (PARTITION BY axis, rid, qid ORDER BY seg_start) AS nxt FROM per) WHERE nxt IS NOT NULL)
"""

_LATEST = """WITH last AS (SELECT rec_id, max(received_at) AS received_at FROM viewer_docs GROUP BY rec_id),
bodies AS (SELECT DISTINCT d.rec_id, d.body FROM viewer_docs d JOIN last l ON d.rec_id = l.rec_id AND d.received_at = l.received_at WHERE json_valid(d.body)),
tops AS (SELECT rec_id, CASE WHEN json_type(body::JSON) = 'VARCHAR' THEN (body::JSON ->> '$')::JSON ELSE body::JSON END AS j FROM bodies),
datas AS (SELECT rec_id, coalesce(CASE WHEN json_type(j, '$.data') <> 'NULL' THEN j -> '$.data' END, j -> '$.result.data') AS d FROM tops),
lists AS (SELECT rec_id, CASE json_type(d) WHEN 'ARRAY' THEN from_json(d, '["JSON"]') WHEN 'OBJECT' THEN [d] END AS l FROM datas),
grps AS (SELECT rec_id, i - 1 AS data_ix, l[i] AS g FROM lists, unnest(range(1, len(l) + 1)) AS u(i) WHERE json_type(l[i]) = 'OBJECT'),
raw AS (SELECT rec_id, data_ix, CASE WHEN json_type(g -> '$.positions') = 'VARCHAR' THEN (g ->> '$.positions')::JSON ELSE g -> '$.positions' END AS p FROM grps),
places AS (SELECT rec_id, data_ix, CASE WHEN json_type(p) = 'ARRAY' THEN range(0, json_array_length(p)::BIGINT)
    WHEN json_type(p) = 'OBJECT' AND regexp_full_match(array_to_string(json_keys(p), ''), '[0-9]+') THEN list_transform(json_keys(p), lambda k: k::BIGINT)
    WHEN json_type(p) = 'OBJECT' AND len(json_keys(p)) > 0 THEN [0::BIGINT] END AS spots, p,
    CASE WHEN json_type(p) = 'OBJECT' AND NOT regexp_full_match(array_to_string(json_keys(p), ''), '[0-9]+') THEN 'one' WHEN json_type(p) = 'OBJECT' THEN 'keyed' ELSE 'list' END AS shape FROM raw),
hsps AS (SELECT rec_id, data_ix, k AS pos_ix, CASE shape WHEN 'one' THEN p WHEN 'keyed' THEN json_extract(p, '$."' || k || '"') ELSE json_extract(p, '$[' || k || ']') END AS h FROM places, unnest(spots) AS u(k)),
objects AS (SELECT * FROM hsps WHERE json_type(h) = 'OBJECT')
"""
_CAST = {"bigint": "TRY_CAST(h ->> '$.{f}' AS BIGINT)", "double": "TRY_CAST(h ->> '$.{f}' AS DOUBLE)"}

SQL = {
    "p1_found": "\nUNION ALL ".join(_HEAVY.format(t=t, k=k) for t, k in KEYED),
    "p1_chrom_pairs": """SELECT a.chrom, count(*) AS n_pairs, CAST(coalesce(sum(new_pos), 0) AS BIGINT) AS sum_new_pos, CAST(coalesce(sum(op_len), 0) AS BIGINT) AS sum_op_len, min(start_pos) AS min_start, max(op_len) AS max_op_len
  FROM te_infos a JOIN ins_evidence b ON a.chrom = b.chrom WHERE a.chrom NOT IN ('.', 'NONE') GROUP BY a.chrom""",
    "p1_type_pairs": """WITH a AS (SELECT chrom, sv_type, new_pos, start_pos FROM te_infos WHERE chrom NOT IN ('.', 'NONE') AND sv_type IS NOT NULL), b AS (SELECT chrom, op_len // 500 AS size_class, op_len FROM ins_evidence WHERE chrom NOT IN ('.', 'NONE') AND op_len IS NOT NULL),
  x AS (SELECT chrom, sv_type, count(*)::HUGEINT AS n, coalesce(sum(new_pos), 0)::HUGEINT AS s, min(start_pos) AS m FROM a GROUP BY ALL), y AS (SELECT chrom, size_class, count(*)::HUGEINT AS n, sum(op_len)::HUGEINT AS s, max(op_len) AS m FROM b GROUP BY ALL)
  SELECT sv_type, size_class, sum(x.n * y.n)::BIGINT AS n_pairs, sum(x.s * y.n)::BIGINT AS sum_new_pos, sum(y.s * x.n)::BIGINT AS sum_op_len, min(x.m) AS min_start, max(y.m) AS max_op_len, sum(x.s * y.s)::VARCHAR AS sum_products FROM x JOIN y USING (chrom) GROUP BY ALL""",
    "p1_family_load": """SELECT te_name, count(*) AS hits, CAST(coalesce(sum(aln_len), 0) AS BIGINT) AS aligned, CAST(coalesce(sum(abs(qend - qstart)), 0) AS BIGINT) AS query_bases, CAST(coalesce(sum(aln_len), 0) AS BIGINT) // any_value(size_bp) AS copies
  FROM blast_hits JOIN te_sizes ON sseqid = te_name GROUP BY te_name""",
    "p4_found": _LATEST + "SELECT rec_id, data_ix, pos_ix FROM objects",
    "p4_records": _LATEST + """, counts AS (SELECT rec_id, count(*) AS n_groups FROM grps GROUP BY rec_id)
  SELECT d.rec_id, max(sample_code) AS sample_code, any_value(l.received_at) AS received_at, coalesce(any_value(n_groups), 0) AS n_groups
  FROM viewer_docs d JOIN last l ON d.rec_id = l.rec_id AND d.received_at = l.received_at LEFT JOIN counts c ON c.rec_id = d.rec_id GROUP BY d.rec_id""",
    "p4_groups": _LATEST + """SELECT rec_id, data_ix, g ->> '$.qseqid' AS qseqid, g ->> '$.sseqid' AS sseqid, g ->> '$.chrom' AS chrom, TRY_CAST(g ->> '$.start' AS BIGINT) AS start FROM grps""",
    "p4_hsps": _LATEST + "SELECT rec_id, data_ix, pos_ix, " + ", ".join(_CAST[k].format(f=f) + f" AS {f}" for f, k in P4_HSP.items()) + " FROM objects",
    "p4_values": _LATEST + "\nUNION ALL ".join(f"SELECT rec_id, data_ix, pos_ix, '{f}' AS field, i AS value_ix, h ->> ('$.{f}[' || i || ']') AS value FROM objects, unnest(range(0, json_array_length(h, '$.{f}')::BIGINT)) AS u(i) WHERE json_type(h, '$.{f}') = 'ARRAY' AND h ->> ('$.{f}[' || i || ']') IS NOT NULL" for f in P4_ARRAYS),
    "p5_found": _SEGMENTS + "SELECT * FROM segments",
    "p5_coverage": _SEGMENTS + """SELECT axis, rid, qid, CAST(sum(CASE kind WHEN 'period' THEN seg_end - seg_start ELSE 0 END) AS BIGINT) AS covered, CAST(sum(CASE kind WHEN 'gap' THEN seg_end - seg_start ELSE 0 END) AS BIGINT) AS missing,
  CAST(sum(CASE kind WHEN 'period' THEN 1 ELSE 0 END) AS BIGINT) AS periods, CAST(sum(CASE kind WHEN 'gap' THEN 1 ELSE 0 END) AS BIGINT) AS gaps FROM segments GROUP BY axis, rid, qid""",
}
