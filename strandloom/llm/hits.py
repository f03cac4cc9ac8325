"""Queries p2 and p3 over the hit table, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm.runs import runs
from strandloom.llm.topn import top_n
from strandloom.operators.eager import present
from strandloom.session import table


def _stretches(spark: SparkSession, sf_dir: str, least: int = 1, penalty: int = 10, cost: str = "steps") -> DataFrame:
    hits = table(spark, sf_dir, "blast_hits").filter(present("qseqid") & present("sseqid"))
    return runs(hits, "qseqid", "line_no", ["sseqid", F.col("sstart") <= F.col("send")], ["sstart", "send"], penalty=penalty, least=least, cost=cost)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stretches(spark, sf_dir, least=2).select(F.col("entity").alias("qseqid"), F.col("first").alias("first_line_no"), F.col("last").alias("last_line_no"))


def p2_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch once, single hits too: number of hits, length on the family and in the file."""
    return _lengths(_stretches(spark, sf_dir))


def p2_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with stretches whose hits lie near the mean of the stretch: squared differences, 400 for a boundary."""
    return _lengths(_stretches(spark, sf_dir, penalty=400, cost="spread"))


def _lengths(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("entity").alias("qseqid"), F.col("kind0").alias("sseqid"), F.when(F.col("kind1") == "true", "+").otherwise("-").alias("strand"),
        F.col("first").alias("first_line_no"), F.col("n_events").alias("n_hits"), (F.greatest("hi_sstart", "hi_send") - F.least("lo_sstart", "lo_send") + 1).alias("family_length"),
        (F.col("last") - F.col("first") + 1).alias("file_length"),
    )


def _best(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    hits = table(spark, sf_dir, "blast_hits").filter(present("qseqid") & present("sseqid") & F.col("line_no").isNotNull() & ~F.isnan("bitscore") & (F.col("bitscore") >= 0)).select("qseqid", "sseqid", "bitscore", "line_no")
    return top_n(hits, ["qseqid"], [("bitscore", True), ("sseqid", False), ("line_no", False)], n, F.floor(F.col("line_no") / 4096))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best(spark, sf_dir, 3).select("qseqid", "line_no").dropDuplicates(["qseqid", "line_no"])


def p3_best_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best(spark, sf_dir, 3).select("qseqid", "place", "line_no", "sseqid", "bitscore")


QUERIES = {f.__name__: f for f in (p2_found, p2_stretches, p2_segments, p3_found, p3_best_hits)}

_RUNS = """WITH hits AS (SELECT DISTINCT qseqid, sseqid, sstart, send, line_no FROM blast_hits
  WHERE qseqid NOT IN ('.', 'NONE') AND sseqid NOT IN ('.', 'NONE') AND sstart IS NOT NULL AND send IS NOT NULL AND line_no IS NOT NULL),
pairs AS (SELECT *, lag(sseqid) OVER w = sseqid AND (lag(sstart) OVER w <= lag(send) OVER w) = (sstart <= send) AND abs(lag(sstart) OVER w - sstart) <= 10 AND abs(lag(send) OVER w - send) <= 10 AS goes_on
  FROM hits WINDOW w AS (PARTITION BY qseqid ORDER BY line_no)),
numbered AS (SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY qseqid ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS n FROM pairs)
"""
_RANKED = """WITH hits AS (SELECT DISTINCT qseqid, sseqid, bitscore, line_no FROM blast_hits
  WHERE qseqid NOT IN ('.', 'NONE') AND sseqid NOT IN ('.', 'NONE') AND NOT isnan(bitscore) AND bitscore >= 0 AND line_no IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qseqid ORDER BY bitscore DESC, sseqid, line_no) AS place FROM hits)
"""
SQL = {
    "p2_found": _RUNS + "SELECT qseqid, min(line_no) AS first_line_no, max(line_no) AS last_line_no FROM numbered GROUP BY qseqid, n HAVING count(*) > 1",
    "p2_stretches": _RUNS + """SELECT qseqid, min(sseqid) AS sseqid, CASE WHEN bool_and(sstart <= send) THEN '+' ELSE '-' END AS strand, min(line_no) AS first_line_no, count(*) AS n_hits,
  max(greatest(sstart, send)) - min(least(sstart, send)) + 1 AS family_length, max(line_no) - min(line_no) + 1 AS file_length FROM numbered GROUP BY qseqid, n""",
    "p3_found": _RANKED + "SELECT qseqid, line_no FROM ranked WHERE place <= 3",
    "p3_best_hits": _RANKED + "SELECT qseqid, place, line_no, sseqid, bitscore FROM ranked WHERE place <= 3",
}
