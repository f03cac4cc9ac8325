"""Sessions of a stream and of the same table."""

from datetime import datetime

from conftest import rows

from strandloom.streaming.sessions import gap_sessions


def test_sessions_of_a_stream(spark, tmp_path):
    data = [("a", datetime(2024, 1, 1, 0, m)) for m in (0, 5, 30, 31)] + [("b", datetime(2024, 1, 1, 0, 2)), ("b", None), ("z", datetime(2024, 1, 2))]
    df = spark.createDataFrame(data, "k string, ts timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    batch = rows(gap_sessions(spark.read.parquet(str(tmp_path / "in")), ["k"], "ts", "10 minutes", "1 minute"))
    assert [(r[0], r[3]) for r in batch] == [("a", 2), ("a", 2), ("b", 1), ("z", 1)]
    stream = gap_sessions(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), ["k"], "ts", "10 minutes", "1 minute")
    q = stream.writeStream.format("memory").queryName("sessions").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [r for r in batch if r[0] != "z"] == rows(spark.table("sessions"))
