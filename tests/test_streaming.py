from pyspark.sql import functions as F

from framewright.streaming.arrivals import activity_sessions, clean_fill_stream, read_arrivals


def test_clean_fill_across_batches(spark, tmp_path):
    src = str(tmp_path / "in")
    schema = "k long, i long, v long, m boolean"
    spark.createDataFrame([(1, 0, 10, False), (1, 1, 20, True)], schema).coalesce(1).write.mode("append").parquet(src)
    out = clean_fill_stream(read_arrivals(spark, src, schema).coalesce(1))
    q = out.writeStream.format("memory").queryName("filled").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
        spark.createDataFrame([(1, 2, 30, True), (2, 0, 5, True)], schema).coalesce(1).write.mode("append").parquet(src)
        q.processAllAvailable()
        got = sorted(tuple(r) for r in spark.table("filled").collect())
    finally:
        q.stop()
    assert got == [(1, 0, 10), (1, 1, 10), (1, 2, 10), (2, 0, 0)]


def test_sessions(spark):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:10:00"), (1, "2024-01-01 02:00:00")]
    events = spark.createDataFrame(rows, "user_id long, ts string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r["n"] for r in activity_sessions(events).collect()) == [1, 2]
