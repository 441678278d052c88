"""Shuffled arrivals give the batch result, over micro-batches that are each taken up from a checkpoint."""

import random

import pytest
from pyspark.sql import functions as F

from framewright.operators import series
from framewright.streaming import ordered
from framewright.streaming.arrivals import read_arrivals

SCHEMA = "k long, i long, v long, m boolean"


def recordings(seed=3):
    rng = random.Random(seed)
    return [(k, i, rng.randrange(256), rng.random() < 0.4) for k, n in enumerate([1, 2, 11, 12, 13, 30]) for i in range(n)]


def arrive(spark, src, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)


def run(df, tmp_path):
    """One micro-batch over what has come, taken up from the last one's checkpoint."""
    ordered.drain(df, str(tmp_path / "out"), str(tmp_path / "cp"), seconds=60)


def found(spark, tmp_path):
    return spark.read.parquet(str(tmp_path / "out"))


def shuffled(rows, parts, seed=1):
    rows = [*rows, *rows[: len(rows) // 3]]  # some come twice
    random.Random(seed).shuffle(rows)
    return [rows[n::parts] for n in range(parts)]


def test_clean_fill(spark, tmp_path):
    rows, src = recordings(), str(tmp_path / "in")
    for lot in shuffled(rows, 3):
        arrive(spark, src, lot)
        run(ordered.clean_fill_ordered(read_arrivals(spark, src, SCHEMA), seed=9), tmp_path)
    want = series.last_clean_fill(spark.createDataFrame(rows, SCHEMA), ["k"], seed=F.lit(9)).select("k", "i", "clean_v")
    assert sorted(map(tuple, found(spark, tmp_path).collect())) == sorted(map(tuple, want.collect()))


def test_median(spark, tmp_path):
    rows = [(k, i, v, False) for k, i, v, _ in recordings()]
    ends = [(k, max(i for kk, i, *_ in rows if kk == k) + 1, 0, True) for k in {r[0] for r in rows}]
    src = str(tmp_path / "in")
    for lot in shuffled(rows + ends, 3):
        arrive(spark, src, lot)
        run(ordered.median_ordered(read_arrivals(spark, src, SCHEMA)), tmp_path)
    want = series.temporal_median(spark.createDataFrame(rows, SCHEMA), ["k"]).select("k", "i", "median_v")
    assert sorted(map(tuple, found(spark, tmp_path).collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError, match="odd"):
        ordered.median_ordered(spark.createDataFrame(rows, SCHEMA), window=4)


def test_a_gap_is_given_up(spark, tmp_path):
    src = str(tmp_path / "in")
    for lot in ([(1, 0, 5, False), (1, 3, 7, True), (1, 4, 8, False)], [(2, 0, 1, False)], [(1, 1, 9, False)]):  # the last one is too late
        arrive(spark, src, lot)
        run(ordered.clean_fill_ordered(read_arrivals(spark, src, SCHEMA), patience_ms=1), tmp_path)
    assert sorted(map(tuple, found(spark, tmp_path).where("k = 1").collect())) == [(1, 0, 5), (1, 3, 5), (1, 4, 8)]


def test_registration(spark, tmp_path):
    src, schema = str(tmp_path / "in"), "source string, video_id string, title string, arrived timestamp"
    first = [("y", "a", "1", "2024-01-01 00:00:00"), ("y", "a", "1", "2024-01-01 00:00:01"), ("y", "", "2", "2024-01-01 00:00:00"), ("y", None, "2", "2024-01-01 00:00:00")]
    for rows in (first, [("y", "a", "1", "2024-01-02 00:00:00"), ("z", "a", "3", "2024-01-02 00:00:00")]):
        df = spark.createDataFrame(rows, "source string, video_id string, title string, arrived string")
        df.withColumn("arrived", F.to_timestamp("arrived")).coalesce(1).write.mode("append").parquet(src)
        run(ordered.register_stream(read_arrivals(spark, src, schema)), tmp_path)
    assert sorted((r.source, r.video_id, r.processed) for r in found(spark, tmp_path).collect()) == [("y", "a", False), ("z", "a", False)]
