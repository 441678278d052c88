"""Probes from both ends: the answers of the full scan, and no more model calls than it takes."""

import random

import pytest
from pyspark.sql import functions as F

from framewright.operators import probing, series


def recordings(seed=2):
    rng = random.Random(seed)
    out = {}
    for k, n in enumerate([1, 2, 5, 9, 10, 11, 30, 61, 90, 200]):
        rate = rng.choice([0, 0.02, 0.3, 1])
        out[k] = [rng.random() < rate for _ in range(n)]
    return out


def frame(spark, table):
    rows = [(k, f"s{k % 2}", i, int(h)) for k, hits in table.items() for i, h in enumerate(hits)]
    return spark.createDataFrame(rows, "k long, source string, i long, v int").repartition(3)


def calls_by_hand(hits, stride, most):
    n, total = len(hits), 0
    for places in (range(0, n, stride), range(n - 1, -1, -stride)):
        for p in list(places)[:most]:
            total += 1
            if hits[p]:
                break
    return total


@pytest.mark.parametrize(("stride", "most", "miss"), [(1, 300, "none"), (3, 5, "all"), (30, 300, "none")])
def test_answers_and_calls(spark, stride, most, miss):
    table = recordings()
    df = frame(spark, table)
    calls = spark.sparkContext.accumulator(0)

    def build():
        def detect(frames):
            calls.add(len(frames))
            return [v == 1 for v in frames]

        return detect

    got = probing.probe_ends(df, ["k", "source"], probing.per_batch(build, "v"), stride, most, miss)
    want = series.first_last_hit(df.withColumn("hit", F.col("v") == 1), ["k", "source"], stride=stride, most=most, miss=miss)
    assert sorted(map(tuple, got.drop("n_probed").collect())) == sorted(map(tuple, want.collect()))
    by_hand = {k: calls_by_hand(h, stride, most) for k, h in table.items()}
    assert {r.k: r.n_probed for r in got.collect()} == by_hand
    assert calls.value == sum(by_hand.values())


def test_columns_as_a_model_and_batches(spark):
    table = recordings(5)
    df = frame(spark, table)
    plain = probing.probe_ends(df, ["k"], lambda rows: rows.withColumn("hit", F.col("v") == 1), stride=2)
    threes = probing.probe_ends(df, ["k"], probing.per_batch(lambda: lambda frames: [v == 1 for v in frames], "v", batch=3), stride=2, first_batch=4)
    want = sorted(map(tuple, series.first_last_hit(df.withColumn("hit", F.col("v") == 1), ["k"], stride=2).collect()))
    for got in (plain, threes):
        assert sorted(map(tuple, got.drop("n_probed").collect())) == want
    assert all(r.n_probed >= calls_by_hand(table[r.k], 2, 300) for r in threes.collect())


def test_no_series(spark):
    df = frame(spark, {1: [True]}).where("false")
    assert probing.probe_ends(df, ["k"], lambda rows: rows.withColumn("hit", F.col("v") == 1)).collect() == []
