"""Long recordings: buckets of any size give the results of one window, and a recording with a third of all rows is the work of all tasks."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from framewright.operators import series

WIDE = 1 << 16


def rows_of(spark, seed=3):
    rng = random.Random(seed)
    rows = []
    for k, n in enumerate([0, 1, 2, 4, 5, 6, 7, 8, 11, 12, 13, 14, 21, 22, 40, 97]):
        dirty = rng.choice([0.1, 0.5, 0.95, 1.0])
        rows += [(k, i, rng.randrange(4) * 60, rng.random() < dirty, int(rng.random() < 0.25)) for i in range(n)]
    return spark.createDataFrame(rows, "k long, i long, v long, m boolean, sign int").repartition(3)


CASES = {
    "median": lambda df, b: series.temporal_median(df, ["k"], bucket=b),
    "median of 3": lambda df, b: series.temporal_median(df, ["k"], window=3, bucket=b),
    "own windows": lambda df, b: series.temporal_median(df, ["k"], window=11, own_window=2 * (F.col("k") % 6).cast("int") + 1, bucket=b),
    "clean": lambda df, b: series.last_clean_fill(df, ["k"], seed=F.lit(9), bucket=b),
    "previous": lambda df, b: series.with_previous(df, ["k"], "v", "before", bucket=b),
    "still": lambda df, b: series.still_runs(df, ["k"], bucket=b),
    "max": lambda df, b: series.window_max(df, ["k"], "v", past=5, future=3, bucket=b),
    "max of the past": lambda df, b: series.window_max(df, ["k"], "v", past=5, future=1, bucket=b),
    "band": lambda df, b: series.band_difference(df, ["k"], past=6, future=2, threshold=5, bucket=b),
    "neighbours": lambda df, b: series.clean_neighbours(df, ["k"], bucket=b),
}


@pytest.mark.parametrize("name", CASES)
def test_any_bucket(spark, name):
    df = rows_of(spark)
    whole = sorted(map(tuple, CASES[name](df, WIDE).collect()), key=repr)
    for b in (1, 4, 7):
        got = CASES[name](df, b)
        assert got.columns == CASES[name](df, WIDE).columns
        assert sorted(map(tuple, got.collect()), key=repr) == whole


def test_own_windows_are_the_windows(spark):
    df = rows_of(spark)
    mixed = series.temporal_median(df, ["k"], window=11, own_window=2 * (F.col("k") % 6).cast("int") + 1, bucket=4)
    for w in (1, 3, 5, 7, 9, 11):
        own = mixed.where(F.col("k") % 6 == (w - 1) // 2)
        want = series.temporal_median(df.where(F.col("k") % 6 == (w - 1) // 2), ["k"], window=w)
        assert sorted(map(tuple, own.collect())) == sorted(map(tuple, want.collect()))


def hot_events(spark):
    """One user has a third of all rows."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"), (F.col("id") * 7919 % 30_011).alias("t"), "id", (F.col("id") % 256).alias("v"), (F.col("id") % 5 == 0).alias("m")
    )


def test_places_by_lots(spark):
    df = hot_events(spark)
    plain = series.indexed(df, ["k"], ["t", "id"])
    lots = series.indexed(df, ["k"], ["t", "id"], lot=F.floor(F.col("t") / 500))
    assert lots.columns == plain.columns
    assert lots.exceptAll(plain).count() == 0 and lots.count() == 30_000


def share(df):
    """The largest task's share of the rows."""

    def size(batches):
        yield pa.RecordBatch.from_arrays([pa.array([sum(b.num_rows for b in batches)])], ["n"])

    sizes = [r.n for r in df.mapInArrow(size, "n long").collect()]
    return max(sizes) / sum(sizes)


def test_a_hot_recording_is_spread(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, ("40", "false", "-1"), strict=True):
            spark.conf.set(k, v)
        df = hot_events(spark)
        placed = series.indexed(df, ["k"], ["t", "id"], lot=F.floor(F.col("t") / 500)).select("k", "i", "v", "m")
        assert share(series.indexed(df, ["k"], ["t", "id"])) > 0.3
        assert share(placed) < 0.1
        for out in (
            series.temporal_median(placed, ["k"], bucket=256), series.last_clean_fill(placed, ["k"], bucket=256), series.band_difference(placed, ["k"], bucket=256), series.clean_neighbours(placed, ["k"], bucket=256),
            series.with_previous(placed, ["k"], "v", "before", bucket=256),
        ):
            assert share(out) < 0.1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
