"""Ordered operators against plain Python restatements."""

import random
from itertools import product
from statistics import median

import pytest
from pyspark.sql import functions as F

from framewright.operators import series


def rows_of(spark, table: dict[int, list], columns="k long, i long, v long, m boolean, hit boolean"):
    rows = [(k, i, *row) for k, values in table.items() for i, row in enumerate(values)]
    return spark.createDataFrame(rows, columns)


def by_key(df, column):
    out = {}
    for r in df.orderBy("k", "i").collect():
        out.setdefault(r["k"], []).append(r[column])
    return out


def random_series(seed=7, n=25):
    rng = random.Random(seed)
    return {k: [(rng.randrange(256), rng.random() < 0.4, rng.random() < 0.1) for _ in range(rng.choice([1, 2, 5, 11, 12, 13, 40]))] for k in range(n)}


def test_temporal_median(spark):
    table = random_series()
    got = by_key(series.temporal_median(rows_of(spark, table), ["k"]), "median_v")
    for k, values in table.items():
        v, n = [x[0] for x in values], len(values)
        want = v if n <= 11 else [median(v[i - r : i + r + 1]) for i in range(n) for r in [min(i, n - 1 - i, 5)]]
        assert got[k] == want
    with pytest.raises(ValueError):
        series.temporal_median(rows_of(spark, table), ["k"], window=10)


def test_last_clean_fill(spark):
    table = random_series(8)
    got = by_key(series.last_clean_fill(rows_of(spark, table), ["k"], seed=F.lit(9)), "clean_v")
    for k, values in table.items():
        last, want = 9, []
        for v, m, _ in values:
            last = last if m else v
            want.append(last)
        assert got[k] == want


def runs_by_hand(sign, least=3):
    out, a = [], None
    for i, s in enumerate([*sign, 1]):
        if s == 0 and a is None:
            a = i
        if s == 1 and a is not None:
            if i - a >= least and len(sign) >= least + 2:
                out.append((a, i - 1 - least + 2))
            a = None
    return out


def test_still_runs_on_all_short_arrays(spark):
    arrays = [(0, *rest) for n in range(0, 9) for rest in product((0, 1), repeat=n)]
    df = rows_of(spark, {k: [(s,) for s in a] for k, a in enumerate(arrays)}, "k long, i long, sign int")
    got = {}
    for r in series.still_runs(df, ["k"]).orderBy("k", "start_idx").collect():
        got.setdefault(r["k"], []).append((r["start_idx"], r["end_idx"]))
    assert got == {k: runs for k, a in enumerate(arrays) if (runs := runs_by_hand(a))}


@pytest.mark.parametrize(
    ("sign", "want"),
    [("00000000", [(0, 6)]), ("00000100000", [(0, 3), (6, 9)]), ("010000011000000", [(2, 5), (9, 13)]), ("0001000100", [(0, 1), (4, 5)]), ("0010000", [(3, 5)]), ("111111", [])],
)
def test_still_runs_cases(spark, sign, want):
    df = rows_of(spark, {0: [(int(c),) for c in sign]}, "k long, i long, sign int")
    assert sorted((r["start_idx"], r["end_idx"]) for r in series.still_runs(df, ["k"]).collect()) == want


def test_first_last_hit(spark):
    table = {1: [(0, False, i in (6, 14)) for i in range(20)], 2: [(0, False, False)] * 4}
    got = {r["k"]: (r["start_idx"], r["end_idx"]) for r in series.first_last_hit(rows_of(spark, table), ["k"], stride=3).collect()}
    assert got == {1: (6, -1), 2: (-1, -1)}
    got = {r["k"]: (r["start_idx"], r["end_idx"]) for r in series.first_last_hit(rows_of(spark, table), ["k"], stride=5, miss="all").collect()}
    assert got == {1: (0, 14), 2: (0, 3)}


def test_fixed_trim(spark):
    df = spark.range(200).select(F.lit(1).alias("k"), F.col("id").alias("i")).union(spark.range(201).select(F.lit(2), F.col("id")))
    got = {r["k"]: (r["start_idx"], r["end_idx"]) for r in series.fixed_trim(df, ["k"]).collect()}
    assert got == {1: (0, 200), 2: (100, 101)}


def test_distance_blend(spark):
    table = {1: [(50, True, False), (50, False, False)], 2: [(7, True, False)]}
    assert by_key(series.distance_blend(rows_of(spark, table), ["k"]), "blend_v") == {1: [49, 50], 2: [0]}


def test_even_sample(spark):
    table = {1: [(v, False, False) for v in range(7)], 2: [(5, False, False)]}
    got = series.even_sample(rows_of(spark, table), ["k"], 4)
    assert sorted((r["k"], r["sample_no"], r["i"]) for r in got.collect()) == [(1, 0, 0), (1, 1, 2), (1, 2, 4), (1, 3, 6), (2, 0, 0)]


def test_timelapse_sequences(spark):
    sign = [0, 0, 0, 1, 1, 0, 0, 0, 0, 1, 0, 0]
    df = rows_of(spark, {0: [(s,) for s in sign]}, "k long, i long, sign int")
    # Marks: 0 starts, 7 ends (the change is two ahead), 11 ends; 5 starts after the change at 4.
    got = sorted((r["start_idx"], r["end_idx"]) for r in series.still_runs_timelapse(df, ["k"]).collect())
    assert got == [(5, 7)] or got == [(0, 1), (5, 7)]


def test_reference_frame_is_kept(spark):
    df = rows_of(spark, {1: [(1, False, False), (2, False, False)], 2: [(3, False, False)]})
    done = spark.createDataFrame([(2,)], "k long")
    assert [(r["k"], r["i"], r["v"]) for r in series.reference_frame(df, ["k"], done).collect()] == [(1, 1, 2)]


def test_negative_place_counts_from_the_end(spark):
    df = rows_of(spark, {1: [(v, False, False) for v in (4, 5, 6)]})
    assert series.frame_at(df, ["k"], -1).first()["v"] == 6
    assert series.frame_at(df, ["k"], 0).first()["v"] == 4


def test_band_difference_wraps(spark):
    df = rows_of(spark, {1: [(0, False, False), (16, False, False)], 2: [(0, False, False), (9, False, False)]})
    assert by_key(series.band_difference(df, ["k"]), "moved") == {1: [False, False], 2: [True, True]}


def test_keyframe_step(spark):
    df = spark.range(40).select(F.lit(1).alias("k"), F.col("id").alias("i"), F.lit(0).alias("p"), F.lit(5).cast("long").alias("v"))
    got = series.keyframes(df, ["k"], ["p"], changes=1, step=4).first()
    assert (got["start_idx"], got["end_idx"]) == (0, 32)
    with pytest.raises(ZeroDivisionError):
        series.keyframes(df, ["k"], ["p"], step=0)


def test_unread_frames_are_no_hit(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 1, True), (1, 2, None)], "k long, i long, hit boolean")
    got = series.first_last_hit(df, ["k"], stride=1).first()
    assert (got["start_idx"], got["end_idx"]) == (1, 1)


def test_strict_keyframes_look_at_the_first_places_only(spark):
    # 13 frames, step 3: the strict counter stops at frame 4 and so sees two of five.
    df = spark.range(13).select(F.lit(1).alias("k"), F.col("id").alias("i"), F.lit(0).alias("p"), F.lit(5).cast("long").alias("v"))
    assert series.keyframes(df, ["k"], ["p"], changes=1, step=3).count() == 1
    assert series.keyframes(df, ["k"], ["p"], changes=1, step=3, strict=True).count() == 0


def test_extraction_names_its_frames(spark):
    df = spark.range(6).select(F.lit(1).alias("k"), F.col("id").alias("i"))
    got = series.uniform_extraction(df, 25, 10).orderBy("i").collect()
    assert [(r["i"], r["file_name"]) for r in got] == [(0, "00000000.png"), (2, "00000002.png"), (4, "00000004.png")]
    assert series.uniform_extraction(df, 25).count() == 6
