"""Items through their own lists: the stages against the operators they stand for, one scan, guards, and runs that crash or repeat."""

import json
import random

import pytest
from pyspark.sql import functions as F

from framewright.operators import masks, series
from framewright.plans import catalog, stages
from framewright.sources import versions, writers

FRAMES = "k long, i long, y int, x int, v long, m boolean, hit boolean, box array<double>, logo boolean, logo_removed boolean"
ITEMS = "k long, video_processor array<struct<name:string,config:string>>, processed boolean"


def pixels(spark, ks=(1, 2, 3), n=14, h=5, w=7):
    rng = random.Random(4)
    rows = []
    for k in ks:
        for i in range(n):
            hit, box, done = rng.random() < 0.4, [0.6, 1.2, 6.4, 4.4] if rng.random() < 0.6 else None, rng.random() < 0.2
            calm = rng.random() < 0.7
            for y in range(h):
                for x in range(w):
                    rows.append((k, i, y, x, 10 * x + y if calm else rng.randrange(256), rng.random() < 0.2, hit, box, rng.random() < 0.2, done))
    return spark.createDataFrame(rows, FRAMES).repartition(3)


def items_of(spark, lists, **state):
    rows = [(k, [(n, None if c is None else json.dumps(c) if isinstance(c, dict) else c) for n, c in steps], False) for k, steps in lists.items()]
    return spark.createDataFrame(rows, ITEMS).withColumns({c: F.lit(v) for c, v in state.items()})


def same(got, want, columns):
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(map(tuple, want.select(*columns).collect()), key=repr)


KEY, CELL = ["k", "i"], ["k", "y", "x"]


def test_each_item_has_its_own_list(spark):
    df = pixels(spark)
    lists = {1: [("temporal_median", {"window": 3})], 2: [("clean", {"fill": 7}), ("temporal_median", None)], 3: [("temporal_median", "no json"), ("clean", None), ("reference", "{}")], 9: [("clean", None)]}
    got = stages.process(items_of(spark, lists), df, ["k"])
    assert got.columns == df.columns
    value = lambda d, into: d.drop("v").withColumnRenamed(into, "v")
    own = {k: df.where(F.col("k") == k) for k in (1, 2, 3)}
    one = value(series.temporal_median(own[1], CELL, window=3), "median_v")
    two = value(series.temporal_median(value(series.last_clean_fill(own[2], CELL, seed=F.lit(7)), "clean_v"), CELL), "median_v")
    three = value(series.last_clean_fill(value(series.temporal_median(own[3], CELL), "median_v"), CELL), "clean_v").where("i = 13")
    columns = ["k", "i", "y", "x", "v", "m"]
    same(got, one.select(columns).unionByName(two.select(columns)).unionByName(three.select(columns)), columns)


def test_range_extract_and_logos(spark):
    df = pixels(spark, (1, 2, 3, 4))
    steps = [("range", {"frame_steps": 3}), ("extract", {"most": 6}), ("logos", None)]
    out = stages.run_lists(items_of(spark, {1: steps, 2: steps, 3: [("extract", {"most": 9})], 4: [("logos", None)]}), df, ["k"])
    frames = df.select("k", "i", "hit").distinct()
    found = series.first_last_hit(frames, ["k"], stride=3).where("k < 3").withColumnsRenamed({"start_idx": "start_frame_idx", "end_idx": "end_frame_idx"})
    state = stages.state_of(out, ["k"])
    assert {(r.k, r.start_frame_idx, r.end_frame_idx) for r in state.where("k < 3").collect()} == {tuple(r) for r in found.where("start_frame_idx >= 0").collect()}
    cells = df.select(*KEY, "y", "x", "v", "logo", "logo_removed")
    ranges = found.where("start_frame_idx >= 0 and end_frame_idx >= 0").withColumnsRenamed({"start_frame_idx": "start_idx", "end_frame_idx": "end_idx"})
    sampled = series.even_sample(frames.where("k < 3"), ["k"], 6, ranges).unionByName(series.even_sample(frames.where("k = 3"), ["k"], 9)).drop("hit").join(cells, KEY).drop("i").withColumnRenamed("sample_no", "i")
    every = sampled.unionByName(cells.where("k = 4"))
    open_ = every.where("k <> 3")
    want = masks.remove_logos(open_.drop("logo"), open_.where("not logo_removed").select(*KEY, "y", "x", F.col("logo").alias("m")), ["k"]).unionByName(every.where("k = 3").drop("logo"))
    same(out, want, [*KEY, "y", "x", "v", "logo_removed"])


def test_extract_places_are_those_of_even_samples(spark):
    rng = random.Random(1)
    rows, ranges = [], []
    for k in range(60):
        n = rng.choice([1, 2, 5, 13, 40])
        a, z = (lambda p: (min(p), max(p)))((rng.randrange(n), rng.randrange(n)))
        rows += [(k, i, i) for i in range(n)]
        ranges.append((k, a, z, rng.choice([1, 2, 3, 7, 50])))
    df = spark.createDataFrame(rows, "k long, i long, v long")
    for most in (1, 2, 3, 7, 50):
        own = spark.createDataFrame([r[:3] for r in ranges if r[3] == most], "k long, start_idx long, end_idx long")
        lists = own.select("k", F.array(F.struct(F.lit("extract").alias("name"), F.lit(json.dumps({"most": most})).alias("config"))).alias("video_processor"), F.col("start_idx").alias("start_frame_idx"), F.col("end_idx").alias("end_frame_idx"))
        want = series.even_sample(df, ["k"], most, own).select("k", F.col("sample_no").alias("i"), "v")
        same(stages.run_lists(lists, df, ["k"]), want, ["k", "i", "v"])


def test_canvas_split_and_masks(spark):
    df = pixels(spark)
    items = items_of(spark, {1: [("canvas", {"erosion": 1}), ("masks", {"kernel": 3})], 2: [("split", {"left": 0.25, "right": 0.75})], 3: [("masks", {"kernel": 4})]}, start_frame_idx=2)
    out = stages.run_lists(items, df, ["k"])
    meta = spark.createDataFrame([(1, 2, False, None, 7, 5)], "k long, start_frame_idx long, canvas_detected boolean, canvas_coordinates array<int>, width int, height int")
    boxes = df.select("k", "i", F.when(F.col("box").isNotNull(), F.array(F.struct("box"))).alias("detections")).where("detections is not null").distinct()
    canvas = masks.detect_canvas(meta, boxes, ["k"], erode=1).first()
    one = df.where("k = 1")
    if canvas.canvas_detected:
        one = masks.crop(one, *[F.lit(c) for c in canvas.canvas_coordinates])
        assert stages.state_of(out, ["k"]).where("k = 1").first().canvas_coordinates == canvas.canvas_coordinates
    assert canvas.canvas_detected  # the fixture has a box there
    same(out.where("k = 1"), masks.morphology(one, KEY, 3, "dilate"), [*KEY, "y", "x", "m"])
    same(out.where("k = 3"), masks.morphology(df.where("k = 3"), KEY, 4, "dilate"), [*KEY, "y", "x", "m"])
    two = df.where("k = 2")
    at = masks.split_column(two, KEY, 7, left=0.25, right=0.75)
    found = series.seek(spark.createDataFrame([(2, 2)], "k long, start_frame_idx long"), at, ["k"], "start_frame_idx", "split_x", "split_x")
    same(out.where("k = 2"), masks.right_half(two, found, ["k"], 7), [*KEY, "y", "x", "v"])


def test_keyframes(spark):
    df = pixels(spark)
    out = stages.run_lists(items_of(spark, {1: [("keyframes", {"changes": 5})], 2: [("keyframes", {"changes": 5})], 3: [("clean", None)]}), df, ["k"])
    runs = series.keyframes(df.where("k < 3"), ["k"], ["y", "x"], diff=10, changes=5)
    want = df.where("k < 3").join(runs, "k").where("i between start_idx and end_idx")
    assert runs.count() > 0
    same(out.where("k < 3"), want, [*KEY, "y", "x", "v"])


def test_guards(spark):
    df = pixels(spark, (1,))
    steps = [("range", None), ("canvas", None), ("extract", {"most": 3}), ("temporal_median", None), ("reference", None), ("tags", {"tag": "new"})]
    had = items_of(spark, {1: steps}, start_frame_idx=4, end_frame_idx=9, canvas_detected=True, has_frames=True, has_reference=True).withColumn("tags", F.array(F.lit("old")))
    out = stages.run_lists(had, df, ["k"])
    same(out, df, df.columns)
    state = stages.state_of(out, ["k"]).first()
    assert (state.start_frame_idx, state.end_frame_idx, state.tags) == (4, 9, ["old", "new"])


def test_one_scan_for_any_number_of_lists(spark, tmp_path):
    n = 1500
    spark.range(n * 4).select((F.col("id") % n).alias("k"), F.floor(F.col("id") / n).alias("i"), F.col("id").alias("v"), (F.col("id") % 3 == 0).alias("m")).write.parquet(str(tmp_path / "frames"))
    items = spark.range(n).select(
        F.col("id").alias("k"), F.lit(False).alias("processed"),
        F.array(F.struct(F.lit("clean").alias("name"), F.format_string('{"fill": %d}', "id").alias("config")), F.struct(F.when(F.col("id") % 2 == 0, "reference").otherwise("temporal_median").alias("name"), F.lit(None).cast("string").alias("config"))).alias("video_processor"),
    )
    got = stages.process(items, spark.read.parquet(str(tmp_path / "frames")), ["k"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    assert got.count() == n // 2 * 5
    first = {r.k: r.v for r in got.where("i = 0 and k % 2 = 1").collect()}
    assert all(v == k for k, v in first.items())  # masked or clean, the first value is its own number


def test_unknown_stage(spark):
    with pytest.raises(ValueError, match="unknown stage"):
        stages.run_lists(items_of(spark, {1: [("clean", None), ("nothing", None)]}), pixels(spark, (1,), n=2), ["k"])
    with pytest.raises(Exception, match="must be odd"):
        stages.run_lists(items_of(spark, {1: [("temporal_median", {"window": 4})]}), pixels(spark, (1,), n=2), ["k"]).collect()


def test_no_items_and_empty_lists(spark):
    df = pixels(spark, (1, 2), n=3)
    assert stages.process(items_of(spark, {}), df, ["k"]).count() == 0
    same(stages.process(items_of(spark, {1: []}), df, ["k"]), df.where("k = 1"), df.columns)


def job(spark, base, lists, excluded=()):
    """A registry and frames of three places for each video."""
    rows = [("youtube", v, [(n, None) for n in steps], False, v in excluded) for v, steps in lists.items()]
    known = spark.createDataFrame(rows, "source string, video_id string, video_processor array<struct<name:string,config:string>>, processed boolean, exclude_video boolean")
    none = {n: F.lit(None).cast(t) for n, t in (c.split(" ", 1) for c in catalog.REGISTRY.split(", ")) if n not in known.columns}
    writers.save_registry(known.withColumns(none).select(*catalog.COLUMNS), f"{base}/registry")
    frames = [("youtube", v, i, 10 * i, i == 1) for v in lists for i in range(3)]
    spark.createDataFrame(frames, "source string, video_id string, i long, v long, m boolean").write.parquet(f"{base}/frames")


def stored(spark, base):
    out = {}
    for r in catalog.read_processed(spark, base).collect():
        out.setdefault(r.video_id, []).append(r.v)
    return {k: sorted(v) for k, v in out.items()}


def flags(spark, base):
    return {r.video_id: r.processed for r in versions.read(spark, f"{base}/registry", catalog.REGISTRY).collect()}


def test_an_item_processed_twice_is_stored_once(spark, tmp_path):
    base = str(tmp_path)
    job(spark, base, {"1": ["clean"], "2": [], "03": ["reference"]})
    catalog.process_registry(spark, base)
    want = {"1": [0, 0, 20], "2": [0, 10, 20], "03": [20]}
    assert stored(spark, base) == want and flags(spark, base) == dict.fromkeys(want, True)
    catalog.process_registry(spark, base)
    catalog.process_registry(spark, base, only=("youtube", "1"))
    catalog.process_registry(spark, base, only=("youtube", "1"))
    assert stored(spark, base) == want
    assert len(writers.folders(spark, f"{base}/processed")) == 2  # replaced runs are gone


@pytest.mark.parametrize("stop", ["commit", "vacuum", "mark_processed", "read_processed"])
def test_a_run_that_stops_leaves_one_copy(spark, tmp_path, monkeypatch, stop):
    """Behind the data, behind the commit, before the mark, and behind it."""
    base = str(tmp_path)
    job(spark, base, {"1": ["clean"], "2": []})
    catalog.process_registry(spark, base, only=("youtube", "1"))

    def crash(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(catalog, stop, crash)
        with pytest.raises(RuntimeError, match="lost"):
            catalog.process_registry(spark, base)
    want = {"1": [0, 0, 20], "2": [0, 10, 20]}
    catalog.process_registry(spark, base)
    assert stored(spark, base) == want and flags(spark, base) == {"1": True, "2": True}
    catalog.main(["vacuum", "--base", base])  # what was never committed stays for a day
    assert len(writers.folders(spark, f"{base}/processed")) == (3 if stop == "commit" else 2)
    catalog.vacuum(spark, base, hours=0)
    assert stored(spark, base) == want
    assert spark.read.parquet(f"{base}/processed").count() == 6


def test_override_skips_excluded_items_and_leaves_flags(spark, tmp_path):
    base = str(tmp_path)
    job(spark, base, {"1": ["clean"], "2": ["clean"]}, excluded=("2",))
    catalog.process_registry(spark, base, override=("reference", "{}"))
    assert stored(spark, base) == {"1": [20]} and flags(spark, base) == {"1": False, "2": False}
    catalog.process_registry(spark, base)
    catalog.process_registry(spark, base, override=("reference", "{}"))
    assert stored(spark, base) == {"1": [20], "2": [0, 0, 20]} and flags(spark, base) == {"1": True, "2": True}


def test_an_item_that_loses_its_frames(spark, tmp_path):
    base = str(tmp_path)
    job(spark, base, {"1": [], "2": []})
    catalog.process_registry(spark, base)
    spark.createDataFrame([("youtube", "2", 0, 5, False)], "source string, video_id string, i long, v long, m boolean").write.mode("overwrite").parquet(f"{base}/frames")
    catalog.process_registry(spark, base, only=("youtube", "1"))
    assert stored(spark, base) == {"2": [0, 10, 20]}


def test_long_items_are_the_work_of_several_tasks(spark):
    """One item holds all rows: its canvas and its range are known without bringing it into one task."""
    n = 300_000
    frames = spark.range(n).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("i"), F.lit(3).alias("y"), F.lit(3).alias("x"), F.col("id").alias("v"), F.lit(False).alias("m"), F.array(*map(F.lit, (0.0, 0.0, 4.0, 4.0))).alias("box"))
    items = items_of(spark, {1: [("canvas", {"erosion": 0}), ("extract", {"most": n})]}, start_frame_idx=0, end_frame_idx=n - 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = stages.run_lists(items, frames, ["k"]).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum("i").alias("total")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (sum(r.n for r in parts), sum(r.total for r in parts)) == (n, n * (n - 1) // 2)
    assert max(r.n for r in parts) < n


@pytest.mark.parametrize("long", [100])
def test_long_items_have_the_results_of_short_ones(spark, long):
    """Items of 490, 210 and 35 rows, of which two are long."""
    few = {1: 14, 2: 6, 3: 1}
    df = pixels(spark).where(F.col("i") < F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in few.items() for x in kv]), F.col("k")))
    steps = [
        [("canvas", {"erosion": 1}), ("temporal_median", {"window": 3}), ("reference", None)], [("logos", None), ("extract", {"most": 4}), ("clean", {"fill": 5})],
        [("masks", {"kernel": 3}), ("range", {"frame_steps": 2}), ("extract", {"most": 5})], [("split", None), ("keyframes", {"changes": 5})],
    ]
    columns = [*KEY, "y", "x", "v", "m", "logo_removed", *stages.STATE]
    for turn in range(3):
        items = items_of(spark, {k: steps[(k + turn) % 4] for k in few}, start_frame_idx=0 if turn % 2 else None)
        same(stages.run_lists(items, df, ["k"], long=long), stages.run_lists(items, df, ["k"], long=10**6), columns)


def test_frames_are_not_broadcast(spark, tmp_path):
    """Files of frames may be far smaller than what is known of the items."""
    spark.range(1000).select((F.col("id") % 4).alias("k"), F.floor(F.col("id") / 4).alias("i"), F.lit(1).cast("long").alias("v"), F.lit(False).alias("m")).write.parquet(str(tmp_path / "frames"))
    items = spark.range(100_000).select(F.col("id").alias("k"), F.lit(False).alias("processed"), F.array(F.struct(F.lit("clean").alias("name"), F.lit(None).cast("string").alias("config"))).alias("video_processor"))
    plan = stages.process(items, spark.read.parquet(str(tmp_path / "frames")), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
