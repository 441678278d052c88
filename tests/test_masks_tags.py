import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.functions import pixels as P
from framewright.functions import text as X
from framewright.operators import masks, tags


@pytest.mark.parametrize(("diff", "want"), [(9, 9.0), (16, 0.0), (17, math.sqrt(33))])
def test_wrapped_distance(spark, diff, want):
    df = spark.range(1).select(P.color_distance(F.array(F.lit(diff).cast("long")), F.array(F.lit(0).cast("long"))).alias("d"))
    assert df.first()["d"] == pytest.approx(want)


def grid_of(spark, array):
    rows = [(int(f), int(y), int(x), bool(array[f, y, x])) for f, y, x in np.ndindex(array.shape)]
    return spark.createDataFrame(rows, "f int, y int, x int, m boolean")


@pytest.mark.parametrize("kernel", [2, 3, 4])
@pytest.mark.parametrize("mode", ["dilate", "erode"])
def test_morphology(spark, kernel, mode):
    a = np.random.default_rng(kernel).random((2, 6, 7)) < (0.2 if mode == "dilate" else 0.8)
    got = np.zeros(a.shape, bool)
    for r in masks.morphology(grid_of(spark, a), ["f"], kernel, mode).collect():
        got[r["f"], r["y"], r["x"]] = r["m"]
    reach = range(-(kernel // 2), kernel - kernel // 2)
    for f, y, x in np.ndindex(a.shape):
        near = [a[f, y + dy, x + dx] for dy in reach for dx in reach if 0 <= y + dy < 6 and 0 <= x + dx < 7]
        assert got[f, y, x] == (any(near) if mode == "dilate" else all(near))


def test_majority_needs_half(spark):
    df = spark.createDataFrame([(1, x < 2) for x in range(4)] + [(2, x < 1) for x in range(3)], "p int, m boolean")
    assert {r["p"]: r["majority_m"] for r in masks.majority_mask(df, ["p"]).collect()} == {1: True, 2: False}


def test_constant_frame_has_no_near_mask(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 0), (2, 4)], "f int, v int")
    assert masks.minmax_mask(df, ["f"]).where("near_m").count() == 1


def test_histogram_keeps_one(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 0.005)], "k int, progress double")
    assert [r["bin"] for r in masks.progress_histogram(df, ["k"]).where("present = 1").orderBy("bin").collect()] == [0, 99]


def test_boxes_round_half_to_even_and_have_an_area_limit(spark):
    dets = F.array(
        F.struct(F.lit("a").alias("label"), F.lit(1.0).alias("score"), F.array(F.lit(0.5), F.lit(1.5), F.lit(2.5), F.lit(3.5)).alias("box")),
        F.struct(F.lit("").alias("label"), F.lit(1.0).alias("score"), F.array(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(2.0)).alias("box")),
        F.struct(F.lit("b").alias("label"), F.lit(1.0).alias("score"), F.array(F.lit(-5.0), F.lit(0.0), F.lit(20.0), F.lit(20.0)).alias("box")),
    )
    got = spark.range(1).select(masks.valid_boxes(dets, F.lit(10), F.lit(10)).alias("d")).first()["d"]
    assert [(d["label"], d["box"]) for d in got] == [("a", [0, 2, 2, 4])]


def test_mcut(spark):
    df = spark.createDataFrame([(1, n, p) for n, p in zip("abcd", [0.9, 0.8, 0.3, 0.2], strict=True)], "k int, name string, p double")
    assert tags.mcut_threshold(df, ["k"]).first()["threshold"] == pytest.approx(0.55)


def test_prompt_tags(spark):
    text = F.lit("no humans, oil medium,  sky , tree, multimedia,a,b,c,d")
    assert spark.range(1).select(X.prompt_tags(text).alias("t")).first()["t"] == ["sky", "tree", "a", "b", "c"]


def test_attributes_and_defaults(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{broken",), ("plain",)], "s string")
    assert [r[0] for r in df.select(X.decoded_attribute(F.col("s"))).collect()] == ['{"a":1}', "{broken", "plain"]
    m = F.create_map(F.lit("a"), F.lit(None).cast("string"))
    row = spark.range(1).select(X.with_default(m, "a").alias("x"), X.with_default(m, "b").alias("y")).first()
    assert (row["x"], row["y"]) == (None, "")


def test_medium_key(spark):
    df = spark.createDataFrame([(["pencil"], ["loomis portrait"]), (["oil"], None), ([], [])], "m array<string>, s array<string>")
    assert [r[0] for r in df.select(X.medium_key(F.col("m"), F.col("s"))).collect()] == ["loomis_pencil", "oil", ""]


def test_best_aspect_first_of_equals(spark):
    df = spark.createDataFrame([(100, 100)], "width int, height int")
    assert tuple(tags.best_aspect(df, [(512, 512), (256, 256)]).first()["best_size"]) == (512, 512)
    assert tags.best_aspect(df, []).first()["best_size"] is None


def test_erosion_and_dilation_repeat(spark):
    a = np.zeros((1, 9, 9), bool)
    a[0, 4, 4] = True
    assert masks.morphology(grid_of(spark, a), ["f"], 3, "dilate", times=3).where("m").count() == 49
    assert masks.opened(grid_of(spark, a), ["f"], 3).where("m").count() == 0


def test_lab_of_plain_colours(spark):
    df = spark.createDataFrame([([0, 0, 0],), ([255, 255, 255],), ([0, 0, 255],), ([255, 0, 0],), ([128, 128, 128],)], "p array<long>")
    got = [tuple(r[0]) for r in df.select(P.bgr_to_lab(F.col("p"))).collect()]
    assert got == [(0, 128, 128), (255, 128, 128), (136, 208, 195), (82, 207, 20), (137, 128, 128)]


def test_sizes_must_be_positive(spark):
    assert spark.range(1).select(P.uncontain(F.lit(100), F.lit(50), 64, 48).alias("u")).first()["u"]["y"] == 8
    with pytest.raises(Exception, match="sizes must be positive"):
        spark.range(1).select(P.uncontain(F.col("id"), F.lit(5), 64, 48).alias("u")).collect()


def test_failed_frames_do_not_shift_masks(spark):
    """Frame 1 has no masks: frame 2 keeps its own, and the flag spares frame 3."""
    pixels = [(1, i, 0, x, 10 * i + x, i == 3) for i in range(4) for x in range(2)]
    found = [(1, i, 0, x, "p", i == 2 and x == 0) for i in (0, 2) for x in range(2)]
    df = spark.createDataFrame(pixels, "k int, i int, y int, x int, v int, logo_removed boolean")
    done = masks.remove_logos(df, spark.createDataFrame(found, "k int, i int, y int, x int, prompt string, m boolean"), ["k"])
    got = {(r["i"], r["x"]): (r["v"], r["logo_removed"]) for r in done.collect()}
    assert got == {(i, x): (10 if (i, x) == (2, 0) else 10 * i + x, True) for i in range(4) for x in range(2)}
