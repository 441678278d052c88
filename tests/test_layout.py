"""Buckets, by results and by plans: one bucket a lookup, no exchange where items meet."""

import uuid

import pytest
from pyspark.sql import functions as F

from framewright.operators import registry
from framewright.sources import layout


@pytest.fixture
def tables(spark, tmp_path):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    name = f"t{uuid.uuid4().hex[:8]}"
    items = spark.createDataFrame([("y:t" if i % 7 == 0 else "yt", f"v{i}", i % 5 == 0) for i in range(200)], "source string, video_id string, exclude_video boolean")
    frames = items.where("video_id <> 'v3'").select("source", "video_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("frame_no"), F.lit("m").alias("processor"), F.lit(b"x").alias("blob"))
    known = layout.write_by_item(items, f"{name}_items", str(tmp_path / "items"), 8)
    meta, pixels = layout.write_frames_by_item(frames, name, str(tmp_path / "frames"), 8)
    yield known, meta, pixels, str(tmp_path), name
    for t in ("items", "meta", "pixels", "again"):
        spark.sql(f"drop table if exists {name}_{t}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture
def shown(spark):
    """Plans name the buckets of every scan, not of those alone that rest on them."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    yield
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_lookup_reads_one_bucket(tables, shown):
    _, meta, pixels, *_ = tables
    for t in (meta, pixels):
        got = layout.lookup_by_item(t, "y:t", "v14")
        assert "SelectedBucketsCount: 1 out of 8" in plan(got)
        assert got.count() == 3
    assert "blob" not in meta.columns and "processor" not in pixels.columns
    assert layout.lookup_by_item(meta, "yt", "none").count() == 0


def test_items_meet_their_frames_without_an_exchange(spark, tables):
    known, meta, pixels, *_ = tables
    found = registry.eligible(known, meta, [layout.KEY])
    assert "Exchange" not in plan(found)
    assert found.count() == 159
    counted = registry.frame_counts(known, meta, [layout.KEY])
    assert "Exchange" not in plan(counted)
    both = meta.join(pixels.drop("source", "video_id"), [layout.KEY, "frame_no"])
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        assert "Exchange" not in plan(both) and both.count() == 597
    finally:
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def test_appended_frames_continue_the_count_without_an_exchange(spark, tables):
    _, meta, _, path, name = tables
    new = meta.where("frame_no = 0").select("source", "video_id", F.lit(0).alias("n"), "processor")
    added = layout.write_by_item(new, f"{name}_again", f"{path}/again", 8)
    out = registry.append(meta.withColumn("n", F.col("frame_no")), added, [layout.KEY], ["n"])
    assert "Exchange" not in plan(out)
    assert {r.frame_no for r in out.where(F.col(layout.KEY) == "yt:v1").collect()} == {0, 1, 2, 3}


def test_another_session_and_appends(spark, tables, shown):
    _, meta, _, path, name = tables
    spark.sql(f"drop table {name}_meta")
    again = layout.open_by_item(spark, f"{name}_meta", f"{path}/frames/meta", 8)
    assert again.count() == 597
    assert "SelectedBucketsCount: 1 out of 8" in plan(layout.lookup_by_item(again, "yt", "v1"))
    more = layout.write_by_item(spark.createDataFrame([("yt", "v1", 3, "m")], "source string, video_id string, frame_no int, processor string"), f"{name}_meta", f"{path}/frames/meta", 8, "append")
    assert layout.lookup_by_item(more, "yt", "v1").count() == 4


def test_keys_of_different_items_differ(spark):
    rows = spark.createDataFrame([("a:b", "c"), ("a", "b:c"), ("a%3Ab", "c")], "s string, v string")
    assert rows.select(layout.item_key(F.col("s"), F.col("v"))).distinct().count() == 3
