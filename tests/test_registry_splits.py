import json

import pytest
from pyspark.sql import functions as F

from framewright.operators import registry, splits
from framewright.plans.stages import Chain, not_done
from framewright.sources import readers, writers

ITEMS = "source string, url string, channel_ids array<string>, only_channel_vid boolean"


def test_register_skips_empty_known_foreign_and_repeated(spark):
    items = spark.createDataFrame([("youtube", "u1", ["c1"], True), ("youtube", "u2", ["c1"], False), ("vimeo", "u3", [], False)], ITEMS)
    catalog = spark.createDataFrame([("u1", "a", "c1"), ("u1", "b", "c2"), ("u1", "", "c1"), ("u2", "a", "c9"), ("u2", "d", "c9"), ("u2", "k", "c9"), ("u3", "z", "c")], "url string, id string, channel_id string")
    known = spark.createDataFrame([("youtube", "k")], "source string, video_id string")
    got = registry.register(items, catalog, known).collect()
    assert sorted((r["video_id"], r["url"], r["processed"]) for r in got) == [("a", "a", False), ("d", "d", False)]


def test_references_close_ranks(spark):
    df = spark.createDataFrame([("v", i, i * 10) for i in range(4)], "v string, ref_idx int, x int")
    got = registry.remove_reference(df, ["v"], F.col("ref_idx") == 1)
    assert sorted((r["ref_idx"], r["x"]) for r in got.collect()) == [(0, 0), (1, 20), (2, 30)]


def test_folds_partition_each_source(spark):
    df = spark.createDataFrame([(i, "s") for i in range(7)], "doc_id long, source string")
    dealt = splits.folds(df, "source", "doc_id", n=3)
    assert sorted(r["count"] for r in dealt.groupBy("chunk").count().collect()) == [2, 2, 3]
    sets = splits.fold_sets(dealt, 3)
    assert sets.where("part = 'test'").count() == 7
    assert sets.count() == 21


def test_split_fallback_and_limits(spark):
    df = spark.createDataFrame([(i,) for i in range(400)], "id long")
    listed = spark.createDataFrame([(0, "test")], "id long, split string")
    got = splits.assign_split(df, listed, ["id"], "id")
    assert got.where("id = 0").first()["split"] == "test"
    assert {r["split"] for r in got.collect()} == {"train", "eval", "test"}
    assert splits.assign_split(df, listed, ["id"], "id", only_listed=True).count() == 1
    with pytest.raises(ValueError):
        splits.assign_split(df, None, ["id"], "id", 0.9, 0.2)


def test_catalog_and_split_file(spark, tmp_path):
    item = {"source": "youtube", "url": "u", "video_processor": [{"name": "p", "config": "{}"}], "channel_ids": ["c"]}
    (tmp_path / "a.jsonl").write_text(json.dumps(item) + "\n")
    row = readers.read_items(spark, str(tmp_path / "a.jsonl")).first()
    assert (row["url"], row["art_style"], row["only_channel_vid"], row["video_processor"][0]["name"]) == ("u", [], False, "p")
    (tmp_path / "s.json").write_text(json.dumps({"youtube": {"a": "train", "b": "test"}}))
    assert sorted(tuple(r) for r in readers.read_split_file(spark, str(tmp_path / "s.json")).collect()) == [("youtube", "a", "train"), ("youtube", "b", "test")]
    (tmp_path / "c.jsonl").write_text('{"video_processor": [{"name": "p"}, {"config": "x"}]}\nnot json\n')
    assert [r["name"] for r in readers.read_stage_configs(spark, str(tmp_path / "c.jsonl")).collect()] == ["p"]


def test_registry_round_trip(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert readers.read_registry(spark, path, "a int").count() == 0
    for n in (1, 2):
        writers.save_registry(spark.range(n).selectExpr("cast(id as int) a"), path)
        assert readers.read_registry(spark, path, "a int").count() == n


def test_chain_and_guard(spark):
    rows = spark.createDataFrame([(1, i, 10 * i, i == 1) for i in range(3)], "k long, i long, v long, m boolean")
    got = Chain().then("clean", fill=5).then("reference").run(rows).first()
    assert (got["k"], got["v"]) == (1, 20)
    assert not_done(rows, rows.where("k = 1"), ["k"]).count() == 0
    with pytest.raises(ValueError):
        Chain().then("nothing")


def test_replacing_needs_a_place_of_its_own(spark):
    refs = spark.createDataFrame([("v", 0, "a"), ("v", 1, "b")], "v string, ref_idx int, x string")
    new = spark.createDataFrame([("v", 1, "c"), ("v", 5, "d")], "v string, ref_idx int, x string")
    got = registry.replace(refs, new, ["v", "ref_idx"])
    assert sorted((r["ref_idx"], r["x"]) for r in got.collect()) == [(0, "a"), (1, "c")]


def test_upsert_keeps_what_is_not_written(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, x string, n int")
    new = spark.createDataFrame([(2, None, 7), (3, "z", None)], "id int, x string, n int")
    got = registry.upsert(old, new, ["id"], ["x", "n"])
    assert sorted(map(tuple, got.collect())) == [(1, "a", 5), (2, "b", 7), (3, "z", None)]


def test_pager_stays_within_its_ends(spark):
    df = spark.createDataFrame([("v", i) for i in range(3)], "v string, ref_idx int")
    got = registry.neighbours(df, ["v"]).orderBy("ref_idx").collect()
    assert [(r["previous"], r["next"]) for r in got] == [(0, 1), (0, 2), (1, 2)]


def test_removing_a_missing_reference_fails(spark):
    import pytest

    from framewright.operators import registry

    df = spark.createDataFrame([(1, 0), (1, 1), (1, 2)], "k int, ref_idx int")
    assert sorted(r["ref_idx"] for r in registry.remove_reference_at(df, ["k"], 1).collect()) == [0, 1]
    with pytest.raises(IndexError):
        registry.remove_reference_at(df, ["k"], 3)


def test_nulls_and_several_changes_of_a_key(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, None), (1, 2, "b")], "k int, ref_idx int, name string")
    left = registry.remove_reference(df, ["k"], F.col("name") == "b").collect()
    assert sorted((r["ref_idx"], r["name"]) for r in left) == [(0, "a"), (1, None)]
    items = spark.createDataFrame([(1, False), (2, True)], "k int, exclude_video boolean")
    changes = spark.createDataFrame([(1, True, 1), (1, False, 2), (2, None, 3)], "k int, exclude_video boolean, at int")
    assert sorted(map(tuple, registry.set_excluded(items, changes, ["k"], "at").collect())) == [(1, False), (2, True)]
    assert sorted(map(tuple, registry.set_excluded(items, changes, ["k"]).collect())) == [(1, True), (2, True)]
    new = spark.createDataFrame([(1, "x", None, 1), (1, None, 5, 2), (1, "y", 4, 3), (3, "z", None, 1)], "k int, a string, b int, at int")
    old = spark.createDataFrame([(1, "o", 1)], "k int, a string, b int")
    assert sorted(map(tuple, registry.upsert(old, new, ["k"], ["a", "b"], "at").collect())) == [(1, "y", 4), (3, "z", None)]


def test_references_and_stand_ins(spark):
    df = spark.createDataFrame([(1, 0, "a"), (2, 1, "b")], "k int, ref_idx int, image string")
    shown = spark.createDataFrame([(1,), (2,), (3,), (3,)], "k int")
    got = registry.references(df, shown, ["k"], F.lit("none"), "image").select("k", "image", "missing")
    assert sorted(map(tuple, got.collect())) == [(1, "a", False), (2, "none", True), (3, "none", True)]


def test_model_column(spark):
    from framewright.plans.models import model_column

    class Mean:
        def __call__(self, frames):
            return [sum(f) / len(f) for f in frames]

    df = spark.createDataFrame([(1, [1.0, 3.0]), (2, [5.0])], "k int, f array<double>")
    got = df.select("k", model_column(Mean, "double", F.col("f"), batch=1).alias("m")).collect()
    assert sorted(map(tuple, got)) == [(1, 2.0), (2, 5.0)]
