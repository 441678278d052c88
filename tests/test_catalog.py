import json

from framewright.plans import catalog

CATALOG = "url string, id string, title string, license string, channel string, channel_id string"


def test_register_export_and_rerun(spark, tmp_path):
    base, out = str(tmp_path / "base"), str(tmp_path / "out")
    lines = [{"source": "youtube", "url": f"u{i}", "video_processor": [], "channel_ids": []} for i in range(6)]
    (tmp_path / "a.jsonl").write_text("".join(json.dumps(x) + "\n" for x in lines))
    (tmp_path / "b.txt").write_text("no")
    known = spark.createDataFrame([(f"u{i}", f"v{i}", "t", "l", "c", "k") for i in range(6)], CATALOG)
    files = [str(tmp_path / "a.jsonl"), str(tmp_path / "b.txt")]
    assert catalog.register_files(spark, base, files, known).count() == 6
    assert catalog.register_files(spark, base, files, known).count() == 6  # a rerun adds nothing
    catalog.mark_processed(spark, base, spark.createDataFrame([("youtube", "v0")], "source string, video_id string"))
    spark.createDataFrame([("youtube", f"v{i}", n) for i in range(5) for n in range(2)], "source string, video_id string, frame_no int").write.parquet(f"{base}/frames")
    (tmp_path / "s.json").write_text(json.dumps({"youtube": {"v1": "eval", "v2": "test"}}))
    catalog.export_split(spark, base, out, str(tmp_path / "s.json"), only_listed=True)
    got = spark.read.parquet(out)
    assert sorted({(r["video_id"], r["split"]) for r in got.collect()}) == [("v1", "eval"), ("v2", "test")]
    catalog.export_folds(spark, base, out + "-folds", n=2)
    folds = spark.read.parquet(out + "-folds")
    assert folds.count() == 2 * 10
    assert folds.where("part = 'test'").select("video_id").distinct().count() == 5


def lines_of(path, ids, source="youtube"):
    path.write_text("".join(json.dumps({"source": source, "url": u, "video_processor": [], "channel_ids": []}) + "\n" for u in ids))


def test_the_first_line_of_the_first_file_wins(spark, tmp_path, caplog):
    lines_of(tmp_path / "z.jsonl", ["u9", "u1"])
    lines_of(tmp_path / "a.jsonl", ["u0"])
    known = spark.createDataFrame([(u, "same", u, "l", "c", "k") for u in ("u0", "u1", "u9")], CATALOG)
    got = catalog.register_files(spark, str(tmp_path / "base"), [str(tmp_path / f) for f in ("missing.jsonl", "z.jsonl", "a.jsonl")], known)
    assert [r["title"] for r in got.collect()] == ["u9"]
    assert "missing.jsonl does not exist" in caplog.text


def test_a_failed_save_leaves_the_old_registry(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F

    from framewright.sources import writers

    path = str(tmp_path / "r")
    writers.save_registry(spark.range(3), path)
    with pytest.raises(Exception):  # noqa: B017, PT011
        writers.save_registry(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["r"]
    writers.save_registry(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["r"]


def test_jobs_from_the_command_line(spark, tmp_path):
    base = str(tmp_path / "base")
    lines_of(tmp_path / "a.jsonl", ["u0", "u1"])
    rows = [(f"u{i}", f"v{i}", "t", "l", "c", "k") for i in range(2)]
    spark.createDataFrame(rows, CATALOG).write.parquet(str(tmp_path / "known"))
    catalog.main(["register", "--base", base, "--files", str(tmp_path / "a.jsonl"), "--catalog", str(tmp_path / "known")])
    frames = [("youtube", f"v{i}", n, 10 * n, n == 1) for i in range(2) for n in range(3)]
    spark.createDataFrame(frames, "source string, video_id string, i long, v long, m boolean").write.parquet(f"{base}/frames")
    catalog.main(["process", "--base", base, "--override", "clean", "{}"])
    got = catalog.read_processed(spark, base)
    assert sorted(r["v"] for r in got.where("k = 'youtube:v0'").collect()) == [0, 0, 20]
    catalog.main(["process", "--base", base])
    assert catalog.read_processed(spark, base).count() == 6
    catalog.main(["process", "--base", base, "--only", "youtube", "v1"])
    assert catalog.read_processed(spark, base).count() == 6
    assert sorted(r["v"] for r in catalog.read_processed(spark, base).where("k = 'youtube:v0'").collect()) == [0, 10, 20]  # without stages the frames pass as they are


def test_unknown_stages_are_refused(spark):
    import pytest

    from framewright.plans import stages

    items = spark.createDataFrame([(1, [("nothing", "{}")], False)], "k long, video_processor array<struct<name:string,config:string>>, processed boolean")
    with pytest.raises(ValueError, match="unknown stage"):
        stages.process(items, spark.createDataFrame([], "k long, i long, v long, m boolean"), ["k"])


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import pytest

    from framewright.sources.scratch import scratch_dir

    class Away:
        master = "spark://host:7077"

        class _jsc:
            class sc:
                class getCheckpointDir:
                    @staticmethod
                    def isDefined():
                        return False

    class Session:
        sparkContext = Away

        class conf:
            @staticmethod
            def get(name, default):
                return None

    Away._jsc.sc = staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: Away._jsc_checkpoint)}))
    Away._jsc_checkpoint = type("O", (), {"isDefined": staticmethod(lambda: False)})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session)
