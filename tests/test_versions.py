"""Versions under writers at the same time, readers in between, and failures."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from framewright.operators import registry
from framewright.plans import catalog
from framewright.sources import versions, writers

SCHEMA = "id long"


def ids(spark, path):
    return sorted(r.id for r in versions.read(spark, path, SCHEMA).collect())


def add(spark, *new):
    return lambda old: old.unionByName(spark.createDataFrame([(n,) for n in new], SCHEMA))


def test_versions_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    assert ids(spark, path) == [] and versions.newest(spark, path) == (0, None)
    assert versions.update(spark, path, SCHEMA, add(spark, 1)) == 1
    before = versions.read(spark, path, SCHEMA)
    assert versions.update(spark, path, SCHEMA, add(spark, 2)) == 2
    assert [r.id for r in before.collect()] == [1]  # a reader keeps what it began with
    assert ids(spark, path) == [1, 2]


def test_a_plain_table_becomes_versioned(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(7,)], SCHEMA).write.parquet(path)
    assert ids(spark, path) == [7]
    versions.update(spark, path, SCHEMA, add(spark, 8))
    assert ids(spark, path) == [7, 8]


def test_a_failed_change_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.update(spark, path, SCHEMA, add(spark, 1))
    with pytest.raises(Exception):  # noqa: B017, PT011
        versions.update(spark, path, SCHEMA, lambda old: old.select(F.raise_error(F.lit("no")).cast("long").alias("id")))
    assert ids(spark, path) == [1]
    assert len(list((tmp_path / "t" / "_data").iterdir())) == 1


def test_a_number_is_claimed_once(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.update(spark, path, SCHEMA, add(spark, 1))
    with pytest.raises(versions.Conflict):
        versions.claim(spark, path, 1, "other")
    assert ids(spark, path) == [1]
    assert all(p.name.isdigit() or p.name.endswith(".crc") for p in (tmp_path / "t" / "_versions").iterdir())


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(5):
        versions.update(spark, path, SCHEMA, add(spark, n))
        versions.expire(spark, path, kept=2)
    assert ids(spark, path) == [0, 1, 2, 3, 4]
    assert len(list((tmp_path / "t" / "_data").iterdir())) == 2


def together(*jobs):
    errors = []

    def run(job):
        try:
            job()
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors


def test_writers_at_the_same_time(spark, tmp_path):
    path = str(tmp_path / "t")
    seen = threading.Barrier(2)
    first = {1: True, 2: True}

    def writer(n):
        def change(old):
            if first.pop(n, False):
                seen.wait(30)  # both have read the same version
            return add(spark, n)(old)

        return lambda: versions.update(spark, path, SCHEMA, change)

    together(writer(1), writer(2))
    assert ids(spark, path) == [1, 2] and versions.newest(spark, path)[0] == 2


def test_registrations_at_the_same_time(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "base")
    known = spark.createDataFrame([(f"u{i}", f"v{i % 5}", "t", "l", "c", "k") for i in range(8)], "url string, id string, title string, license string, channel string, channel_id string")
    for name, urls in (("a", range(4)), ("b", range(4, 8))):
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"source": "youtube", "url": f"u{i}", "video_processor": [], "channel_ids": []}) + "\n" for i in urls))
    seen, plain, calls = threading.Barrier(2), registry.register, []

    def register(*a, **k):
        calls.append(1)
        if len(calls) <= 2:
            seen.wait(30)
        return plain(*a, **k)

    monkeypatch.setattr(registry, "register", register)
    together(*[lambda f=f: catalog.register_files(spark, base, [str(tmp_path / f)], known) for f in ("a.jsonl", "b.jsonl")])
    got = [r.video_id for r in versions.read(spark, f"{base}/registry", catalog.REGISTRY).collect()]
    assert sorted(got) == [f"v{i}" for i in range(5)]  # both sets, and each id once
    assert len(calls) == 3


def test_replaced_tables_are_still_replaced(spark, tmp_path):
    path = str(tmp_path / "r")
    writers.save_registry(spark.range(3), path)
    assert ids(spark, path) == [0, 1, 2]
