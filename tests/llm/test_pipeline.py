"""The pipeline against its operators' brute-force twins, stage by stage, and as a whole."""

import os
import re

import pytest

import corpus_pipeline
from framewright.llm import toxicity
from framewright.llm.common import materialize

from .test_near_dedup import brute
from .test_secrets import base_of

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def rows_of(df):
    return sorted(df.collect(), key=lambda r: (r["doc_id"], r["text"] or ""))


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    scores = {r["doc_id"]: r["score"] for r in toxicity.report(docs, spark.read.parquet(f"{DIR}/labels.parquet")).collect()}
    kept = materialize(steps["toxicity"](spark, docs, DIR), "t")
    assert rows_of(kept) == [r for r in rows_of(docs) if scores[r["doc_id"]] < 0.5]

    single = materialize(steps["near-duplicates"](spark, kept, DIR), "t")
    classes = brute([(r["doc_id"], r["text"]) for r in rows_of(kept)])
    assert rows_of(single) == [r for r in rows_of(kept) if (r["doc_id"], r["doc_id"]) in {c[:2] for c in classes}]

    clean = materialize(steps["secrets"](spark, single, DIR), "t")
    for a, b in zip(rows_of(single), rows_of(clean), strict=True):
        found, _ = base_of(a["text"])
        assert (a["text"] == b["text"]) == (not found)
        assert b["n_chars"] == len(b["text"])

    mixed = materialize(steps["mixing"](spark, clean, DIR), "t")
    assert mixed.columns == docs.columns
    size = lambda d: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in d.collect())
    assert size(mixed) == pytest.approx(1.5 * size(clean), rel=0.01)  # documents are drawn whole
    whole = {r["doc_id"]: r for r in rows_of(clean)}
    assert all(whole[r["doc_id"]] == r for r in rows_of(mixed))
    assert mixed.groupBy("doc_id").count().where("count > 2").count() == 0

    last = steps["encoding"](spark, mixed, DIR)
    assert sorted(r["doc_id"] for r in last.collect()) == sorted(r["doc_id"] for r in mixed.collect())
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, DIR).collect()))


def awkward(tmp_path, spark, rows, labels):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node string, __terms string, size string, key long, target double")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_awkward_rows_pass_all_stages(spark, tmp_path):
    """Nulls in every column, repeated rows, blank and long texts, and columns that are named like the operators' own."""
    from .helpers import documents

    rows = [(*r[:6], "x", r[7], r[6], 1.0) for r in documents()] + [(None,) * 10, (None,) * 10, (7777, "\u00a0", None, None, None, None, None, None, None, None)]
    where = awkward(tmp_path, spark, rows, [(1, 1, 0), (2, 1, 0), (3, 0, 1), (None, None, None), (3, 0, None)])
    docs = spark.read.parquet(f"{where}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialize(stage(spark, docs, where), "t")
        assert kept.columns == docs.columns, name
        assert kept.count() > 0
        docs = kept
    last = corpus_pipeline.run(spark, where)
    assert last.count() == docs.count()
    assert {r["doc_id"] for r in last.collect()} <= {r[0] for r in rows}


def test_empty_tables_pass_all_stages(spark, tmp_path):
    assert corpus_pipeline.run(spark, awkward(tmp_path, spark, [], [])).count() == 0


def test_intermediate_tables_go(spark, tmp_path):
    import pathlib

    from framewright.sources.scratch import scratch_dir

    folder = pathlib.Path(scratch_dir(spark)) / "framewright"
    before = set(folder.iterdir()) if folder.exists() else set()
    corpus_pipeline.run(spark, DIR).count()
    assert [p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before] == ["pipeline-mixing"]
