import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.llm import toxicity

from .helpers import WORDS, documents, frame, sentence


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        words = sentence(rng, rng.choice([20, 60, 200])).split()
        for _ in range(rng.randint(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["nastyone", "nastier", "vileness"]))
        rows.append((i, " ".join(words), "en", "s", 1, "", 1, ""))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    got = {r["doc_id"]: r for r in toxicity.report(frame(spark, rows), table(spark, labels)).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.5)
    held = [(got[i]["predicted"], t) for i, _, t in labels if got[i]["held_out"]]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)


def test_held_out_labels_teach_nothing(spark):
    rows, labels = corpus()
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (sorted(map(tuple, toxicity.report(frame(spark, rows), table(spark, x)).collect())) for x in (labels, flipped))
    assert a == b


def test_awkward_documents(spark):
    rows, labels = corpus(120)
    rows = documents() + [(5000 + r[0], *r[1:]) for r in rows]
    labels = [(5000 + i, q, t) for i, q, t in labels] + [(5001, 0, 1), (None, 1, 1), (1, 1, None), (999_999, 1, 1)]
    got = toxicity.report(frame(spark, rows), table(spark, labels)).collect()
    assert len(got) == len(rows)
    assert all(r["score"] is not None and r["held_out"] is not None for r in got)
    stays = toxicity.reject(frame(spark, rows), table(spark, labels))
    assert stays.columns == frame(spark, []).columns
    assert stays.count() == sum(r["score"] < 0.5 for r in got)


def test_no_labels_and_no_documents(spark):
    got = toxicity.report(frame(spark), table(spark, [])).collect()
    assert {r["score"] for r in got} == {0.0}
    assert toxicity.report(frame(spark, []), table(spark, [(1, 1, 1)])).count() == 0
    assert toxicity.reject(frame(spark), table(spark, [])).count() == len(documents())


def test_neighbours_are_exact():
    rng = np.random.default_rng(3)
    n_terms = 60
    sets = [np.unique(rng.integers(0, n_terms, rng.integers(0, 12))) for _ in range(500)]
    index = toxicity.BlockMaxIndex(sets, rng.integers(0, 2, 500).astype(float), np.ones(500), rng.random(n_terms) + 0.5)
    dense = np.zeros((len(index.vectors), n_terms))
    for i, (t, v) in enumerate(index.vectors):
        dense[i, t] = v
    for _ in range(100):
        t = np.unique(rng.integers(0, n_terms, rng.integers(1, 9)))
        terms, value = index.weigh(t)
        places, cosines = index.nearest(terms, value, k=7)
        exact = dense[:, terms] @ value
        order = np.lexsort((np.arange(len(exact)), -exact))
        order = order[exact[order] > 0][:7]
        assert np.allclose(exact[order], cosines)
        assert np.allclose(exact[places], cosines)


def test_words_reach_the_vocabulary():
    assert WORDS and toxicity.chunk_stems("Nastyone's") == ["nast", "nasty", "nastyo", "nastyon", "nastyone", "s"]
    rows = [("nast", 1, 5, 0), ("nasty", 1, 5, 0), ("nas", 1, 6, 0)]
    assert toxicity.select_terms(rows, 9) == [("nas", 1), ("nasty", 1)]


def test_crc_matches(spark):
    got = spark.range(50).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)


def test_all_terms_that_pass_count_at_any_sample_size(spark):
    rng = random.Random(5)
    insults = [f"z{a}{b}{c}" for a in "bcdfghjklmn" for b in "aeiou" for c in "bcdfghjklmnpqrstvwxz"]
    rows = [(i, " ".join([*sentence(rng, 20).split(), *(rng.sample(insults, 400) if i % 20 == 0 else [])]), "en", "s", 1, "", 1, "") for i in range(1500)]
    labels = [(i, 1, int(i % 5 == 0)) for i in range(1500)]
    rare = [i for i in range(5, 1500, 20) if zlib.crc32(str(i).encode()) % 5][:4]
    rows = [(r[0], r[1] + " grotwurm", *r[2:]) if r[0] in rare else r for r in rows]
    index, _, _ = toxicity.fit(frame(spark, rows), table(spark, labels).drop("quality"), F.lit(True))
    assert ("grotwurm", 1) in index.vocabulary
    assert {(x, 1) for x in insults} <= set(index.vocabulary)


def test_repeated_labelled_rows_count_once(spark):
    rows, labels = corpus(200)
    taught = [i for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 and t][:1] + [i for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 and not t][:1]
    plain, _, _ = toxicity.fit(frame(spark, rows), table(spark, labels), ~toxicity.held_out(F.col("doc_id")))
    want = {r["doc_id"]: r["predicted"] for r in toxicity.report(frame(spark, rows), table(spark, labels)).collect()}
    assert plain.vocabulary and 1 in want.values()
    for own in taught:
        more = rows + [rows[own]] * 300
        index, _, _ = toxicity.fit(frame(spark, more), table(spark, labels), ~toxicity.held_out(F.col("doc_id")))
        assert sorted(index.vocabulary) == sorted(plain.vocabulary)
        got = toxicity.report(frame(spark, more), table(spark, labels)).collect()
        assert len(got) == len(more)
        assert {r["doc_id"]: r["predicted"] for r in got} == want


def test_scores_against_a_dense_twin(spark):
    """Features, votes and calibration once more by plain loops over dense vectors."""
    rows, labels = corpus(150, seed=8)
    docs, table_ = frame(spark, rows), table(spark, labels)
    index, _, _ = toxicity.fit(docs, table_, ~toxicity.held_out(F.col("doc_id")))
    place = {t: i for i, t in enumerate(index.vocabulary)}

    def terms(text):
        found = {}
        for chunk in text.split():
            for stem in toxicity.chunk_stems(chunk):
                found[stem] = found.get(stem, 0) + 1
        return {place[s, t] for s, n in found.items() for t in toxicity.TIERS if n >= t and (s, t) in place}

    sets = {r[0]: terms(r[1]) for r in rows}
    idf = {t: math.log((len(rows) + 1) / (sum(t in s for s in sets.values()) + 1)) + 1 for t in place.values()}
    norm = lambda s: math.sqrt(sum(idf[t] ** 2 for t in s))
    truth = {i: t for i, _, t in labels}
    taught = [i for i in truth if zlib.crc32(str(i).encode()) % 5]
    lead = lambda s: (max(s, key=lambda t: (idf[t], -t)), -max(idf[t] / norm(s) for t in s))
    order = sorted((i for i in taught if sets[i]), key=lambda i: (*lead(sets[i]), i))
    base = sum(truth[i] for i in taught) / len(taught)
    blank = [truth[i] for i in taught if not sets[i]]

    def vote(s, skip=None):
        cos = [(sum(idf[t] ** 2 for t in s & sets[i]) / norm(s) / norm(sets[i]), -n, truth[i]) for n, i in enumerate(order) if i != skip and s & sets[i]] if s else []
        near = sorted(cos, reverse=True)[: toxicity.NEIGHBOURS]
        if not near:
            return (sum(blank) + base) / (len(blank) + 1)
        w = [c * c for c, _, _ in near]
        return (sum(x * y for x, (_, _, y) in zip(w, near, strict=True)) + toxicity.DAMPING * base) / (sum(w) + toxicity.DAMPING)

    votes = {i: vote(sets[i]) for i in sets}
    got = {r["doc_id"]: r["score"] for r in toxicity.report(docs, table_).collect()}
    for i, s in got.items():
        assert s == pytest.approx(index.score(votes[i]), abs=1e-6)
    cases = sorted([(vote(sets[i], i), truth[i]) for i in order] + [(vote(set()), y) for y in blank])
    for v, y in zip(*index.steps, strict=True):
        below = [t for x, t in cases if x <= v + 1e-9]
        assert 0 <= y <= 1 and below
    assert list(index.steps[1]) == sorted(index.steps[1])


def test_examples_are_bounded_by_texts(spark):
    """One labelled doc_id has 3,000 different texts: the sample keeps to its bounds and stands for all."""
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text")).unionByName(spark.createDataFrame([(8, "one"), (9, "two")], "doc_id long, text string"))
    drawn = spark.createDataFrame([(7, 0, 2.0), (8, 1, 1.0), (9, 0, 2.0)], "doc_id long, toxic int, stands_for double")
    got = toxicity.examples_of(docs, drawn, max_toxic=20, max_clean=50)
    rows = got.collect()
    assert got.columns == ["doc_id", "toxic", "stands_for", "text"]
    assert sum(r.toxic == 1 for r in rows) == 1 and sum(r.toxic == 0 for r in rows) == 50
    assert [(r.doc_id, r.stands_for) for r in rows if r.toxic] == [(8, 1.0)]
    assert sum(r.stands_for for r in rows if not r.toxic) == pytest.approx(2.0, rel=0.2) or any(r.doc_id == 9 for r in rows)
