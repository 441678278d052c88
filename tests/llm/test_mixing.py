import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.llm import mixing

from .helpers import DOCS, documents, frame


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    w = np.array([(5, 2, 1)[i % 3] for i in range(len(sizes))], float)
    s, capped = np.array(sizes, float), np.zeros(len(sizes), bool)
    while not capped.all():
        t = np.where(capped, 2 * s, w * (1.5 * s.sum() - 2 * s[capped].sum()) / w[~capped].sum())
        if not (t > 2 * s).any():
            return t
        capped |= t > 2 * s
    return 2 * s


def filled(spark, sizes):
    rows = [(f"s{i:03d}" if i < len(sizes) - 1 else None, n, 1, i) for i, n in enumerate(sizes)]
    ranked = mixing.ranked_sources(spark.createDataFrame([r[:2] for r in rows], "source string, size long"))
    got = sorted(mixing.water_fill(ranked).collect(), key=lambda r: r["place"])
    assert [r["source"] for r in got] == [r[0] for r in rows]
    return [r["target"] for r in got]


def test_targets(spark):
    # 45 words at 5 : 2 : 1; the first stops at 20 and the other 25 go 2 : 1.
    assert filled(spark, [10, 10, 10]) == pytest.approx([20, 50 / 3, 25 / 3])
    rng = np.random.default_rng(2)
    for sizes in ([100, 1, 50], [7], [0, 0], [5, 0, 1000, 3, 3], rng.integers(0, 3000, 60).tolist()):
        t = np.array(filled(spark, sizes))
        assert t == pytest.approx(plain_targets(sizes))
        assert t.sum() == pytest.approx(1.5 * sum(sizes))
        assert (t <= 2 * np.array(sizes) + 1e-9).all()


def test_quotas_are_exact():
    blocks, room = np.array([1, 0, 17, 900]), np.array([100, 200, 0, 318, 150, 150])
    q = mixing.split_quotas(blocks, room, 3)
    assert (q.sum(axis=1) == blocks).all()
    assert (q.sum(axis=0) == room).all()
    assert (q == mixing.split_quotas(blocks, room, 3)).all()
    mean = np.mean([mixing.split_quotas(blocks, room, i) for i in range(400)], axis=0)
    assert mean == pytest.approx(blocks[:, None] * room[None, :] / blocks.sum(), abs=1.5)


@pytest.mark.parametrize("lot", [4096, 3])
def test_deal_over_lots(spark, monkeypatch, lot):
    monkeypatch.setattr(mixing, "LOT", lot)
    units = [(f"s{i:02d}", i, (i * 7) % 11) for i in range(20)]
    got = {r["source"]: np.diff([0, *r["dealt"]]) for r in mixing.deal(spark.createDataFrame(units, "source string, place long, n long"), 5, 1).collect()}
    assert all(got[s].sum() == n for s, _, n in units)
    total = sum(n for *_, n in units)
    assert sum(got.values()).tolist() == np.diff(total * np.arange(6) // 5).tolist()


def corpus():
    return documents() + [(10_000 + i, f"w{i} " * (i % 7 + 1), "en", f"s{i % 5}", 1, "", 1, "") for i in range(600)]


def test_report(spark):
    rows = corpus()
    got = mixing.mix_report(frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], size(r[1])) for r in rows)
    source_of = {r[0]: r[3] for r in rows}
    totals, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        totals[r[3]] += size(r[1])
    for r in got:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == totals[s]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
        target[s] = r["target"]
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    assert [target[s] for s in order] == pytest.approx(plain_targets([totals[s] for s in order]).tolist())
    for s in order:
        if s in ("s0", "s3", "s4"):  # without very long documents
            assert abs(taken[s] - target[s]) <= 3
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix_report(frame(spark, rows).repartition(5)).collect()), key=repr)


def test_draws_follow_the_quotas(spark):
    rows = list({r[0]: r for r in corpus() if r[0] is not None}.values())
    sized, decisions = mixing.plan(frame(spark, rows), shards=4)
    source_of = {r[0]: r[3] for r in rows}
    own = decisions.withColumnRenamed("source", "o")
    drawn = sized.join(own, sized["source"].eqNullSafe(F.col("o"))).select("doc_id", F.explode(mixing.draws_column()).alias("d")).collect()
    blocks, of = defaultdict(set), defaultdict(list)
    for r in drawn:
        s, d = source_of[r["doc_id"]], r["d"]
        blocks[s, d["shard"]].add((d["pass"], d["block"]))
        of[s, d["pass"], d["block"]].append(d["shard"])
    for r in decisions.collect():
        quota = np.diff([0, *r["dealt"]])
        for shard in range(4):
            # Places go round the blocks of a pass, one pass after the other; a block may be without documents.
            a, b = ([0, *r["dealt"]][shard], r["dealt"][shard])
            runs = {divmod(p, r["n_blocks"]) for p in range(a, b)}
            assert blocks[r["source"], shard] <= runs
            assert len(runs) == quota[shard]
    assert all(len(set(shards)) == 1 for shards in of.values())
    assert len({k[1] for k in blocks}) == 4


def test_without_quotas_nothing_is_drawn(spark, monkeypatch):
    empty = lambda units, shards, seed: units.select("source", F.array_repeat(F.lit(0).cast("long"), shards).alias("dealt"))
    monkeypatch.setattr(mixing, "deal", empty)
    assert {r["taken"] for r in mixing.mix_report(frame(spark, corpus())).collect()} == {0}
    assert mixing.mix(frame(spark, corpus())).count() == 0


def test_draws_agree_with_the_report(spark):
    rows = list({r[0]: r for r in documents() if r[0] is not None}.values())
    drawn = mixing.mix(frame(spark, rows), shards=4)
    assert drawn.columns == [c.split()[0] for c in DOCS.split(", ")] + ["__shard", "__order"]
    words, text = Counter(), {r[0]: r[1] for r in rows}
    for r in drawn.collect():
        assert 0 <= r["__shard"] < 4
        assert r["text"] == text[r["doc_id"]]
        words[r["doc_id"]] += size(r["text"])
    want = {r["doc_id"]: r["taken"] for r in mixing.mix_report(frame(spark, rows)).collect() if r["taken"]}
    assert {k: v for k, v in words.items() if v} == want


def test_empty_table(spark):
    assert mixing.mix_report(frame(spark, [])).count() == 0
    assert mixing.mix(frame(spark, [])).count() == 0
