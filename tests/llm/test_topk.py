import math
import random

import numpy as np
from pyspark.sql import functions as F

from framewright.llm import topk
from framewright.llm.topk import quantize, search


def brute(rows, k, asked):
    q = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q.setdefault(i, []).append(tuple(math.floor(256 * x) for x in v))
    out = []
    for i in sorted(q):
        if asked(i):
            for v in dict.fromkeys(q[i]):
                scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, ws in q.items() if j != i for w in dict.fromkeys(ws) if len(w) == len(v)]
                out += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return out


def run(spark, rows, k=5, asked=lambda i: i % 5 == 0):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string, v string").repartition(3)
    vectors = df.select("vec_id", quantize(F.col("embedding")).alias("v"))
    got = search(vectors, vectors.where("vec_id % 5 = 0"), k).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute([r[:2] for r in rows], k, asked)


def test_against_all_pairs(spark):
    rng = random.Random(1)
    f = lambda: rng.randrange(-64, 65) / 64
    rows = [(i, [f() for _ in range(9)], "", "") for i in range(150)]
    same = [f() for _ in range(9)]
    rows += [(200 + i, same, "", "") for i in range(40)]  # more equal vectors than any list holds
    rows += [(300, None, "", ""), (301, [1.0, None] + [0.0] * 7, "", ""), (305, [float("nan")] * 9, "", ""), (306, [float("inf")] * 9, "", ""), (None, same, "", ""), (310, [0.5], "", ""), (315, [0.25], "", ""), rows[3]]
    run(spark, rows)


def test_few_and_none(spark):
    run(spark, [(0, [1.0, 2.0], "", ""), (1, [-1.0, 0.5], "", "")])
    run(spark, [(5, [1.0, 2.0], "", "")])
    run(spark, [])


def test_large_components(spark):
    run(spark, [(i, [float(2**20 + i), -float(2**19 * i), 1.5], "", "") for i in range(12)])


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "HELD", 2)
    rng = random.Random(4)
    run(spark, [(i, [rng.randrange(-64, 65) / 64 for _ in range(6)], "", "") for i in range(400)])


def test_cutoffs_spare_tails_and_blocks():
    rng = np.random.default_rng(1)
    energy = np.array([400] * 8 + [3] * 8)
    q, c = (rng.integers(-256, 257, (n, 16)) * energy // 256 for n in (50, 2000))
    full = q @ c.T
    cutoff = np.sort(full, axis=1)[:, -5]
    rows, cols, score, resolved = topk.above(q, c, cutoff)
    assert len(rows) == 250
    assert (score == full[rows, cols]).all()
    assert resolved < full.size / 20
    # A block of short vectors is passed over, one without cutoffs is resolved wholly.
    assert topk.above(q, c // 50, cutoff)[3] == 0
    rows, cols, score, resolved = topk.above(q, c, np.full(50, np.iinfo(np.int64).min))
    assert resolved == len(rows) == full.size
    for few in (1, 3):
        rows, cols, score, _ = topk.above(q, c[:few], np.full(50, -(10**12)))
        assert sorted(zip(rows.tolist(), cols.tolist(), score.tolist(), strict=True)) == [(i, j, int(full[i, j])) for i in range(50) for j in range(few)]


def test_local_lists_give_a_safe_cutoff():
    rng = np.random.default_rng(2)
    q, c = rng.integers(-300, 300, (20, 9)), rng.integers(-300, 300, (500, 9))
    ok = rng.random((20, 500)) < 0.9
    best, cols = topk.best_heads(q, c, ok, 5)
    full = np.where(ok, q @ c.T, np.iinfo(np.int64).min)
    assert (best.min(axis=1) <= np.sort(full, axis=1)[:, -5]).all()
    assert (np.take_along_axis(full, cols, axis=1) == best).all()


def met(q, c, ids, cutoffs, k):
    """Rows that one task makes of two query blocks against one candidate block, with and without a cutoff."""
    import pyarrow as pa

    row = {"dim": q.shape[1], "q_ids": list(range(-len(q), 0)), "q_matrix": q.astype(np.int64).tobytes(), "cutoffs": cutoffs, "first": list(range(len(c) + 1)), "ids": ids, "matrix": c.astype(np.int64).tobytes()}
    batch = pa.RecordBatch.from_pylist([row | {"block": b} for b in (1, 2)])
    lists = [r for out in topk._local_lists(k)(iter([batch])) for r in out.to_pylist()]
    return lists, [r for out in topk._above(k)(iter([batch])) for r in out.to_pylist()]


def test_equal_scores_give_k_rows_a_query_and_task():
    k, n = 5, 4096
    rng = np.random.default_rng(5)
    ids = sorted(rng.choice(10**6, n, replace=False).tolist())
    zero = np.zeros((64, 8), np.int64)
    zero[:, 0] = 7
    other = np.zeros((n, 8), np.int64)
    other[:, 5] = 9
    sparse = (rng.random((n, 8)) < 0.1).astype(np.int64)
    for c in (other, sparse):
        for cutoffs in ([None] * 64, [{"score": 0, "vec_id": ids[k - 1]}] * 64):
            lists, found = met(zero, c, ids, cutoffs, k)
            assert len(lists) == len(found) == 2 * 64 * k
            want = sorted(range(n), key=lambda i: (-(zero[0] @ c[i]), ids[i]))[:k]
            for out in (found, lists if c is other else found):
                assert sorted(r["vec_id"] for r in out if r["query_id"] == -1) == sorted([ids[i] for i in want] * 2)


def test_mostly_equal_scores(spark):
    run(spark, [(i, [1.0, 0.0, 0.0] if i % 5 == 0 else [0.0, float(i % 2), 0.0], "", "") for i in range(600)])
