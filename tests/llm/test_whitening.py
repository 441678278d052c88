"""Whitening against numpy's dense eigenvectors; spectra against dense ones in every degenerate case."""

import math

import numpy as np
import pytest

from framewright.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, component int, n long, x binary"


def brute(rows, kept=4):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} for rows of one length."""
    good = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array(fit, float) - np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in good:
        dev = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for j in range(min(kept, len(x))):
            w = (np.array(x) - np.array(sums) / n) @ vectors[:, j] / math.sqrt(values[j])
            out.setdefault((i, j + 1), []).append((n, dev, abs(w), values[j] / values.sum()))
    return out


def vectors(n=700, d=12):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((n, d)) * np.linspace(0.2, 2, d)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    rows += [(5000 + i, rows[3][1]) for i in range(300)]  # a hot vector
    rows += [(9001, None), (9002, [float("nan")] * d), (9003, [None] + [0.5] * (d - 1)), (9004, [float("inf")] + [0.0] * (d - 1)), (None, rows[1][1]), rows[7], rows[7]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 9, 9, None) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("n_parts", [1, 40])
def test_against_dense(spark, n_parts):
    rows = vectors()
    got = W.report(frame(spark, rows).repartition(n_parts))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got, want = got.collect(), brute(rows)
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((str(i), j) for (i, j), v in want.items() for _ in v)
    for r in got:
        n, dev, white, explained = want[r.vec_id, r.component][0]
        assert (r.n, r.deviation) == (n, dev)
        assert abs(abs(r.whitened) - white) < 1e-9 and abs(r.explained - explained) < 1e-12 and r.identity_error < 1e-9
    at = {(r.vec_id, r.component): r.whitened for r in got}
    assert all(at[3, j] == at[5000, j] for j in range(1, 5))


def test_other_lengths_empty_vectors_and_few_dimensions(spark):
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(30)] + [(100, [1.0]), (101, []), (102, [1.0, 2.0, 3.0])]
    got = W.report(frame(spark, rows)).collect()
    assert sorted((r.vec_id, r.component) for r in got) == [(i, j) for i in range(30) for j in (1, 2)]
    assert W.report(frame(spark, [])).collect() == [] and W.report(frame(spark, [(1, None), (2, [])])).collect() == []


def test_flat_components_and_single_vectors(spark):
    rows = [(i, [float(i), 2.0 * i, 0.25, 0.0, 1.0]) for i in range(20)]
    got = {(r.vec_id, r.component): r for r in W.report(frame(spark, rows)).collect()}
    assert len(got) == 80 and all((r.whitened is None) == (j > 1) for (_, j), r in got.items())
    assert got[4, 1].explained == pytest.approx(1) and got[4, 1].identity_error < 1e-9
    one = W.report(frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect()
    assert len(one) == 4 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, None, None, None)}


def test_huge_entries(spark):
    rows = [(1, [1e30, 1.0]), (2, [-1e30, 0.0]), (3, [2.0**40, 0.5])]
    got = {r.vec_id: r.deviation for r in W.report(frame(spark, rows)).collect()}
    assert got == {1: None, 2: None, 3: None}
    mild = [(i, [float(2**20 + i), 1.0]) for i in range(3)]
    assert {r.vec_id: r.deviation for r in W.report(frame(spark, mild)).collect()} == {0: (3 * 256) ** 2, 1: 0, 2: (3 * 256) ** 2}


RNG = np.random.default_rng(0)
CASES = {
    "more rows than dimensions": RNG.integers(-256, 256, (6000, 24)), "fewer": RNG.integers(-256, 256, (9, 24)), "binary": RNG.integers(0, 2, (300, 24)), "rank 3": np.repeat(RNG.integers(-9, 9, (3, 24)), 20, axis=0),
    "equal eigenvalues": np.eye(24, dtype=int) * 100, "zero": np.zeros((5, 8), int), "graded": (RNG.standard_normal((500, 12)) * 10.0 ** np.arange(12)).astype(np.int64), "one dimension": RNG.integers(0, 9, (50, 1)), "one row": np.arange(6)[None],
}


@pytest.mark.parametrize("name", CASES)
def test_spectrum(name):
    x = CASES[name]
    dense = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    top = max(float(np.abs(dense).max()), 1.0)
    whole, pieces = W.Spectrum(x.shape[1]), W.Spectrum(x.shape[1])
    whole.add(x)
    for part in np.array_split(x, min(3, len(x))):
        one = W.Spectrum(x.shape[1])
        one.add(part)
        pieces.merge(one)
    for s in (whole, pieces):
        assert s.n == len(x) and s.sums == x.sum(axis=0).tolist()
        assert np.abs(s.vectors.T @ s.vectors - np.eye(x.shape[1])).max() < 1e-12
        assert np.abs(s.vectors * s.values @ s.vectors.T - dense).max() < 1e-12 * top * x.shape[1]


def test_secular_roots():
    rng = np.random.default_rng(1)
    for gap in (1.0, 1e-9):
        d = np.cumsum(rng.random(30) * gap + gap * 1e-3)
        z = rng.standard_normal(30) * 10.0 ** rng.integers(-6, 1, 30)
        found, far = W.secular(d, z, 2.0)
        dense = np.linalg.eigvalsh(np.diag(d) + 2 * np.outer(z, z))
        assert np.abs(found - dense).max() < 1e-13 * max(1, dense.max())
        assert (np.diag(far) < 0).all() and (np.diag(far, 1) > 0).all()
        assert np.abs(far - (d - found[:, None])).max() < 1e-13 * max(1, dense.max())
