"""Blur, sizes and movement against plain numpy restatements."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.operators import filters, movement


def pixel_rows(frames):
    return [(k, i, y, x, int(v)) for (k, i), a in frames.items() for y, row in enumerate(a) for x, v in enumerate(row)]


def frame_of(spark, frames):
    return spark.createDataFrame(pixel_rows(frames), "k long, i long, y int, x int, v long").repartition(3)


def images(df, keys=("k", "i"), value="v"):
    out = {}
    for r in df.collect():
        out.setdefault(tuple(r[c] for c in keys), {})[r["y"], r["x"]] = r[value]
    return {k: np.array([[cells[y, x] for x in range(max(c[1] for c in cells) + 1)] for y in range(max(c[0] for c in cells) + 1)]) for k, cells in out.items()}


def blur_by_hand(a, weights):
    half = len(weights) // 2

    def mirrored(p, n):
        while n > 1 and not 0 <= p < n:
            p = -p if p < 0 else 2 * (n - 1) - p
        return 0 if n == 1 else p

    out = np.zeros_like(a)
    for y in range(a.shape[0]):
        for x in range(a.shape[1]):
            s = sum(wy * wx * int(a[mirrored(y + j - half, a.shape[0]), mirrored(x + i - half, a.shape[1])]) for j, wy in enumerate(weights) for i, wx in enumerate(weights))
            out[y, x] = (s + 32768) >> 16
    return out


@pytest.mark.parametrize(("size", "sigma"), [(1, 1.0), (3, 1.0), (5, 1.5), (7, 2.0)])
def test_blur(spark, size, sigma):
    rng = np.random.default_rng(1)
    frames = {(n, 0): rng.integers(0, 256, shape) for n, shape in enumerate([(1, 1), (1, 2), (2, 11), (3, 3), (8, 8), (6, 13)])}
    frames[9, 0] = np.full((4, 4), 255)
    got = images(filters.blurred(frame_of(spark, frames), ["k", "i"], size=size, sigma=sigma))
    weights = filters.gaussian_kernel(size, sigma)
    assert sum(weights) == 256
    for key, a in frames.items():
        assert (got[key] == blur_by_hand(a, weights)).all()


def test_blur_of_channels(spark):
    a = np.random.default_rng(2).integers(0, 256, (4, 5, 3))
    rows = [(1, 0, y, x, [int(v) for v in a[y, x]]) for y in range(4) for x in range(5)]
    got = filters.blurred(spark.createDataFrame(rows, "k long, i long, y int, x int, v array<long>"), ["k", "i"], channels=3)
    for r in got.collect():
        assert r["v"] == [int(blur_by_hand(a[:, :, c], [70, 116, 70])[r["y"], r["x"]]) for c in range(3)]
    with pytest.raises(ValueError, match="odd"):
        filters.gaussian_kernel(4, 1.0)


def line_by_hand(row, to, kind):
    n = len(row)
    scale = n / to
    coarse = max(scale, 1.0)
    reach = coarse * filters.REACH[kind]

    def weight(t):
        if kind == "box":
            return float(-0.5 < t <= 0.5)
        if kind == "bilinear":
            return max(1 - abs(t), 0.0)
        return np.sinc(t) * np.sinc(t / 3) if -3 <= t < 3 else 0.0

    out = []
    for o in range(to):
        mid = (o + 0.5) * scale
        xs = range(max(int(np.floor(mid - reach + 0.5)), 0), min(int(np.floor(mid + reach + 0.5)), n))
        w = [weight((x - mid + 0.5) / coarse) for x in xs]
        total = sum(int(np.floor(v / sum(w) * 2**22 + 0.5)) * int(row[x]) for v, x in zip(w, xs, strict=True))
        out.append(min(255, max(0, (total + 2**21) >> 22)))
    return out


def resize_by_hand(a, w, h, kind):
    wide = np.array([line_by_hand(r, w, kind) for r in a])
    return np.array([line_by_hand(c, h, kind) for c in wide.T]).T


@pytest.mark.parametrize("kind", ["box", "bilinear", "lanczos"])
def test_resampling(spark, kind):
    rng = np.random.default_rng(3)
    cases = [((5, 7), (9, 3)), ((8, 8), (8, 8)), ((3, 4), (20, 17)), ((17, 20), (2, 3)), ((1, 1), (4, 2)), ((6, 1), (1, 6))]
    frames = {(n, 0): rng.integers(0, 256, shape) for n, (shape, _) in enumerate(cases)}
    sizes = spark.createDataFrame([(n, s[1], s[0], to[0], to[1]) for n, (s, to) in enumerate(cases)], "k long, w int, h int, tw int, th int")
    got = images(filters.resampled(frame_of(spark, frames).join(sizes, "k"), ["k", "i"], ("w", "h"), ("tw", "th"), kind))
    for n, (_, (w, h)) in enumerate(cases):
        want = resize_by_hand(frames[n, 0], w, h, kind)
        assert got[n, 0].shape == (h, w)
        assert np.abs(got[n, 0] - want).max() <= (1 if kind == "lanczos" else 0)  # the sine may differ in its last bit


def test_padding_and_back(spark):
    """Whole factors come back exactly with the area filter, smooth images within one of 255 with any."""
    rng = np.random.default_rng(4)
    frames = {(0, 0): rng.integers(0, 256, (4, 6)), (1, 0): np.array([[10 * x + 7 * y for x in range(6)] for y in range(4)]), (2, 0): np.full((3, 9), 200)}
    sizes = spark.createDataFrame([(0, 6, 4), (1, 6, 4), (2, 9, 3)], "k long, w int, h int")
    df = frame_of(spark, frames).join(sizes, "k")
    for kind in ("box", "bilinear", "lanczos"):
        there = filters.padded(df, ["k", "i"], ("w", "h"), 18, 16, fill=9, kind=kind)
        shown = images(there)
        assert all(a.shape == (16, 18) for a in shown.values())
        assert (shown[0, 0][:4] == 9).all() and (shown[2, 0][:10] == 9).all() and (shown[2, 0][10:] == 200).all()
        back = images(filters.unpadded(there, ["k", "i"], ("w", "h"), 18, 16, kind=kind))
        for key, a in frames.items():
            if kind == "box" or key == (2, 0):
                assert (back[key] == a).all()
        if kind == "lanczos":
            assert np.abs(back[1, 0] - frames[1, 0])[1:-1, 1:-1].max() <= 1
    with pytest.raises(Exception, match="sizes must be positive"):
        filters.unpadded(there.withColumn("w", F.lit(0)), ["k", "i"], ("w", "h"), 18, 16).collect()


def movement_by_hand(frames, past, future, kernel, threshold, erode, dilate):
    lo, hi = -(kernel // 2), kernel - kernel // 2 - 1

    def grown(m, pick):
        out = m.copy()
        for y in range(m.shape[0]):
            for x in range(m.shape[1]):
                out[y, x] = pick(m[max(0, y + lo) : y + hi + 1, max(0, x + lo) : x + hi + 1])
        return out

    out = []
    for i, a in enumerate(frames):
        mask = np.zeros(a.shape, bool)
        for b in frames[max(0, i - past) : i] + frames[i + 1 : i + future]:
            mask |= np.sqrt((a - b) ** 2 % 256) > threshold
            for _ in range(erode):
                mask = grown(mask, np.min)
            for _ in range(dilate):
                mask = grown(mask, np.max)
        out.append(mask)
    return out


@pytest.mark.parametrize(("past", "future", "kernel", "erode", "dilate", "shape"), [(5, 2, 3, 1, 2, (8, 8)), (3, 3, 2, 1, 1, (5, 70)), (4, 1, 5, 1, 1, (3, 130)), (2, 2, 3, 0, 0, (4, 64))])
def test_movement(spark, past, future, kernel, erode, dilate, shape):
    rng = np.random.default_rng(6)
    series = {k: [rng.integers(0, 12, shape) + 6 * (rng.random(shape) < 0.5) for _ in range(n)] for k, n in ((1, 9), (2, 1))}
    frames = {(k, i): a for k, all_ in series.items() for i, a in enumerate(all_)}
    for bucket in (1 << 16, 6):
        got = images(movement.movement_masks(frame_of(spark, frames), ["k"], threshold=7, past=past, future=future, kernel=kernel, erode=erode, dilate=dilate, bucket=bucket), value="m")
        assert set(got) == set(frames)
        for k, all_ in series.items():
            for i, want in enumerate(movement_by_hand(all_, past, future, kernel, 7, erode, dilate)):
                assert (got[k, i] == want).all()
