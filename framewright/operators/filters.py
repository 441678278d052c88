"""Filters on pixel tables: the 8-bit Gaussian blur, resampling, padding and its inverse.

Frames are complete grids: every x from 0 to the width and every y from 0 to the height has a row.
"""

from __future__ import annotations

from math import exp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def gaussian_kernel(size: int, sigma: float) -> list[int]:
    """Weights in 256ths that add up to 256; what rounding a weight leaves goes to the next one towards the middle."""
    if size % 2 == 0 or size < 1:
        raise ValueError("the kernel must be odd")
    half = size // 2
    raw = [exp(-((j - half) ** 2) / (2 * sigma * sigma)) for j in range(size)]
    side, left = [], 0.0
    for j in range(half):
        exact = 256 * raw[j] / sum(raw) + left
        side.append(round(exact))
        left = exact - side[-1]
    return [*side, 256 - 2 * sum(side), *reversed(side)]


def _mirrored(place: Column, n: Column) -> Column:
    """Places beyond the border, reflected about the outermost pixel."""
    period = F.greatest(2 * (n - 1), F.lit(1))
    p = F.pmod(place, period)
    return F.when(n == 1, 0).when(p < n, p).otherwise(period - p).cast("int")


def blurred(df: DataFrame, frame_keys: list[str], value: str = "v", size: int = 3, sigma: float = 1.0, channels: int = 0) -> DataFrame:
    """``df`` with its 8-bit values blurred, borders mirrored, and rounded once, half up, after both directions.

    With ``channels`` the value is an array of so many. A frame is one task's work for both directions.
    """
    weights, half = gaussian_kernel(size, sigma), size // 2
    out = df.repartition(*frame_keys)
    for along, across in (("x", "y"), ("y", "x")):
        line = Window.partitionBy(*frame_keys, across)
        near = F.collect_list(value).over(line.orderBy(along).rowsBetween(-half, half))
        out = out.withColumns({"__near": near, "__n": F.max(along).over(line) + 1})
        first = F.greatest(F.col(along) - half, F.lit(0))
        at = [(_mirrored(F.col(along) + j - half, F.col("__n")) - first + 1).cast("int") for j in range(size)]

        def total(pick, at=at):
            return sum((pick(F.element_at("__near", a)) * w for a, w in zip(at[1:], weights[1:], strict=True)), pick(F.element_at("__near", at[0])) * weights[0])

        new = F.array(*(total(lambda p, c=c: F.element_at(p, c)) for c in range(1, channels + 1))) if channels else total(lambda p: p)
        out = out.withColumn(value, new).drop("__near", "__n")
    rounded = lambda s: F.shiftright(s.cast("long") + 32768, 16)
    return out.withColumn(value, F.transform(value, rounded) if channels else rounded(F.col(value)))


#: How far a filter reaches, in pixels of the coarser image.
REACH = {"box": 0.5, "bilinear": 1.0, "lanczos": 3.0}
_BITS = 22


def _weight(kind: str, t: Column) -> Column:
    if kind == "box":
        return F.when((t > -0.5) & (t <= 0.5), 1.0).otherwise(0.0)
    if kind == "bilinear":
        return F.greatest(1.0 - F.abs(t), F.lit(0.0))
    sinc = lambda u: F.when(u == 0, 1.0).otherwise(F.sin(u * F.pi()) / (u * F.pi()))
    return F.when((t >= -3.0) & (t < 3.0), sinc(t) * sinc(t / 3.0)).otherwise(0.0)


def _resampled(df: DataFrame, keys: list[str], along: str, n: Column, to: Column, kind: str, value: str) -> DataFrame:
    """One direction: each pixel gives its share to the places that it reaches, which add them up in whole numbers."""
    scale = n.cast("double") / to
    coarse = F.greatest(scale, F.lit(1.0))
    reach = coarse * REACH[kind]
    sized = df.withColumns({"__scale": scale, "__coarse": coarse, "__reach": reach, "__n": n, "__to": to})
    low = F.floor((F.col(along) + 0.5 - F.col("__reach")) / F.col("__scale") - 1.5)
    high = F.ceil((F.col(along) + 0.5 + F.col("__reach")) / F.col("__scale") + 0.5)
    places = F.sequence(F.greatest(low, F.lit(0)), F.least(high, F.col("__to") - 1))
    spread = sized.withColumn("__o", F.explode(places))
    middle = (F.col("__o") + 0.5) * F.col("__scale")
    first = F.greatest(F.floor(middle - F.col("__reach") + 0.5), F.lit(0))
    last = F.least(F.floor(middle + F.col("__reach") + 0.5), F.col("__n")) - 1
    spread = spread.withColumns({"__middle": middle, "__first": first, "__last": last}).where((F.col(along) >= F.col("__first")) & (F.col(along) <= F.col("__last")))
    weight = lambda x: _weight(kind, (x - F.col("__middle") + 0.5) / F.col("__coarse"))
    whole = F.aggregate(F.sequence("__first", "__last"), F.lit(0.0), lambda s, x: s + weight(x))
    share = F.floor(weight(F.col(along)) / whole * (1 << _BITS) + 0.5)
    total = spread.withColumn("__part", share * F.col(value)).groupBy(*keys, F.col("__o").cast("int").alias(along)).agg(F.sum("__part").alias(value))
    byte = F.shiftright(F.col(value) + (1 << (_BITS - 1)), _BITS)
    return total.withColumn(value, F.greatest(F.lit(0), F.least(F.lit(255), byte)).cast("long"))


def resampled(df: DataFrame, frame_keys: list[str], size: tuple[str, str], to: tuple[str, str], kind: str = "lanczos", value: str = "v") -> DataFrame:
    """(frame_keys, size, to, y, x, value): frames of ``size`` (names of their width and height columns) at the size ``to``.

    Rows first, then columns, each rounded to 8 bits. ``kind`` is box (area), bilinear or lanczos; where an image shrinks, the filter grows with
    its pixels. Weights are whole numbers of 22 bits, so sums do not depend on their order.
    """
    keys = [*frame_keys, *size, *to]
    wide = _resampled(df.select(*keys, "y", "x", value), [*keys, "y"], "x", F.col(size[0]), F.col(to[0]), kind, value)
    return _resampled(wide, [*keys, "x"], "y", F.col(size[1]), F.col(to[1]), kind, value).select(*keys, "y", "x", value)


def fitted(width: Column, height: Column, to_width: int, to_height: int) -> tuple[Column, Column]:
    """The largest size of an image's ratio within a frame, rounded half to even, at least one pixel each way."""
    scale = F.least(F.lit(float(to_width)) / width, F.lit(float(to_height)) / height)
    side = lambda n: F.greatest(F.lit(1), F.bround(n * scale, 0).cast("int"))
    return side(width), side(height)


def padded(df: DataFrame, frame_keys: list[str], size: tuple[str, str], to_width: int, to_height: int, fill: int = 0, kind: str = "lanczos", value: str = "v") -> DataFrame:
    """(frame_keys, size, y, x, value): each frame fitted into ``to_width`` x ``to_height``, at the bottom right, the rest filled."""
    w, h = fitted(F.col(size[0]), F.col(size[1]), to_width, to_height)
    keys = [*frame_keys, *size]
    image = resampled(df.withColumns({"__w": w, "__h": h}), frame_keys, size, ("__w", "__h"), kind, value)
    placed = image.select(*keys, (F.col("y") + to_height - F.col("__h")).cast("int").alias("y"), (F.col("x") + to_width - F.col("__w")).cast("int").alias("x"), value)
    # One row a frame: its first pixel.
    frames = df.where("x = 0 and y = 0").select(*keys, w.alias("__w"), h.alias("__h"))
    cells = frames.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(to_height - 1)))).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(to_width - 1))))
    rest = cells.where((F.col("x") < to_width - F.col("__w")) | (F.col("y") < to_height - F.col("__h")))
    return placed.unionByName(rest.select(*keys, "y", "x", F.lit(fill).cast("long").alias(value)))


def unpadded(df: DataFrame, frame_keys: list[str], size: tuple[str, str], to_width: int, to_height: int, kind: str = "lanczos", value: str = "v") -> DataFrame:
    """What ``padded`` did, undone: the image cut out of its frame and brought back to ``size``; sizes under one pixel raise an error."""
    bad = (F.col(size[0]) <= 0) | (F.col(size[1]) <= 0)
    checked = df.withColumn(size[0], F.when(bad, F.raise_error(F.lit("sizes must be positive")).cast("int")).otherwise(F.col(size[0])))
    w, h = fitted(F.col(size[0]), F.col(size[1]), to_width, to_height)
    inner = checked.withColumns({"__w": w, "__h": h}).where((F.col("x") >= to_width - F.col("__w")) & (F.col("y") >= to_height - F.col("__h")))
    moved = inner.withColumns({"x": F.col("x") - to_width + F.col("__w"), "y": F.col("y") - to_height + F.col("__h")})
    targets = moved.withColumns({"__tw": F.col(size[0]), "__th": F.col(size[1])})
    return resampled(targets, [*frame_keys, *size], ("__w", "__h"), ("__tw", "__th"), kind, value).select(*frame_keys, *size, "y", "x", value)
