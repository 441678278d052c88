"""Movement masks: differences to the frames around, with erosion and dilation after each of them.

A pixel's differences to the frames of its window are one window; a frame's differences to one neighbour are then
packed, a bit a pixel, into 64-bit words of its rows. Erosion and dilation work on whole words, and an ordered fold over the window joins
each difference into the mask before it is eroded and dilated again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.pixels import color_distance, scalar_distance
from framewright.operators.series import BUCKET, bucketed

_WORD = 64


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it stands there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _shifted(rows: Column, by: int, words: Column) -> Callable[[Column, Column], Column]:
    """What bits x + ``by`` of each row's words are, as bits x."""
    k = abs(by)

    def one(v: Column, at: Column) -> Column:
        if by == 0:
            return v
        if by > 0:
            beyond = F.when(at % words < words - 1, F.shiftleft(F.get(rows, at + 1), _WORD - k)).otherwise(F.lit(0).cast("long"))
            return F.shiftrightunsigned(v, k).bitwiseOR(beyond)
        beyond = F.when(at % words > 0, F.shiftrightunsigned(F.get(rows, at - 1), _WORD - k)).otherwise(F.lit(0).cast("long"))
        return F.shiftleft(v, k).bitwiseOR(beyond)

    return one


def dilated_words(rows: Column, full: Column, words: Column, kernel: int) -> Column:
    """A mask (64-bit words, row after row) grown by a square kernel below 64; ``full`` has the bits inside the frame."""
    lo, hi = -(kernel // 2), kernel - kernel // 2 - 1

    def along(a: Column) -> Column:
        def joined(v: Column, at: Column) -> Column:
            out = v
            for by in range(lo, hi + 1):
                out = out.bitwiseOR(_shifted(a, by, words)(v, at)) if by else out
            return out.bitwiseAND(F.get(full, at))

        return F.transform(a, joined)

    def across(a: Column) -> Column:
        def joined(v: Column, at: Column) -> Column:
            out = v
            for by in range(lo, hi + 1):
                place = at + by * words
                out = out.bitwiseOR(F.when(place >= 0, F.coalesce(F.get(a, place), F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long"))) if by else out
            return out

        return F.transform(a, joined)

    return _let(_let(rows, along), across)


def eroded_words(rows: Column, full: Column, words: Column, kernel: int) -> Column:
    """The same for erosion; what lies outside the frame does not count."""
    turned = lambda a: F.zip_with(a, full, lambda v, f: F.bitwise_not(v).bitwiseAND(f))
    return turned(dilated_words(turned(rows), full, words, kernel))


def movement_masks(
    df: DataFrame, keys: list[str], value: str = "v", threshold: float = 8, past: int = 30, future: int = 2, kernel: int = 3, erode: int = 1, dilate: int = 2, channels: bool = False, bucket: int = BUCKET
) -> DataFrame:
    """(keys, i, y, x, m): has a pixel moved against the frames in [i - past, i + future), its own left out?

    After each frame of the window, the past ones first, the mask so far is eroded and dilated, ``erode`` and ``dilate`` times, by a
    square kernel below 64. With ``channels`` the value is an array. Frames are complete grids.
    """
    if not 0 < kernel < _WORD:
        raise ValueError("the kernel must be below 64")
    pixel, frames = [*keys, "y", "x"], past + future - 1
    rows, order = bucketed(df.select(*pixel, "i", value), pixel, past, future - 1, bucket)
    band = F.collect_list(value).over(order.rowsBetween(-past, future - 1))
    near = rows.withColumn("__near", band).where("__own").drop("__b", "__own")
    distance = color_distance if channels else scalar_distance
    moved = near.withColumn("__d", F.transform("__near", lambda other: distance(F.col(value), other) > threshold))
    # Without the frame itself, which stands behind all past ones.
    own = F.least(F.col("i"), F.lit(past)).cast("int")
    moved = moved.withColumn("__d", F.concat(F.slice("__d", F.lit(1), own), F.slice("__d", own + 2, F.lit(frames)))).repartition(*keys, "i")
    bit = F.expr(f"shiftleft(1L, cast(x % {_WORD} as int))")
    step = lambda j: F.bit_or(F.when(F.try_element_at("__d", F.lit(j + 1)), bit).when(F.try_element_at("__d", F.lit(j + 1)).isNotNull(), F.lit(0).cast("long")))
    word = F.floor(F.col("x") / _WORD).cast("int").alias("w")
    packed = moved.groupBy(*keys, "i", "y", word).agg(F.bit_or(bit).alias("full"), F.array_compact(F.array(*(step(j) for j in range(frames)))).alias("steps"))
    whole = packed.groupBy(*keys, "i").agg(F.sort_array(F.collect_list(F.struct("y", "w", "full", "steps"))).alias("__rows"))
    whole = whole.withColumns({"__full": F.transform("__rows", lambda r: r["full"]), "__words": F.array_max(F.transform("__rows", lambda r: r["w"])) + 1})
    full, words = F.col("__full"), F.col("__words")

    def after(mask: Column, j: Column) -> Column:
        out = F.zip_with(mask, F.transform("__rows", lambda r: F.get(r["steps"], j)), lambda a, b: a.bitwiseOR(b))
        for _ in range(erode):
            out = eroded_words(out, full, words, kernel)
        for _ in range(dilate):
            out = dilated_words(out, full, words, kernel)
        return out

    count = F.size(F.get("__rows", F.lit(0))["steps"])
    steps = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    mask = F.aggregate(steps, F.transform("__rows", lambda r: F.lit(0).cast("long")), after)
    cells = whole.select(*keys, "i", F.explode(F.zip_with("__rows", mask, lambda r, m: F.struct(r["y"].alias("y"), r["w"].alias("w"), r["full"].alias("full"), m.alias("m")))).alias("c"))
    bits = cells.select(*keys, "i", "c.*").withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(_WORD - 1))))
    at = lambda c: F.expr(f"shiftrightunsigned({c}, b) & 1") == 1
    return bits.where(at("full")).select(*keys, "i", "y", (F.col("w") * _WORD + F.col("b")).cast("int").alias("x"), at("m").alias("m"))
