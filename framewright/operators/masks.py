"""Operators on pixel tables: rows with keys, a frame index i, coordinates and a value or mask."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.functions.pixels import box_area, color_distance, rounded_box, threshold_mask
from framewright.operators.series import last_seen, next_seen


def mask_or(df: DataFrame, frame_keys: list[str], mask: str = "m") -> DataFrame:
    """Union of the masks of all instances or prompts of a frame; null instances count as empty."""
    return df.groupBy(*frame_keys).agg(F.coalesce(F.bool_or(mask), F.lit(False)).alias("any_m"))


def majority_mask(df: DataFrame, pixel_keys: list[str], mask: str = "m") -> DataFrame:
    """Pixels masked in half of their frames, rounded up, or more."""
    n = F.count("*")
    return df.groupBy(*pixel_keys).agg((F.count_if(mask) >= F.floor((n + 1) / 2)).alias("majority_m"))


def own_or_majority(df: DataFrame, pixel_keys: list[str], mask: str = "m", into: str = "union_m") -> DataFrame:
    """Each frame's own mask joined with the majority of all frames; one exchange, no join."""
    w = Window.partitionBy(*pixel_keys)
    enough = F.count_if(mask).over(w) >= F.floor((F.count("*").over(w) + 1) / 2)
    return df.withColumn(into, F.col(mask) | enough)


def accumulated(df: DataFrame, pixel_keys: list[str], value: str) -> DataFrame:
    """Pixelwise maximum over frames."""
    return df.groupBy(*pixel_keys).agg(F.max(value).alias("max_v"))


def never_changed(df: DataFrame, keys: list[str], pixel_keys: list[str], value: str = "v", threshold: float = 8) -> DataFrame:
    """Pixels whose consecutive differences never pass the threshold."""
    from framewright.functions.pixels import scalar_distance

    before = F.lag(value).over(Window.partitionBy(*keys, *pixel_keys).orderBy("i"))
    moved = df.withColumn("__m", F.coalesce(scalar_distance(F.col(value), before) > threshold, F.lit(False)))
    return moved.groupBy(*keys, *pixel_keys).agg((~F.bool_or("__m")).alias("still"))


def sampled_median(df: DataFrame, keys: list[str], pixel_keys: list[str], value: str = "v", samples: int = 100) -> DataFrame:
    """Pixelwise median of evenly sampled frames; the mean of the two middle ones is truncated."""
    spans = df.groupBy(*keys).agg(F.max("i").alias("__last"))
    number = spans.withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
    step = F.col("__last").cast("double") / F.lit(float(max(1, samples - 1)))
    place = F.when(F.col("__j") == samples - 1, F.col("__last")).otherwise(F.floor(F.col("__j") * step))
    picked = number.select(*keys, place.cast("long").alias("i"))
    return picked.join(df, [*keys, "i"]).groupBy(*keys, *pixel_keys).agg(F.floor(F.percentile(value, 0.5)).cast("long").alias("median_v"))


def progress_histogram(df: DataFrame, keys: list[str], progress: str = "progress", bins: int = 100) -> DataFrame:
    """(bin, present) for every bin of each series; 1.0 falls into the last bin."""
    seen = df.select(*keys, F.least(F.floor(F.col(progress) * bins), F.lit(bins - 1)).cast("int").alias("bin")).distinct()
    every = df.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(seen.withColumn("present", F.lit(1)), [*keys, "bin"], "left").select(*keys, "bin", F.coalesce("present", F.lit(0)).alias("present"))


def minmax_mask(df: DataFrame, frame_keys: list[str], value: str = "v", threshold: float = 0.25, into: str = "near_m") -> DataFrame:
    """Values above the threshold after scaling each frame to [0, 1]; constant frames have no mask."""
    w = Window.partitionBy(*frame_keys)
    low = F.min(value).over(w)
    scaled = F.try_divide((F.col(value) - low).cast("double"), (F.max(value).over(w) - low).cast("double"))
    return df.withColumn(into, F.coalesce(scaled > threshold, F.lit(False)))


def split_column(df: DataFrame, frame_keys: list[str], width: int, value: str = "v", left: float = 0.0, right: float = 1.0, channel: str | None = None) -> DataFrame:
    """Column with the strongest horizontal change of each frame, the first of equals, within the borders.

    Where pixels have a row for each ``channel``, a pixel changes as much as the channel that changes most.
    Outside columns count as 0, as do frames without any change; edge columns mirror their neighbour.
    """
    w = Window.partitionBy(*frame_keys, "y", *([channel] if channel else [])).orderBy("x")
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    change = df.withColumn("__g", F.abs(F.coalesce(after - before, F.lit(0))))
    if channel:
        change = change.groupBy(*frame_keys, "y", "x").agg(F.max("__g").alias("__g"))
    inside = (F.col("x") >= int(left * width)) & (F.col("x") < int(right * width))
    sums = change.groupBy(*frame_keys, "x").agg(F.sum("__g").alias("s")).withColumn("s", F.when(inside, F.col("s")).otherwise(0))
    return sums.groupBy(*frame_keys).agg(F.max_by("x", F.struct(F.col("s"), (-F.col("x")).alias("nx"))).alias("split_x"))


def crop(df: DataFrame, x0: Column, y0: Column, x1: Column, y1: Column) -> DataFrame:
    """Pixels of a box, counted from its corner."""
    kept = df.where((F.col("x") >= x0) & (F.col("x") < x1) & (F.col("y") >= y0) & (F.col("y") < y1))
    return kept.withColumn("x", F.col("x") - x0).withColumn("y", F.col("y") - y0)


def canvas_box(box: Column, width: Column, height: Column, erode: int = 2) -> Column:
    """A detected canvas rounded half to even, drawn in by ``erode`` and clamped."""
    b = rounded_box(box, width, height)
    at = lambda i: F.element_at(b, i)
    return F.array(
        F.least(at(1) + erode, width.cast("int")), F.least(at(2) + erode, height.cast("int")), F.greatest(at(3) - erode, F.lit(0)), F.greatest(at(4) - erode, F.lit(0))
    )


def morphology(df: DataFrame, frame_keys: list[str], kernel: int, mode: str, mask: str = "m", times: int = 1, placed: bool = False) -> DataFrame:
    """Dilation or erosion by a square kernel, ``times`` over; an even kernel reaches one further to the left and top.

    Frames are brought together once, for all windows over rows and columns; ``placed`` says that they are already.

    A square kernel is one window along the rows and one along the columns, so a pixel's cost does not
    grow with the kernel's area. Pixels outside the frame, and pixels that are missing, do not count.
    """
    pick = F.max if mode == "dilate" else F.min
    lo, hi = -(kernel // 2), kernel - kernel // 2 - 1
    out = df.select(*frame_keys, "x", "y", mask)
    out = out if placed else out.repartition(*frame_keys)
    for _ in range(times):
        for along, across in (("x", "y"), ("y", "x")):
            out = out.withColumn(mask, pick(mask).over(Window.partitionBy(*frame_keys, across).orderBy(along).rangeBetween(lo, hi)))
    return out


def opened(df: DataFrame, frame_keys: list[str], kernel: int, mask: str = "m", erode: int = 1, dilate: int = 1) -> DataFrame:
    """Erosion, then dilation, each as often as asked."""
    return morphology(morphology(df, frame_keys, kernel, "erode", mask, erode), frame_keys, kernel, "dilate", mask, dilate, placed=True)


def dilate_prompts(df: DataFrame, frame_keys: list[str], kernels: dict[str, int], whole: int = 5, prompt: str = "prompt", mask: str = "m") -> DataFrame:
    """One mask a frame from a mask a prompt: each grown by its prompt's kernel, joined, then grown by ``whole``.

    Prompts without a kernel are joined as they are.
    """
    rest = df.where(~F.col(prompt).isin(*kernels)).select(*frame_keys, "x", "y", mask)
    grown = [morphology(df.where(F.col(prompt) == p), frame_keys, k, "dilate", mask) for p, k in kernels.items()]
    every = reduce(DataFrame.unionByName, grown, rest)
    return morphology(every.groupBy(*frame_keys, "x", "y").agg(F.coalesce(F.bool_or(mask), F.lit(False)).alias(mask)), frame_keys, whole, "dilate", mask)


def difference_mask(df: DataFrame, keys: list[str], pixel_keys: list[str], value: str, threshold: float, above: bool = True, kernel: int = 0) -> DataFrame:
    """Mask ``m`` of the pixels that differ from the frame before by more than the threshold (or not more), opened by a kernel.

    ``value`` is an array of channels, ``pixel_keys`` are x and y. The first frame of a series has no mask.
    """
    before = F.lag(value).over(Window.partitionBy(*keys, *pixel_keys).orderBy("i"))
    moved = df.withColumn("__before", before).where(F.col("__before").isNotNull())
    found = moved.select(*keys, "i", *pixel_keys, threshold_mask(color_distance(F.col(value), F.col("__before")), threshold, above).alias("m"))
    return opened(found, [*keys, "i"], kernel) if kernel else found


def valid_boxes(dets: Column, width: Column, height: Column, max_area: float = 0.25, least: float | None = None) -> Column:
    """Detections with a label, and a score of ``least`` or more, whose clamped box is not empty and covers at most ``max_area`` of the image."""
    named = lambda d: d["label"] != "" if least is None else (d["label"] != "") & (d["score"] >= least)
    boxed = F.transform(
        F.filter(dets, named), lambda d: F.struct(d["label"].alias("label"), d["score"].alias("score"), rounded_box(d["box"], width, height).alias("box"))
    )
    return F.filter(boxed, lambda d: (box_area(d["box"]) > 0) & (box_area(d["box"]) <= F.lit(max_area) * width * height))


def fill_boxes(df: DataFrame, boxes: Column, into: str = "m") -> DataFrame:
    """Mask of the pixels that lie in a box of the row's list."""
    inside = lambda d: (
        (F.col("x") >= F.element_at(d["box"], 1)) & (F.col("x") < F.element_at(d["box"], 3)) & (F.col("y") >= F.element_at(d["box"], 2)) & (F.col("y") < F.element_at(d["box"], 4))
    )
    return df.withColumn(into, F.exists(boxes, inside))


def fill_polygons(df: DataFrame, polygons: Column, into: str = "m") -> DataFrame:
    """Mask of the pixels that lie inside a polygon of the row's list of (x, y) points, by the even-odd rule."""

    def crosses(poly: Column, i: Column) -> Column:
        a, b = F.element_at(poly, i), F.element_at(poly, F.pmod(i, F.size(poly)) + 1)
        spans = (a["y"] > F.col("y")) != (b["y"] > F.col("y"))
        at = a["x"] + (F.col("y") - a["y"]) * F.try_divide(b["x"] - a["x"], b["y"] - a["y"])
        return spans & (F.col("x") < at)

    def inside(poly: Column) -> Column:
        return F.size(F.filter(F.sequence(F.lit(1), F.size(poly)), lambda i: crosses(poly, i))) % 2 == 1

    return df.withColumn(into, F.exists(polygons, inside))


def logo_boxes(pixels: DataFrame, detections: DataFrame, frame_keys: list[str], width: int, height: int, least: float = 0.4, max_area: float = 0.25, into: str = "m") -> DataFrame:
    """``pixels`` with a mask of the valid detections of their frame; frames meet their detections by key, so one without any is empty."""
    kept = detections.select(*frame_keys, valid_boxes(F.col("detections"), F.lit(width), F.lit(height), max_area, least).alias("__boxes"))
    joined = pixels.join(kept, frame_keys, "left")
    none = F.array().cast(kept.schema["__boxes"].dataType)
    return fill_boxes(joined.withColumn("__boxes", F.coalesce("__boxes", none)), F.col("__boxes"), into).drop("__boxes")


def needs_logo_removal(df: DataFrame) -> DataFrame:
    """Rows whose flag is missing or false."""
    return df.where(~F.coalesce(F.col("logo_removed"), F.lit(False)))


def remove_logos(pixels: DataFrame, masks: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """``pixels`` (keys, i, y, x, value, logo_removed) with masked values filled and the flag set.

    Only frames that need it take part. Their masks, one a prompt, are joined by frame and pixel, so a
    frame whose detection failed has none; each frame's own mask is joined with the majority of its series,
    and what is masked takes the last clean value of its pixel, or the next one where there was none before.
    """
    todo = needs_logo_removal(pixels)
    place = [*keys, "i", "y", "x"]
    own = todo.join(mask_or(masks, place), place, "left").withColumn("any_m", F.coalesce("any_m", F.lit(False)))
    marked = own_or_majority(own, [*keys, "y", "x"], "any_m", "__m")
    clean = F.when(~F.col("__m"), F.col(value))
    pixel = [*keys, "y", "x"]
    before, after = last_seen(clean, pixel), next_seen(clean, pixel)
    filled = marked.withColumns({"__f": before, "__b": after}).withColumn(value, F.coalesce("__f", "__b", value)).withColumn("logo_removed", F.lit(True))
    return filled.select(*pixels.columns).unionByName(pixels.where(F.coalesce(F.col("logo_removed"), F.lit(False))))


def first_box(boxes: Column) -> Column:
    """The first detection's box, null without any."""
    return F.try_element_at(boxes, F.lit(1))["box"]


def detect_canvas(meta: DataFrame, boxes: DataFrame, keys: list[str], erode: int = 2, strict: bool = False) -> DataFrame:
    """``meta`` (start_frame_idx, canvas_detected, canvas_coordinates, width, height) with the canvas of its start frame.

    ``boxes`` has the keys, i and detections. Items whose canvas is known stay as they are, and so do those
    without a box. ``strict`` looks at the frame behind the start, as the original's loop does.
    """
    at = F.greatest(F.coalesce("start_frame_idx", F.lit(0)), F.lit(0)) + (1 if strict else 0)
    found = boxes.select(*keys, F.col("i").cast("long").alias("__at"), first_box(F.col("detections")).alias("__box"))
    joined = meta.withColumn("__at", at.cast("long")).join(found, [*keys, "__at"], "left")
    fresh = ~F.coalesce("canvas_detected", F.lit(False)) & F.col("__box").isNotNull()
    box = canvas_box(F.col("__box"), F.col("width"), F.col("height"), erode)
    return joined.withColumns(
        {"canvas_coordinates": F.when(fresh, box).otherwise(F.col("canvas_coordinates")), "canvas_detected": F.coalesce("canvas_detected", F.lit(False)) | fresh}
    ).select(*meta.columns)


def right_half(df: DataFrame, splits: DataFrame, frame_keys: list[str], width: int, margin: int = 2) -> DataFrame:
    """Pixels to the right of each frame's split; a negative split stands for the middle."""
    at = F.when(F.col("split_x") < 0, F.lit(width // 2)).otherwise(F.col("split_x")) + margin
    joined = df.join(splits.select(*frame_keys, at.cast("int").alias("__x0")), frame_keys)
    return joined.where(F.col("x") >= F.col("__x0")).withColumn("x", F.col("x") - F.col("__x0")).drop("__x0")
