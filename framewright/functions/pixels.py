"""Column functions on channel values: 8-bit differences, thresholds and box geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wrapped_square(a: Column, b: Column) -> Column:
    """(a - b)**2 in 8-bit arithmetic, which wraps at 256."""
    return F.pmod((a - b) * (a - b), F.lit(256))


def color_distance(a: Column, b: Column, wrap: bool = True) -> Column:
    """Distance of two channel arrays; ``wrap`` keeps the 8-bit arithmetic that defines the thresholds."""
    square = (lambda x, y: wrapped_square(x, y)) if wrap else (lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(F.zip_with(a, b, square), F.lit(0).cast("long"), lambda s, x: s + x))


def scalar_distance(a: Column, b: Column, wrap: bool = True) -> Column:
    """The same for one channel."""
    return F.sqrt(wrapped_square(a, b).cast("double")) if wrap else F.abs(a - b).cast("double")


def threshold_mask(distance: Column, threshold: float, above: bool = True) -> Column:
    return distance > threshold if above else distance <= threshold


def ceil_modulo(x: Column, mod: int) -> Column:
    """x rounded up to a multiple of ``mod``."""
    return (F.ceil(x / F.lit(mod)) * mod).cast("long")


def rounded_box(box: Column, width: Column, height: Column) -> Column:
    """(x0, y0, x1, y1) rounded half to even and clamped to the image."""
    at = lambda i: F.bround(F.element_at(box, i).cast("double"), 0).cast("int")
    clamp = lambda x, top: F.greatest(F.lit(0), F.least(x, top.cast("int")))
    return F.array(clamp(at(1), width), clamp(at(2), height), clamp(at(3), width), clamp(at(4), height))


def box_area(box: Column) -> Column:
    side = lambda a, b: F.greatest(F.lit(0), F.element_at(box, b) - F.element_at(box, a))
    return side(1, 3) * side(2, 4)


def swap_channels(pixel: Column) -> Column:
    """BGR to RGB and back."""
    return F.reverse(pixel)


def blend(image: Column, overlay: Column, alpha: float) -> Column:
    """(1 - alpha) * image + alpha * overlay, truncated; where there is no overlay the image is dimmed too."""
    return F.floor((1 - alpha) * image + alpha * F.coalesce(overlay, F.lit(0))).cast("int")


def bgr_to_lab(pixel: Column) -> Column:
    """A pixel of 8-bit blue, green and red as 8-bit L, a and b (D65), rounded half up and clamped."""
    # Fixed values of the colour spaces.
    linear = lambda c: F.when(c / 255.0 <= 0.04045, c / 255.0 / 12.92).otherwise(F.pow((c / 255.0 + 0.055) / 1.055, F.lit(2.4)))
    b, g, r = (linear(F.element_at(pixel, i)) for i in (1, 2, 3))
    x = (0.412453 * r + 0.357580 * g + 0.180423 * b) / 0.950456
    y = 0.212671 * r + 0.715160 * g + 0.072169 * b
    z = (0.019334 * r + 0.119193 * g + 0.950227 * b) / 1.088754
    f = lambda t: F.when(t > 0.008856, F.cbrt(t)).otherwise(7.787 * t + 16.0 / 116.0)
    lightness = F.when(y > 0.008856, 116.0 * F.cbrt(y) - 16.0).otherwise(903.3 * y)
    byte = lambda v: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(v + 0.5))).cast("long")
    return F.array(byte(lightness * 255.0 / 100.0), byte(500.0 * (f(x) - f(y)) + 128.0), byte(200.0 * (f(y) - f(z)) + 128.0))


def short_side_crop(width: Column, height: Column, side: int) -> Column:
    """Size of an image whose short side is scaled to ``side`` (the long one truncated), and the offset of the centred square."""
    wide = width >= height
    w = F.when(wide, F.floor(width * F.lit(side) / height)).otherwise(F.lit(side)).cast("int")
    h = F.when(wide, F.lit(side)).otherwise(F.floor(height * F.lit(side) / width)).cast("int")
    return F.struct(w.alias("width"), h.alias("height"), F.floor((w - side) / 2).cast("int").alias("x"), F.floor((h - side) / 2).cast("int").alias("y"))


def stretch_size(to_width: int, to_height: int) -> Column:
    """The same as ``contain_size`` without keeping the ratio: the frame's own size and no padding."""
    return F.struct(F.lit(to_width).alias("width"), F.lit(to_height).alias("height"), F.lit(0).alias("left"), F.lit(0).alias("top"))


def uncontain(width: Column, height: Column, to_width: int, to_height: int) -> Column:
    """What ``contain_size`` and centring did, undone: the box of the image in its padded frame, and the scale back to its size.

    Sizes under one pixel raise an error.
    """
    bad = (width <= 0) | (height <= 0)
    fit = contain_size(width, height, to_width, to_height)
    box = F.struct(
        F.floor(fit["left"] / 2).cast("int").alias("x"), F.floor(fit["top"] / 2).cast("int").alias("y"), fit["width"].alias("width"), fit["height"].alias("height"),
        (width / fit["width"]).alias("scale_x"), (height / fit["height"]).alias("scale_y"),
    )
    return F.when(bad, F.raise_error(F.lit("sizes must be positive")).cast(box_type())).otherwise(box)


def box_type() -> str:
    return "struct<x:int,y:int,width:int,height:int,scale_x:double,scale_y:double>"


def contain_size(width: Column, height: Column, to_width: int, to_height: int) -> Column:
    """Size of an image scaled to fit, at least one pixel each way, and the padding to its left and top."""
    scale = F.least(F.lit(to_width) / width, F.lit(to_height) / height)
    w = F.greatest(F.lit(1), F.floor(width * scale)).cast("int")
    h = F.greatest(F.lit(1), F.floor(height * scale)).cast("int")
    return F.struct(w.alias("width"), h.alias("height"), (to_width - w).alias("left"), (to_height - h).alias("top"))


def cover_crop(width: Column, height: Column, to_width: int, to_height: int) -> Column:
    """Size of an image scaled to cover a frame, and the offset of the centred crop."""
    scale = F.greatest(F.lit(to_width) / width, F.lit(to_height) / height)
    w, h = F.ceil(width * scale).cast("int"), F.ceil(height * scale).cast("int")
    return F.struct(w.alias("width"), h.alias("height"), F.floor((w - to_width) / 2).cast("int").alias("x"), F.floor((h - to_height) / 2).cast("int").alias("y"))
