"""Operators on ordered series: rows with keys, an index and a value.

``indexed`` gives rows their place; the other operators expect it in ``i``, from 0 and without gaps. Windows of
bounded length run over buckets of consecutive places, to which rows near a border are copied from the
neighbours, and scans from a series' start carry each bucket's last state on to the next: so a recording of
any length is the work of as many tasks as it has buckets. Rows go to their bucket once; only states, one a
bucket, meet by recording.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


#: Places in a bucket. A window's memory follows it, copies at borders are its inverse.
BUCKET = 1 << 16


def _by(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys)


def _ordered(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("i")


def indexed(df: DataFrame, keys: list[str], order: list[str], lot: Column | None = None) -> DataFrame:
    """Place ``i`` (from 0) of every row within its keys; ``order`` must be total.

    ``lot`` never falls along ``order``, such as a timestamp's hour. Series with more rows than a task's share
    are then counted by lots, and a row's place is that in its lot behind all earlier lots. Of such series
    there are fewer than tasks, which bounds the broadcast.
    """
    if lot is None:
        return df.withColumn("i", (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("long"))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > max(df.count() // tasks, 1)).select(*keys, F.lit(True).alias("__long"))
    lots = df.join(F.broadcast(long), keys, "left").withColumn("__lot", F.when(F.col("__long"), lot)).drop("__long")
    sizes = lots.where(F.col("__lot").isNotNull()).groupBy(*keys, "__lot").agg(F.count("*").alias("__size"))
    earlier = Window.partitionBy(*keys).orderBy("__lot").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*keys, "__lot", F.sum("__size").over(earlier).alias("__before")).where(F.col("__before").isNotNull())
    own = lots.withColumn("i", (F.row_number().over(Window.partitionBy(*keys, "__lot").orderBy(*order)) - 1).cast("long"))
    return own.join(before, [*keys, "__lot"], "left").withColumn("i", F.col("i") + F.coalesce("__before", F.lit(0))).select(*df.columns, "i")


def bucketed(df: DataFrame, keys: list[str], past: int, future: int, bucket: int = BUCKET) -> tuple[DataFrame, WindowSpec]:
    """Rows by buckets (``__b``), and the window over a bucket in order; ``__own`` tells rows from their copies.

    A copy goes to the next bucket for ``past`` places, to the one before for ``future`` places.
    """
    size = max(bucket, past, future, 1)
    b, at = F.floor(F.col("i") / size), F.col("i") % size
    to = [F.struct(b.alias("__b"), F.lit(True).alias("__own"))]
    to += [F.when(at >= size - past, F.struct((b + 1).alias("__b"), F.lit(False).alias("__own")))] if past else []
    to += [F.when((at < future) & (b > 0), F.struct((b - 1).alias("__b"), F.lit(False).alias("__own")))] if future else []
    copies = df.select("*", F.inline(F.array_compact(F.array(*to)))) if len(to) > 1 else df.withColumns({"__b": b, "__own": F.lit(True)})
    return copies, Window.partitionBy(*keys, "__b").orderBy("i")


def carried(df: DataFrame, keys: list[str], states: dict[str, Column], bucket: int = BUCKET) -> DataFrame:
    """(keys, __b, states): what the aggregates ``states`` make of each bucket's rows, to be carried on to its neighbours."""
    return df.withColumn("__b", F.floor(F.col("i") / bucket)).groupBy(*keys, "__b").agg(*[c.alias(n) for n, c in states.items()])


def _earlier(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)


def _later(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)


def last_seen(value: Column, keys: list[str]) -> Column:
    """The last value up to here that is not null."""
    return F.last(value, ignorenulls=True).over(_ordered(keys).rowsBetween(Window.unboundedPreceding, 0))


def next_seen(value: Column, keys: list[str]) -> Column:
    """The next value from here on that is not null.

    It is the last one seen from behind: a frame up to a series' end is gone through anew for every row, one from its start is carried along.
    """
    return F.last(value, ignorenulls=True).over(_by(keys).orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0))


def temporal_median(df: DataFrame, keys: list[str], value: str = "v", window: int = 11, into: str = "median_v", own_window: Column | None = None, bucket: int = BUCKET) -> DataFrame:
    """Median over a window that shrinks evenly towards both ends, so the first and last value stay.

    Series no longer than the window stay as they are. The window must be odd. ``own_window`` gives rows of a series
    their own window, of ``window`` at most.
    """
    if window % 2 == 0:
        raise ValueError("the window must be odd")
    half, size = window // 2, F.lit(window) if own_window is None else own_window
    spread, order = bucketed(df, keys, half, window, bucket)
    behind = F.count("*").over(order.rowsBetween(1, window))
    staged = spread.select("*", F.collect_list(value).over(order.rowsBetween(-half, half)).alias("__around"), behind.alias("__behind")).where("__own")
    radius = F.least(F.col("i"), F.col("__behind"), F.floor(size / 2)).cast("int")
    skipped = (F.least(F.col("i"), F.lit(half)) - F.col("__r")).cast("int")
    middle = F.element_at(F.array_sort(F.slice(F.col("__around"), skipped + 1, 2 * F.col("__r") + 1)), F.col("__r") + 1)
    whole = F.col("i") + 1 + F.col("__behind") <= size
    return staged.withColumn("__r", radius).withColumn(into, F.when(whole, F.col(value)).otherwise(middle)).drop("__around", "__behind", "__r", "__b", "__own")


def last_clean_fill(df: DataFrame, keys: list[str], value: str = "v", masked: str = "m", seed: Column | None = None, into: str = "clean_v", bucket: int | None = BUCKET) -> DataFrame:
    """Masked values become the last clean one; ``seed`` stands in while there was none.

    Without a ``bucket`` a recording is one task's work, and ``df`` is evaluated once instead of twice.
    """
    clean = F.when(~F.col(masked), F.col(value))
    if bucket is None:
        return df.withColumn(into, F.coalesce(last_seen(clean, keys), F.lit(0) if seed is None else seed))
    ends = carried(df, keys, {"__end": F.max_by(clean, F.when(clean.isNotNull(), F.col("i")))}, bucket)
    before = ends.select(*keys, "__b", F.last("__end", ignorenulls=True).over(_earlier(keys)).alias("__before")).where(F.col("__before").isNotNull())
    rows, _ = bucketed(df, keys, 0, 0, bucket)
    filled = rows.withColumn("__last", last_seen(clean, [*keys, "__b"])).join(before, [*keys, "__b"], "left")
    return filled.withColumn(into, F.coalesce("__last", "__before", F.lit(0) if seed is None else seed)).select(*df.columns, into)


def even_sample(df: DataFrame, keys: list[str], most: int = 1000, ranges: DataFrame | None = None, into: str = "sample_no") -> DataFrame:
    """``most`` evenly spread rows of each series, or as many as it has rows, over all of it or over ``ranges``.

    ``ranges`` has the keys, start_idx and end_idx; series without a range are left out. Places between
    two rows go to the later one, so a short range gives some rows twice; places before the first row
    give the first. A sample of one row is the start.
    """
    spans = df.groupBy(*keys).agg(F.max("i").alias("__end"), F.count("*").alias("__n")).withColumn("__start", F.lit(0).cast("long"))
    if ranges is not None:
        own = ranges.select(*keys, F.col("start_idx").cast("long").alias("__start"), F.col("end_idx").cast("long").alias("__end"))
        spans = spans.select(*keys, "__n").join(own, keys)
    spans = spans.withColumn("__count", F.least(F.col("__n"), F.lit(most))).withColumn(into, F.explode(F.sequence(F.lit(0).cast("long"), F.col("__count") - 1)))
    step = F.try_divide((F.col("__end") - F.col("__start")).cast("double"), (F.col("__count") - 1).cast("double"))
    place = F.when(F.col(into) == F.col("__count") - 1, F.col("__end")).otherwise(F.ceil(F.col("__start") + F.col(into) * F.coalesce(step, F.lit(0.0))))
    place = F.when(F.col("__count") == 1, F.col("__start")).otherwise(place)
    picked = spans.select(*keys, into, F.greatest(place, F.lit(0)).cast("long").alias("i"))
    return picked.join(df, [*keys, "i"])


def progress(df: DataFrame, keys: list[str], ranges: DataFrame | None = None, into: str = "progress") -> DataFrame:
    """Place between the first (0) and the last row (1), or between start_idx and end_idx of ``ranges``; null where both are one."""
    if ranges is not None:
        own = ranges.select(*keys, F.col("start_idx").alias("__start"), F.col("end_idx").alias("__end"))
        placed = df.join(own, keys)
        return placed.withColumn(into, F.try_divide((F.col("i") - F.col("__start")).cast("double"), (F.col("__end") - F.col("__start")).cast("double"))).drop("__start", "__end")
    lo, hi = F.min("i").over(_by(keys)), F.max("i").over(_by(keys))
    return df.withColumn(into, F.try_divide((F.col("i") - lo).cast("double"), (hi - lo).cast("double")))


def fixed_trim(df: DataFrame, keys: list[str], start_offset: int = 100, end_offset: int = 100) -> DataFrame:
    """(start_idx, end_idx) of each series: offsets cut where it is longer than both, else all of it."""
    n = F.count("*")
    long = n > start_offset + end_offset
    return df.groupBy(*keys).agg(
        F.when(long, F.lit(start_offset)).otherwise(F.lit(0)).cast("long").alias("start_idx"), F.when(long, n - end_offset).otherwise(n).cast("long").alias("end_idx")
    )


def first_last_hit(df: DataFrame, keys: list[str], hit: str = "hit", stride: int = 30, most: int = 300, miss: str = "none") -> DataFrame:
    """First hit among the places probed forwards and first among those probed backwards.

    At most ``most`` probes each way, ``stride`` apart. Without a hit: -1 for ``miss="none"``, the
    whole series for ``miss="all"``. Probes are picked before anything looks at them.
    """
    sized = df.withColumn("__back", F.count("*").over(_by(keys)) - 1 - F.col("i"))
    probe = lambda place: (place % stride == 0) & (place / stride < most)
    start = F.min(F.when(F.col(hit) & probe(F.col("i")), F.col("i")))
    end = F.max(F.when(F.col(hit) & probe(F.col("__back")), F.col("i")))
    none = (F.lit(-1), F.lit(-1)) if miss == "none" else (F.lit(0), F.max("i"))
    return sized.groupBy(*keys).agg(F.coalesce(start, none[0]).cast("long").alias("start_idx"), F.coalesce(end, none[1]).cast("long").alias("end_idx"))


def change_sign(df: DataFrame, keys: list[str], distance: Column, threshold: float, into: str = "sign") -> DataFrame:
    """1 where the distance to the row before passes the threshold; the first row is 0."""
    return df.withColumn(into, F.coalesce((distance > threshold).cast("int"), F.lit(0)))


def previous(column: str, keys: list[str]) -> Column:
    return F.lag(column).over(_ordered(keys))


def with_previous(df: DataFrame, keys: list[str], column: str, into: str, bucket: int = BUCKET) -> DataFrame:
    """The value of the row before; null for the first."""
    rows, order = bucketed(df, keys, 1, 0, bucket)
    return rows.withColumn(into, F.lag(column).over(order)).where("__own").drop("__b", "__own")


def still_runs(df: DataFrame, keys: list[str], sign: str = "sign", least: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(start_idx, end_idx) of each maximal run of zeros [a, b] of ``least`` rows or more: [a, b - least + 2].

    Series shorter than ``least`` + 2 have none.
    """
    bucket = max(bucket, least + 1)
    ends = carried(df, keys, {"__sum": F.sum(sign)}, bucket)
    before = ends.select(*keys, "__b", F.sum("__sum").over(_earlier(keys)).alias("__before")).where(F.col("__before").isNotNull())
    rows, order = bucketed(df, keys, 0, least + 1, bucket)
    marked = rows.withColumns({
        "__within": F.sum(sign).over(order.rowsBetween(Window.unboundedPreceding, 0)), "__n": F.col("i") + 1 + F.count("*").over(order.rowsBetween(1, least + 1)),
    }).where(F.col("__own") & (F.col(sign) == 0))
    whole = marked.join(before, [*keys, "__b"], "left").withColumn("__island", F.col("__within") + F.coalesce("__before", F.lit(0)))
    runs = whole.groupBy(*keys, "__island").agg(F.min("i").alias("a"), F.max("i").alias("b"), F.max("__n").alias("n"))
    kept = runs.where((F.col("b") - F.col("a") + 1 >= least) & (F.col("n") >= least + 2))
    return kept.select(*keys, F.col("a").alias("start_idx"), (F.col("b") - least + 2).alias("end_idx"))


def still_runs_timelapse(df: DataFrame, keys: list[str], sign: str = "sign") -> DataFrame:
    """Good sequences between a start (change, then three still) and the next end (three still, then change).

    The first row starts and the last row ends a sequence. A start inside an open sequence begins it
    anew; an end outside one does nothing.
    """
    w = _ordered(keys)
    near = {d: F.lag(sign, -d).over(w) for d in (-1, 1, 2)}
    n = F.count("*").over(_by(keys))
    inside = (F.col("i") >= 2) & (F.col("i") < n - 2)
    still = (F.col(sign) == 0) & (near[1] == 0)
    mark = F.when(F.col("i") == n - 1, 1).when(F.col("i") == 0, 2)
    mark = mark.when(inside & (near[-1] == 0) & still & (near[2] == 1), 1).when(inside & (near[-1] == 1) & still & (near[2] == 0), 2)
    marked = df.withColumn("__mark", mark).where(F.col("__mark").isNotNull())
    before = F.lag("__mark").over(w)
    opened = F.lag("i").over(w)
    return marked.select(*keys, "i", "__mark", before.alias("__before"), opened.alias("__opened")).where("__mark = 1 and __before = 2").select(
        *keys, F.col("__opened").alias("start_idx"), F.col("i").alias("end_idx")
    )


def keyframes(
    df: DataFrame, keys: list[str], pixel_keys: list[str], value: str = "v", diff: float = 10, changes: int = 50, step: int = 1, still: int = 3, strict: bool = False, channels: bool = False
) -> DataFrame:
    """Still runs of pixel series: a frame changes when ``changes`` pixels or more differ by more than ``diff``.

    With ``channels`` the value is an array, such as a pixel in Lab, and the distance that of all channels.

    ``step`` looks at every step-th frame and scales the runs back; ``strict`` then visits only the
    first (n - 1) // step + 1 places, as the original counter does.
    """
    from framewright.functions.pixels import color_distance, scalar_distance

    if step == 0:
        raise ZeroDivisionError("step must not be 0")
    step = max(1, step)
    sized = df.withColumn("__visits", F.floor(F.max("i").over(_by(keys)) / step) + 1)
    seen = sized.where(F.col("i") % step == 0).withColumn("i", (F.col("i") / step).cast("long"))
    if strict and step > 1:
        seen = seen.where(F.col("i") * step < F.col("__visits"))
    distance = color_distance if channels else scalar_distance
    moved = seen.withColumn("__d", distance(F.col(value), F.lag(value).over(Window.partitionBy(*keys, *pixel_keys).orderBy("i"))) > diff)
    signs = moved.groupBy(*keys, "i").agg((F.count_if("__d") >= changes).cast("int").alias("sign"))
    runs = still_runs(signs, keys, "sign", still)
    return runs.select(*keys, (F.col("start_idx") * step).alias("start_idx"), (F.col("end_idx") * step).alias("end_idx"))


def window_max(df: DataFrame, keys: list[str], value: str, past: int = 30, future: int = 2, into: str = "window_max", bucket: int = BUCKET) -> DataFrame:
    """Maximum over [i - past, i + future), the row itself included."""
    rows, order = bucketed(df, keys, past, future - 1, bucket)
    return rows.withColumn(into, F.max(value).over(order.rowsBetween(-past, future - 1))).where("__own").drop("__b", "__own")


def band_difference(df: DataFrame, keys: list[str], value: str = "v", threshold: float = 8, past: int = 30, future: int = 2, into: str = "moved", bucket: int = BUCKET) -> DataFrame:
    """Does the value differ from any other in [i - past, i + future) by more than the threshold?

    The band is a window, at most ``past`` + ``future`` values a row, not a self join.
    """
    from framewright.functions.pixels import scalar_distance

    rows, order = bucketed(df, keys, past, future - 1, bucket)
    staged = rows.withColumn("__band", F.collect_list(value).over(order.rowsBetween(-past, future - 1))).where("__own")
    return staged.withColumn(into, F.exists("__band", lambda x: scalar_distance(F.col(value), x) > threshold)).drop("__band", "__b", "__own")


def clean_neighbours(df: DataFrame, keys: list[str], value: str = "v", masked: str = "m", fill: int = 255, bucket: int = BUCKET) -> DataFrame:
    """forward_v, forward_i: last clean value up to here; backward_v, backward_i: next clean one from here on.

    Without one the fill stands at the first or last place.
    """
    clean = F.when(~F.col(masked), F.struct(F.col(value).alias("v"), F.col("i").alias("i")))
    at = F.when(~F.col(masked), F.col("i"))
    ends = carried(df, keys, {"__last": F.max_by(clean, at), "__first": F.min_by(clean, at), "__top": F.max("i")}, bucket)
    around = ends.select(
        *keys, "__b", F.last("__last", ignorenulls=True).over(_earlier(keys)).alias("__before"), F.last("__first", ignorenulls=True).over(_later(keys)).alias("__after"),
        F.max("__top").over(_by(keys)).alias("__end"),
    )
    rows, _ = bucketed(df, keys, 0, 0, bucket)
    ahead, behind = last_seen(clean, [*keys, "__b"]), next_seen(clean, [*keys, "__b"])
    staged = rows.select("*", ahead.alias("__f"), behind.alias("__n")).join(around, [*keys, "__b"])
    return staged.select(
        *df.columns,
        F.coalesce("__f.v", "__before.v", F.lit(fill)).cast("long").alias("forward_v"),
        F.coalesce("__f.i", "__before.i", F.lit(0)).cast("long").alias("forward_i"),
        F.coalesce("__n.v", "__after.v", F.lit(fill)).cast("long").alias("backward_v"),
        F.coalesce("__n.i", "__after.i", F.col("__end")).cast("long").alias("backward_i"),
    )


#: Fixed value: what keeps the blend's divisor off zero, in double precision.
EPSILON = 2.220446049250313e-16


def distance_blend(df: DataFrame, keys: list[str], value: str = "v", masked: str = "m", fill: int = 255, into: str = "blend_v") -> DataFrame:
    """Masked values blended from both clean neighbours, weighted by the distances, then truncated."""
    near = clean_neighbours(df, keys, value, masked, fill)
    i, f, b = F.col("i"), F.col("forward_i"), F.col("backward_i")
    total = ((i - f) * F.col("forward_v") + (b - i) * F.col("backward_v")).cast("double")
    mixed = F.floor(total / ((b - f).cast("double") + F.lit(EPSILON)))
    return near.withColumn(into, F.when(F.col(masked), mixed).otherwise(F.col(value)).cast("long"))


def reference_frame(df: DataFrame, keys: list[str], existing: DataFrame | None = None) -> DataFrame:
    """The last row of each series, for series without a reference in ``existing``."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), "i").alias("__r")).select(*keys, "__r.*")
    return last if existing is None else last.join(existing.select(*keys), keys, "left_anti")


def frame_at(df: DataFrame, keys: list[str], place: int) -> DataFrame:
    """The row at a place; negative places count from the end."""
    if place >= 0:
        return df.where(F.col("i") == place)
    return df.withColumn("__back", F.count("*").over(_by(keys)) - F.col("i")).where(F.col("__back") == -place).drop("__back")


def seek(series: DataFrame, df: DataFrame, keys: list[str], start: str, found: str, into: str) -> DataFrame:
    """``series`` with the place behind ``df``'s ``found`` value at its start row: the value + 1, or -1 where there is no such row.

    A start before the first row, or none, stands for the first.
    """
    at = series.withColumn("__at", F.greatest(F.coalesce(F.col(start), F.lit(0)), F.lit(0)).cast("long"))
    values = df.select(*keys, F.col("i").alias("__at"), F.col(found).alias("__found"))
    return at.join(values, [*keys, "__at"], "left").withColumn(into, F.coalesce(F.col("__found") + 1, F.lit(-1)).cast("int")).drop("__at", "__found")


def success_counts(df: DataFrame, keys: list[str], ok: str) -> DataFrame:
    """How many rows of each key went well, and how many there are; a missing answer is a failure."""
    return df.groupBy(*keys).agg(F.count_if(F.coalesce(F.col(ok), F.lit(False))).alias("n_ok"), F.count("*").alias("n"))


def stride_limit(df: DataFrame, stride: int, most: int) -> DataFrame:
    """Every stride-th row of each series, at most ``most`` of them."""
    return df.where((F.col("i") % stride == 0) & (F.col("i") / stride < most))


def batches(df: DataFrame, size: int, into: str = "batch_no") -> DataFrame:
    """Consecutive batches of ``size`` rows; the last may be shorter."""
    return df.withColumn(into, F.floor(F.col("i") / size).cast("long"))


def uniform_extraction(df: DataFrame, fps: float, target_fps: float = -1) -> DataFrame:
    """Rows kept when a recording at ``fps`` is taken down to ``target_fps``, with the file name of each."""
    from framewright.functions.text import zero_padded

    interval = int(fps / target_fps) if target_fps > 0 else 0
    kept = df if interval == 0 else df.where(F.col("i") % interval == 0)
    return kept.withColumn("file_name", F.concat(zero_padded(F.col("i")), F.lit(".png")))
