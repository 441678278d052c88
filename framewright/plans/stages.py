"""Stages, and the lists of them that items go through.

A stage is a function (frames, on, params) on frames of all items: it changes the rows of the items that are ``on``
and passes the others. Its parameters are columns, an item's own values in place of the defaults. So the items that have a stage at
one place of their lists go through it together, whatever their lists are otherwise, and all frames are scanned once.

Frames have the key k, a place i, a value v and a mask m, and where a stage needs them the pixel's y and x, `hit` (a
detector's answer), `box` (the frame's first canvas), `logo` (a logo's mask) and `logo_removed`. Columns named in ``STATE`` hold what
is known of the item; they come from the items, stages set them, and their guards look at them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.operators import masks, registry, series
from framewright.sources.scratch import scratch_path

#: Rows of an item that one task takes; longer items are the work of several.
LONG = 1 << 16
STATE = {
    "start_frame_idx": "long", "end_frame_idx": "long", "canvas_detected": "boolean", "canvas_coordinates": "array<int>", "has_frames": "boolean", "has_reference": "boolean",
    "split_x": "int", "tags": "array<string>",
}
Stage = Callable[[DataFrame, Column, "Params"], DataFrame]
STAGES: dict[str, tuple[Stage, dict, str]] = {}
_TYPES = {bool: "boolean", int: "int", float: "double", str: "string"}


def stage(name: str, done: str = "false", **defaults) -> Callable[[Stage], Stage]:
    """Register a stage, the condition that tells that an item has it behind it, and its default parameters."""

    def keep(f: Stage) -> Stage:
        STAGES[name] = f, defaults, done
        return f

    return keep


class Params:
    """A stage's parameters: columns, an item's own values in place of the defaults; ``top`` is a number's largest value among the items."""

    def __init__(self, defaults: dict, own: dict[str, Column] | None = None, tops: dict | None = None) -> None:
        self._defaults, self._own, self._tops = defaults, own or {}, tops or {}

    def __getitem__(self, name: str) -> Column:
        default = F.lit(self._defaults[name])
        return F.coalesce(self._own[name], default) if name in self._own else default

    def top(self, name: str) -> float:
        return max(self._defaults[name], self._tops.get(name) or self._defaults[name])


def _parsed(steps: Column, names: set[str]) -> Column:
    """A list with the parameters of the stages ``names`` in place of its JSON, which is read once an item instead of once a pixel."""
    params = {f"{n}_{p}": (n, p, _TYPES[type(v)]) for n in sorted(names) for p, v in STAGES[n][1].items()}
    own = lambda s: [F.when(s["name"] == n, F.get_json_object(s["config"], f"$.{p}").try_cast(t)).alias(c) for c, (n, p, t) in params.items()]
    return F.transform(steps, lambda s: F.struct(s["name"].alias("name"), *own(s)))


@dataclass
class Chain:
    """Stages by name for all frames, with parameters that replace defaults key by key."""

    steps: list[tuple[str, dict]] = field(default_factory=list)

    def then(self, name: str, **params) -> Chain:
        if name not in STAGES:
            raise ValueError(f"unknown stage {name}")
        return Chain([*self.steps, (name, params)])

    def run(self, df: DataFrame) -> DataFrame:
        columns = df.columns
        df = _with_state(df)
        for name, params in self.steps:
            f, defaults, _ = STAGES[name]
            df = f(df, F.lit(True), Params({**defaults, **params}))
        return df.select(*columns)


def _with_state(df: DataFrame) -> DataFrame:
    return df.withColumns({c: (F.col(c) if c in df.columns else F.lit(None)).cast(t) for c, t in STATE.items()})


def _long_items(frames: DataFrame, keys: list[str], long: int) -> DataFrame | None:
    """(keys, __parts) of the longest items of more than ``long`` rows, None without any.

    They are fewer than the shuffle has tasks, which bounds what comes to the driver and the broadcast; items behind them hold less than a task's share.
    """
    most = int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = frames.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > long)
    found = counted.orderBy(F.desc("__n"), *keys).limit(most).select(*keys, F.ceil(F.col("__n") / long).cast("int").alias("__parts"))
    rows = found.collect()
    return frames.sparkSession.createDataFrame(rows, found.schema) if rows else None


def run_lists(items: DataFrame, frames: DataFrame, keys: list[str], column: str = "video_processor", key: Column | None = None, long: int = LONG) -> DataFrame:
    """``frames`` of ``items`` with the items' state, each put through its own item's list of stages.

    ``key`` makes k where the keys are other columns. A stage's config is a JSON object of parameters; what is missing or no JSON stands for the defaults. A first job looks at the lists
    alone: how long they are, which stages stand at each place, and the largest numbers among their parameters. A list with an
    unknown stage raises ValueError.

    Items of more than ``long`` rows are dealt in parts: what their stages need to know of the whole item is aggregated from the
    rows stored so far and broadcast. Without such items there is one plan with one scan, and nothing is stored.
    """
    todo = items.select(*keys, F.col(column).alias("__list"), *[c for c in STATE if c in items.columns]).dropDuplicates(keys)
    numbers = sorted({n for _, d, _ in STAGES.values() for n, v in d.items() if type(v) in (int, float)})
    steps = todo.select(F.posexplode("__list").alias("place", "step")).groupBy("place", "step.name")
    used = steps.agg(*[F.max(F.get_json_object("step.config", f"$.{n}").try_cast("double")).alias(n) for n in numbers]).collect()
    for row in used:
        if row["name"] not in STAGES:
            raise ValueError(f"unknown stage {row['name']}")
    todo = _with_state(todo).withColumns({"__had_frames": F.col("has_frames"), "__list": _parsed(F.col("__list"), {row["name"] for row in used})})
    df = frames.select(*[c for c in frames.columns if c not in STATE])
    found = _long_items(df, keys, long) if used else None
    if found is not None:
        parts = F.coalesce("__parts", F.lit(1))
        dealt = lambda d: d.join(F.broadcast(found), keys, "left").withColumn("__parts", parts)
        df = dealt(df).withColumn("__part", F.pmod(F.col("i"), F.col("__parts")).cast("int"))
        todo = dealt(todo).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))).drop("__parts")
    # The hint keeps frames from being broadcast: their files may be small where their rows are many.
    df = df.join(todo.hint("merge"), keys if found is None else [*keys, "__part"])
    if key is not None:
        df = df.withColumn("k", key)
    for row in sorted(used, key=lambda r: (r["place"], r["name"])):
        f, defaults, done = STAGES[row["name"]]
        step = F.try_element_at("__list", F.lit(row["place"] + 1))
        on = F.coalesce(step["name"] == row["name"], F.lit(False))
        on = on & ~F.coalesce(F.expr(done), F.lit(False))
        tops = {n: int(row[n]) if isinstance(defaults.get(n), int) else row[n] for n in numbers if row[n] is not None}
        own = {f"__p_{n}": step[f"{row['name']}_{n}"] for n in defaults}
        df = f(df.withColumns({"__on": on, **own}), F.col("__on"), Params(defaults, {n: F.col(f"__p_{n}") for n in defaults}, tops)).drop("__on", *own)
    return df.drop("__list", "__had_frames", "__parts", "__part")


def process(items: DataFrame, frames: DataFrame, keys: list[str], column: str = "video_processor") -> DataFrame:
    """Frames of the unprocessed items, each put through its own item's list of stages."""
    return run_lists(registry.unprocessed(items), frames, keys, column).select(*frames.columns)


def state_of(done: DataFrame, keys: list[str]) -> DataFrame:
    """One row an item of what ``run_lists`` knows of it."""
    return done.groupBy(*keys).agg(*[F.max(c).alias(c) for c in STATE])


def not_done(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Items that a stage's output does not hold yet."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def _pixel(df: DataFrame) -> list[str]:
    return ["k", *[c for c in ("y", "x") if c in df.columns]]


def _item() -> Window:
    return Window.partitionBy("k")


def _stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, for what would evaluate it twice."""
    path = scratch_path(df.sparkSession, "stages")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _with_facts(df: DataFrame, facts: dict[str, Column], more: dict[str, Column] | None = None) -> DataFrame:
    """``df`` and aggregates over each item's rows, and what follows from them (``more``): a window, or for long items a broadcast of one row an item."""
    windows, more = {n: c.over(_item()) for n, c in facts.items()}, more or {}
    if "__parts" not in df.columns:
        return df.withColumns(windows).withColumns(more)
    rows = _stored(df)
    long, short = rows.where("__parts > 1"), rows.where("__parts = 1")
    known = long.groupBy("k").agg(*[c.alias(n) for n, c in facts.items()]).withColumns(more)
    return long.join(F.broadcast(known), "k").select(*df.columns, *facts, *more).unionByName(short.withColumns(windows).withColumns(more))


def _when(on: Column, new: Column, old: str) -> Column:
    return F.when(on, new).otherwise(F.col(old))


@stage("range", done="start_frame_idx is not null and end_frame_idx is not null", frame_steps=30, max_frames_to_consider=300)
def _range(df: DataFrame, on: Column, p: Params) -> DataFrame:
    """Start and end of an item: the first hits of a probe from either end, -1 without."""
    probed = lambda place: F.col("hit") & (place % p["frame_steps"] == 0) & (place / p["frame_steps"] < p["max_frames_to_consider"])
    placed = _with_facts(df, {"__last": F.max("i")}).withColumn("__back", F.col("__last") - F.col("i"))
    start, end = F.min(F.when(probed(F.col("i")), F.col("i"))), F.max(F.when(probed(F.col("__back")), F.col("i")))
    none = F.lit(-1).cast("long")
    found = _with_facts(placed, {"__start": start, "__end": end})
    found = found.withColumns({"start_frame_idx": _when(on, F.coalesce("__start", none), "start_frame_idx"), "end_frame_idx": _when(on, F.coalesce("__end", none), "end_frame_idx")})
    return found.drop("__last", "__back", "__start", "__end")


@stage("canvas", done="canvas_detected", erosion=2)
def _canvas(df: DataFrame, on: Column, p: Params) -> DataFrame:
    """Frames cut to the canvas of the start frame; items without one stay as they are."""
    at = F.greatest(F.coalesce("start_frame_idx", F.lit(0).cast("long")), F.lit(0).cast("long"))
    box = F.first(F.when(F.col("i") == at, F.col("box")), ignorenulls=True)
    facts = {"__first": box, "__right": F.max("x"), "__low": F.max("y"), "__erosion": F.max(p["erosion"])}
    found = masks.canvas_box(F.col("__first"), F.col("__right") + 1, F.col("__low") + 1, F.col("__erosion"))
    seen = _with_facts(df, facts, {"__box": found}).withColumn("__cut", on & F.col("__first").isNotNull())
    corner = lambda n: F.element_at("__box", n)
    inside = (F.col("x") >= corner(1)) & (F.col("x") < corner(3)) & (F.col("y") >= corner(2)) & (F.col("y") < corner(4))
    kept = seen.where(~F.col("__cut") | inside)
    moved = {c: _when(F.col("__cut"), (F.col(c) - corner(n)).cast(df.schema[c].dataType), c) for c, n in (("x", 1), ("y", 2))}
    state = {"canvas_coordinates": _when(F.col("__cut"), F.col("__box"), "canvas_coordinates"), "canvas_detected": F.col("__cut") | F.coalesce("canvas_detected", F.lit(False))}
    return kept.withColumns(moved | state).drop("__first", "__right", "__low", "__erosion", "__box", "__cut")


@stage("extract", done="has_frames", most=1000)
def _extract(df: DataFrame, on: Column, p: Params) -> DataFrame:
    """Evenly sampled frames of the item's range, or of all of it, placed anew; an item whose range was not found has none."""
    known = F.col("start_frame_idx").isNotNull() & F.col("end_frame_idx").isNotNull()
    last, n = F.col("__last"), F.col("__last") + 1
    start, end = F.when(known, F.col("start_frame_idx")).otherwise(0), F.when(known, F.col("end_frame_idx")).otherwise(last)
    spans = _with_facts(df, {"__last": F.max("i")}).withColumns({"__a": start, "__z": end, "__n": F.least(n, p["most"].cast("long"))})
    # The samples that fall on a place: their numbers j have place(j) = i, place(j) being the first place at or behind start + j * step.
    step = F.try_divide((F.col("__z") - F.col("__a")).cast("double"), (F.col("__n") - 1).cast("double"))
    place = lambda j: F.when(F.col("__n") == 1, F.col("__a")).when(j == F.col("__n") - 1, F.col("__z")).otherwise(F.ceil(F.col("__a") + j * F.coalesce(step, F.lit(0.0))))
    moving, inside = F.coalesce(step, F.lit(0.0)) > 0, (F.col("__a") >= 0) & (F.col("i") >= F.col("__a")) & (F.col("i") <= F.col("__z"))
    first = F.when(moving, F.greatest(F.floor((F.col("i") - 1 - F.col("__a")) / step), F.lit(0).cast("long"))).otherwise(0)
    final = F.when(moving, F.least(F.floor((F.col("i") - F.col("__a")) / step) + 1, F.col("__n") - 1)).otherwise(F.col("__n") - 1)
    near = F.when(inside & (first <= final), F.sequence(first.cast("long"), final.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    numbers = F.filter(near, lambda j: place(j) == F.col("i"))
    out = spans.withColumn("__j", F.explode(F.when(on, numbers).otherwise(F.array(F.col("i")))))
    return out.withColumns({"i": _when(on, F.col("__j"), "i"), "has_frames": on | F.coalesce("has_frames", F.lit(False))}).drop("__last", "__a", "__z", "__n", "__j")


@stage("temporal_median", done="__had_frames", window=11)
def _median(df: DataFrame, on: Column, p: Params) -> DataFrame:
    even = df.withColumn("__w", F.when(on & (p["window"] % 2 == 0), F.raise_error(F.lit("the window must be odd")).cast("int")).otherwise(p["window"]))
    top = int(p.top("window")) | 1
    done = series.temporal_median(even, _pixel(df), window=top, into="__v", own_window=F.col("__w"))
    return done.withColumn("v", _when(on, F.col("__v"), "v")).drop("__v", "__w")


@stage("clean", fill=0)
def _clean(df: DataFrame, on: Column, p: Params) -> DataFrame:
    # By pixel, in one window: carrying bucket states would evaluate all stages before this one twice. Long items are stored before.
    long = "__parts" in df.columns
    done = series.last_clean_fill(_stored(df) if long else df, _pixel(df), seed=p["fill"].cast("long"), into="__v", bucket=series.BUCKET if long else None)
    return done.withColumn("v", _when(on, F.col("__v"), "v")).drop("__v")


@stage("logos")
def _logos(df: DataFrame, on: Column, p: Params) -> DataFrame:
    """Logo masks, joined with their majority over the item's open frames, filled by the clean value before, else behind; the flag is set."""
    open_ = on & ~F.coalesce("logo_removed", F.lit(False))
    w = Window.partitionBy(*_pixel(df))
    marked = df.withColumn("__open", open_).withColumn("__m", F.when(F.col("__open"), F.coalesce("logo", F.lit(False))))
    enough = F.count_if("__m").over(w) >= F.floor((F.count("__m").over(w) + 1) / 2)
    joined = marked.withColumn("__m", F.col("__open") & (F.col("__m") | enough))
    clean = F.when(~F.col("__m") & F.col("__open"), F.col("v"))
    filled = joined.withColumns({"__f": series.last_seen(clean, _pixel(df)), "__b": series.next_seen(clean, _pixel(df))})
    value = F.when(F.col("__open"), F.coalesce("__f", "__b", "v")).otherwise(F.col("v"))
    return filled.withColumns({"v": value, "logo_removed": F.col("__open") | F.coalesce("logo_removed", F.lit(False))}).drop("__open", "__m", "__f", "__b")


@stage("masks", kernel=5)
def _masks(df: DataFrame, on: Column, p: Params) -> DataFrame:
    """Masks grown by a square kernel, each item by its own."""
    top = int(p.top("kernel"))
    # Frames of long items are brought together once for both windows; others are together already.
    out, reach = (df.repartition("k", "i") if "__parts" in df.columns else df).withColumn("__k", p["kernel"]), top // 2 + 1
    for along, across in (("x", "y"), ("y", "x")):
        order = Window.partitionBy("k", "i", across).orderBy(along).rangeBetween(-reach, reach)
        near = F.collect_list(F.when(F.col("m"), F.col(along))).over(order)
        lo, hi = F.col(along) - F.floor(F.col("__k") / 2), F.col(along) + F.col("__k") - F.floor(F.col("__k") / 2) - 1
        out = out.withColumn("__near", near).withColumn("m", _when(on, F.exists("__near", lambda c: (c >= lo) & (c <= hi)), "m")).drop("__near")  # noqa: B023
    return out.drop("__k")


@stage("split", left=0.0, right=1.0, margin=2)
def _split(df: DataFrame, on: Column, p: Params) -> DataFrame:
    """The right half behind the column that changes most in the start frame; the middle where there is no such frame."""
    at = F.greatest(F.coalesce("start_frame_idx", F.lit(0).cast("long")), F.lit(0).cast("long"))
    row = Window.partitionBy("k", "i", "y").orderBy("x")
    width = F.max("x").over(_item()) + 1
    seen = df.withColumns({"__g": F.abs(F.coalesce(F.lead("v").over(row) - F.lag("v").over(row), F.lit(0))), "__width": width})
    inside = (F.col("x") >= F.floor(p["left"] * F.col("__width"))) & (F.col("x") < F.floor(p["right"] * F.col("__width")))
    start = F.col("i") == at
    sums = seen.withColumn("__s", F.sum(F.when(start & inside, F.col("__g")).otherwise(0)).over(Window.partitionBy("k", "x")))
    best = F.max_by(F.when(start, F.col("x")), F.when(start, F.struct("__s", (-F.col("x")).alias("n")))).over(_item())
    placed = sums.withColumn("__x0", F.coalesce(best + 1, F.floor(F.col("__width") / 2)).cast("int") + p["margin"])
    kept = placed.where(~on | (F.col("x") >= F.col("__x0")))
    moved = {"split_x": _when(on, F.col("__x0"), "split_x"), "x": _when(on, (F.col("x") - F.col("__x0")).cast(df.schema["x"].dataType), "x")}
    return kept.withColumns(moved).drop("__g", "__width", "__s", "__x0")


@stage("keyframes", diff=10.0, changes=50, still=3)
def _keyframes(df: DataFrame, on: Column, p: Params) -> DataFrame:
    """The frames of an item's still runs, the others go."""
    pixel = _pixel(df)
    before = series.with_previous(df.withColumns({"__changes": p["changes"], "__still": p["still"], "__diff": p["diff"]}), pixel, "v", "__p")
    from framewright.functions.pixels import scalar_distance

    moved = F.count_if(F.col("__d")).over(Window.partitionBy("k", "i")) >= F.col("__changes")
    signs = before.withColumn("__d", scalar_distance(F.col("v"), F.col("__p")) > F.col("__diff")).withColumn("__sign", moved.cast("int"))
    island = F.sum("__sign").over(Window.partitionBy(*pixel).orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    runs = signs.withColumn("__island", island)
    n = F.max("i").over(_item()) + 1
    run = Window.partitionBy("k", "__island", "__sign")
    a, b = F.min("i").over(run), F.max("i").over(run)
    placed = runs.withColumns({"__a": a, "__b": b, "__n": n})
    still = (F.col("__sign") == 0) & (F.col("__b") - F.col("__a") + 1 >= F.col("__still")) & (F.col("__n") >= F.col("__still") + 2)
    kept = placed.where(~on | (still & (F.col("i") <= F.col("__b") - F.col("__still") + 2)))
    return kept.drop("__p", "__d", "__sign", "__island", "__a", "__b", "__n", "__changes", "__still", "__diff")


@stage("reference", done="has_reference")
def _reference(df: DataFrame, on: Column, p: Params) -> DataFrame:
    """The last frame alone."""
    kept = _with_facts(df, {"__last": F.max("i")}).where(~on | (F.col("i") == F.col("__last"))).drop("__last")
    return kept.withColumn("has_reference", on | F.coalesce("has_reference", F.lit(False)))


@stage("tags", tag="")
def _tags(df: DataFrame, on: Column, p: Params) -> DataFrame:
    """A tag behind the item's tags, unless it has it."""
    old = F.coalesce("tags", F.array().cast("array<string>"))
    fresh = on & (p["tag"] != "") & ~F.array_contains(old, p["tag"])
    return df.withColumn("tags", F.when(fresh, F.array_append(old, p["tag"])).otherwise(F.col("tags")))
