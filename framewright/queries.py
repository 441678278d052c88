"""Registered queries: each operator over whole tables that stand in for recordings.

A user's events in order are a recording: its rounded value is a one-pixel frame, an error masks it, a
purchase is a detector's hit. An embedding is an 8 x 8 frame of its label's recording. Documents are
registry rows by source, labels their flags and explicit splits, pages their urls.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.functions import pixels as P
from framewright.functions import text as X
from framewright.operators import filters, masks, movement, probing, registry, series, splits, tags
from framewright.plans import stages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, i, event_id, v, m, hit, props)."""
    events = table(spark, sf_dir, "events").withColumnRenamed("user_id", "k")
    placed = series.indexed(events, ["k"], ["ts", "event_id"], lot=F.date_trunc("hour", "ts"))
    return placed.select(
        "k", "i", "event_id", F.floor("value").cast("long").alias("v"), (F.col("event_type") == "error").alias("m"), (F.col("event_type") == "purchase").alias("hit"), "props", "value"
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, i, vec_id, embedding): embeddings as ordered frames of their label."""
    return series.indexed(table(spark, sf_dir, "embeddings").withColumnRenamed("label", "k"), ["k"], ["vec_id"], lot=F.floor(F.col("vec_id") / 4096))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, i, vec_id, y, x, v): frames as pixels of 8 bits."""
    return frames(spark, sf_dir).select("k", "i", "vec_id", F.posexplode("embedding").alias("pos", "e")).select(
        "k",
        "i",
        "vec_id",
        F.floor(F.col("pos") / 8).cast("int").alias("y"),
        (F.col("pos") % 8).alias("x"),
        F.pmod(F.floor(F.col("e").cast("double") * 256), F.lit(256)).cast("long").alias("v"),
    )


# Scans and registry


@query
def scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select("event_id", X.with_default(fields, "k").alias("k_text"), X.with_default(fields, "title").alias("title"))


@query
def url_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", X.url_host(F.col("url")).alias("host"), F.explode(X.url_parts(F.col("url"))).alias("part"), F.contains("url", F.lit("?")).alias("has_query"))


@query
def register_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    items = docs.select(
        F.lit("youtube").alias("source"), F.col("doc_id").cast("string").alias("url"), F.array(F.lit("src1"), F.lit("src2"), F.lit("src3")).alias("channel_ids"), (F.col("lang") != "en").alias("only_channel_vid")
    )
    catalog = docs.select(F.col("doc_id").cast("string").alias("url"), F.md5("text").alias("id"), F.col("source").alias("channel_id"))
    taken = table(spark, sf_dir, "labels").where("toxic = 1").join(docs, "doc_id").select(F.lit("youtube").alias("source"), F.md5("text").alias("video_id"))
    found = registry.register(items, catalog, taken, order=["url"])
    return found.groupBy("channel_id").agg(F.count("*").alias("n_registered"))


@query
def enrich_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = registry.enriched(registry.with_key(table(spark, sf_dir, "documents"), F.lit("youtube"), "doc_id", ["lang", "source"]))
    return docs.select("doc_id", "video_key", "art", "processed", "exclude_video")


@query
def eligible_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("exclude_video")), "doc_id", "left")
    shown = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"))
    return registry.eligible(docs, shown, ["doc_id"]).select("doc_id", "source")


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.first_last_hit(recordings(spark, sf_dir), ["k"], stride=3)
    return found.select("k", F.col("start_idx").alias("start_frame_idx"), F.col("end_idx").alias("end_frame_idx"))


@query
def processed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.found_range(_ranges(spark, sf_dir))


@query
def needs_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("processed")), "doc_id", "left")
    return registry.unprocessed(docs).groupBy("source").agg(F.count("*").alias("n_open"))


@query
def frame_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return registry.frame_counts(docs, table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id")), ["doc_id"])


@query
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.source_counts(table(spark, sf_dir, "documents"))


@query
def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "train").otherwise("test").alias("split"))
    return splits.assign_split(table(spark, sf_dir, "documents").select("doc_id"), listed, ["doc_id"], "doc_id")


@query
def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = splits.folds(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id")
    return splits.fold_sets(dealt).select("doc_id", "source", "fold", "part")


@query
def stage_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = lambda n: F.struct(F.lit(n).alias("name"), F.col("lang").alias("config"))
    items = table(spark, sf_dir, "documents").select("doc_id", F.array(stage("extract"), stage("vary"), stage("tag")).alias("video_processor"))
    return registry.stages(items).select("doc_id", F.col("stage_no").cast("int").alias("stage_no"), F.col("stage.name").alias("stage_name"), F.col("stage.config").alias("config"))


@query
def path_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.path(F.lit("out"), F.col("source"), F.concat(X.zero_padded(F.col("doc_id")), F.lit(".png"))).alias("path"))


@query
def union_pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"documents": "doc_id", "pages": "page_id"}
    return registry.union_pipelines({n: table(spark, sf_dir, n) for n in names}, names)


@query
def meta_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("n_chars").alias("size"))
    new = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, F.lit("flagged")).alias("lang"), F.col("quality").cast("long").alias("size"))
    return registry.upsert(old, new, ["doc_id"], ["lang", "size"])


@query
def json_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", X.json_number(F.col("props"), "$.k").alias("k_value"), X.frame_meta(frame_index=F.col("event_id"), processor=F.col("event_type")).alias("meta")
    )


@query
def reindex_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("ref_idx"), "role")
    return registry.remove_reference(turns, ["conv_id"], F.col("ref_idx") == 1)


@query
def trim_variations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.drop_variations(table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("ref_idx"), "role"))


@query
def replace_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    new = table(spark, sf_dir, "labels").select((F.col("doc_id") * 2).alias("doc_id"), F.col("quality").cast("long").alias("n_chars"))
    return registry.replace(old, new, ["doc_id"])


@query
def append_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    old = turns.where("turn < 2").select("conv_id", "turn", F.col("turn").cast("int").alias("frame_no"), "role")
    new = turns.where("turn >= 2").select("conv_id", "turn", "role")
    return registry.append(old, new, ["conv_id"], ["turn"]).select("conv_id", "frame_no", "role")


# Ordered series


@query
def temporal_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.temporal_median(recordings(spark, sf_dir).select("k", "i", "v"), ["k"])


@query
def last_clean_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.last_clean_fill(recordings(spark, sf_dir).select("k", "i", "v", "m"), ["k"]).select("k", "i", "clean_v")


@query
def even_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.even_sample(recordings(spark, sf_dir).select("k", "i", "v"), ["k"])


@query
def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.progress(recordings(spark, sf_dir).select("k", "i"), ["k"])


@query
def fixed_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.fixed_trim(recordings(spark, sf_dir), ["k"], 30, 30)


@query
def first_last_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.first_last_hit(recordings(spark, sf_dir), ["k"])


@query
def first_last_hit_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.first_last_hit(recordings(spark, sf_dir), ["k"], stride=10, most=200, miss="all")


@query
def probed_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and end by rounds of probes; series end their search at their first hit."""
    rows = recordings(spark, sf_dir).select("k", "i", F.col("hit").alias("seen"))
    return probing.probe_ends(rows, ["k"], lambda probed: probed.withColumn("hit", F.col("seen")), stride=2)


def _signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recordings(spark, sf_dir).select("k", "i", "v")
    before = series.with_previous(rows, ["k"], "v", "before")
    return series.change_sign(before, ["k"], F.abs(F.col("v") - F.col("before")), 60)


@query
def still_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.still_runs(_signs(spark, sf_dir), ["k"])


@query
def still_runs_timelapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.still_runs_timelapse(_signs(spark, sf_dir), ["k"])


@query
def keyframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.keyframes(grid(spark, sf_dir), ["k"], ["y", "x"], diff=10, changes=24)


@query
def window_max_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.window_max(recordings(spark, sf_dir).select("k", "i", "v"), ["k"], "v")


@query
def band_diff_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.band_difference(recordings(spark, sf_dir).select("k", "i", "v"), ["k"], threshold=15.9)


@query
def forward_fill_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.clean_neighbours(recordings(spark, sf_dir).select("k", "i", "v", "m"), ["k"])


@query
def distance_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.distance_blend(recordings(spark, sf_dir).select("k", "i", "v", "m"), ["k"]).select("k", "i", "blend_v")


@query
def reference_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.reference_frame(recordings(spark, sf_dir).select("k", "i", "v"), ["k"])


@query
def frame_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.frame_at(recordings(spark, sf_dir).select("k", "i", "v"), ["k"], -2)


@query
def stride_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.stride_limit(recordings(spark, sf_dir).select("k", "i", "v"), 3, 10)


@query
def batch_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.batches(recordings(spark, sf_dir).select("k", "i"), 16).groupBy("k", "batch_no").agg(F.count("*").alias("n"))


@query
def preview_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.uniform_extraction(recordings(spark, sf_dir).select("k", "i", "v"), 25, 10)


@query
def runs_on_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same window operators on the largest table: quantities of each part in shipping order."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), "l_shipdate", "l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("v"), (F.col("l_returnflag") == "R").alias("m"))
    placed = series.indexed(rows, ["k"], ["l_shipdate", "l_orderkey", "l_linenumber"]).select("k", "i", "v", "m")
    filled = series.last_clean_fill(placed, ["k"]).select("k", "i", F.col("clean_v").alias("v"))
    return series.temporal_median(filled, ["k"]).groupBy("k").agg(F.sum("median_v").alias("total"), F.count("*").alias("n"))


# Pixels and masks


@query
def majority_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.majority_mask(grid(spark, sf_dir).withColumn("m", F.col("v") > 128), ["k", "y", "x"])


@query
def own_or_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = masks.own_or_majority(grid(spark, sf_dir).withColumn("m", F.col("v") > 128), ["k", "y", "x"])
    return rows.groupBy("k", "i").agg(F.count_if("union_m").alias("n_masked"))


@query
def mask_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.mask_or(grid(spark, sf_dir).withColumn("m", F.col("v") > 250), ["vec_id"])


@query
def accumulated_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.accumulated(grid(spark, sf_dir), ["k", "y", "x"], "v")


@query
def never_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.never_changed(grid(spark, sf_dir), ["k"], ["y", "x"], threshold=15.9)


@query
def median_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.sampled_median(grid(spark, sf_dir), ["k"], ["y", "x"])


@query
def progress_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.progress_histogram(series.progress(recordings(spark, sf_dir).select("k", "i"), ["k"]), ["k"])


@query
def minmax_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = masks.minmax_mask(grid(spark, sf_dir), ["vec_id"])
    return rows.groupBy("vec_id").agg(F.count_if("near_m").alias("n_near"))


@query
def column_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.split_column(grid(spark, sf_dir), ["vec_id"], 8, left=0.25, right=0.75)


@query
def crop_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = masks.canvas_box(F.array(F.lit(-0.5), F.lit(0.5), F.lit(8.5), F.lit(7.5)), F.lit(8), F.lit(8), erode=1)
    at = lambda i: F.element_at(box, i)
    kept = masks.crop(grid(spark, sf_dir), at(1), at(2), at(3), at(4))
    return kept.groupBy("vec_id").agg(F.count("*").alias("n"), F.sum(F.col("v") * (F.col("x") + 8 * F.col("y"))).alias("weighted"))


@query
def dilate(spark: SparkSession, sf_dir: str) -> DataFrame:
    grown = masks.morphology(grid(spark, sf_dir).withColumn("m", F.col("v") > 250), ["vec_id"], 4, "dilate")
    return grown.groupBy("vec_id").agg(F.count_if("m").alias("n"), F.sum(F.when(F.col("m"), F.col("x") + 8 * F.col("y")).otherwise(0)).alias("places"))


@query
def open_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = masks.opened(grid(spark, sf_dir).withColumn("m", F.col("v") > 60), ["vec_id"], 3)
    return kept.groupBy("vec_id").agg(F.count_if("m").alias("n"), F.sum(F.when(F.col("m"), F.col("x") + 8 * F.col("y")).otherwise(0)).alias("places"))


@query
def lab_diff_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte = lambda e: F.pmod(F.floor(e.cast("double") * 256), F.lit(256)).cast("long")
    rows = frames(spark, sf_dir).select("k", "i", "vec_id", F.transform("embedding", byte).alias("a"))
    before = rows.withColumn("b", F.lag("a").over(Window.partitionBy("k").orderBy("i"))).where(F.col("b").isNotNull())
    pixel = lambda c, p: F.slice(c, p * 3 + 1, 3)
    distances = F.transform(F.sequence(F.lit(0), F.lit(21)), lambda p: P.color_distance(pixel(F.col("a"), p), pixel(F.col("b"), p)))
    return before.withColumn("d", distances).select(
        "vec_id", F.size(F.filter("d", lambda d: P.threshold_mask(d, 10))).alias("n_changed"), F.round(F.array_max("d"), 6).alias("max_distance")
    )


def _detections(scale: float, shift: float) -> Column:
    """A detection for each four elements of an embedding: its corners, and its first element as the score."""
    side = lambda i: F.element_at("embedding", i).cast("double") * scale + shift
    label = lambda n: F.element_at(F.array(*map(F.lit, ("logo", "", "text", "hand"))), n % 4 + 1)
    starts = F.transform(F.sequence(F.lit(0), F.floor(F.size("embedding") / 4).cast("int") - 1), lambda n: n)
    return F.transform(
        starts,
        lambda n: F.struct(label(n).alias("label"), F.element_at("embedding", 4 * n + 1).alias("score"), F.array(*(side(4 * n + j) for j in (1, 2, 3, 4))).alias("box")),
    )


@query
def box_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", masks.valid_boxes(_detections(40, 10), F.lit(20), F.lit(20)).alias("d"))
    return rows.select("vec_id", F.explode("d").alias("d")).select("vec_id", F.col("d.label").alias("label"), P.box_area(F.col("d.box")).alias("area"))


# Tags and prompts


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, name, category, p): the elements of an embedding as tag probabilities."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "e"))
    return rows.select("vec_id", F.concat(F.lit("tag_"), "pos", F.lit("(a)")).alias("name"), F.when(F.col("pos") % 4 == 3, 4).when(F.col("pos") % 12 == 0, 9).otherwise(0).alias("category"), F.abs(F.col("e").cast("double")).alias("p"))


@query
def mcut_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.mcut_threshold(_scores(spark, sf_dir), ["vec_id"])


@query
def select_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tags.selected_tags(_scores(spark, sf_dir), ["vec_id"], general=0.1, character=0.15)
    return found.select("vec_id", "rating", "caption", F.array_join("characters", "|").alias("characters"), X.extended_prompt(F.lit("paint"), F.col("caption")).alias("prompt"))


@query
def best_aspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("height"), (F.col("p_size") + F.pmod(F.col("p_partkey"), F.lit(40))).alias("width"))
    found = tags.best_aspect(parts, [(768, 512), (512, 768), (512, 512)])
    return found.select("p_partkey", F.col("best_size.width").alias("best_width"), F.col("best_size.height").alias("best_height"))


@query
def append_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = lambda who, what: F.struct(F.lit("p").alias("prompt"), F.lit(who).alias("image_tagger"), F.lit("t").alias("processor"), what.alias("tag"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") == "en", F.array(entry("llava", F.col("source")))).when(F.col("lang") == "fr", F.array(entry("other", F.col("source")))).alias("reference_frame_tags"))
    added = tags.append_caption(rows, "llava", entry("llava", F.lit("new")))
    return added.select("doc_id", F.array_join(F.transform("reference_frame_tags", lambda t: F.concat(t["image_tagger"], F.lit("="), t["tag"])), ",").alias("captions"))


PROMPTS = {"en": ["a painting", "a sketch"], "fr": ["une toile"], "loomis_pencil": ["a head"]}


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.array("lang").alias("art_media"), F.array("source").alias("art_style"))
    return tags.prompts_for(rows, PROMPTS)


@query
def prompt_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wanted(spark, sf_dir).select("doc_id", "prompt")


@query
def uncovered_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "a painting").otherwise("une toile").alias("prompt"))
    return tags.uncovered(_wanted(spark, sf_dir).select("doc_id", "prompt"), made, ["doc_id"])


# Geometry, lookups and the viewer's helpers


@query
def canvas_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = grid(spark, sf_dir)
    found = masks.split_column(pixels, ["vec_id"], 8, left=0.25, right=0.75)
    kept = masks.right_half(pixels, found, ["vec_id"], 8)
    return kept.groupBy("vec_id").agg(F.count("*").alias("n"), F.sum(F.col("v") * (F.col("x") + 1)).alias("weighted"))


@query
def box_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = lambda i: F.floor(F.abs(F.element_at("embedding", i).cast("double")) * 40).cast("int")
    boxes = F.transform(F.sequence(F.lit(1), F.size("embedding") - 1, F.lit(2)), lambda i: F.struct(F.array(side(i), side(i + 1), side(i) + 3, side(i + 1) + 2).alias("box")))
    own = table(spark, sf_dir, "embeddings").select("vec_id", boxes.alias("boxes"))
    cells = own.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(7)))).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(7))))
    return masks.fill_boxes(cells, F.col("boxes")).groupBy("vec_id").agg(F.count_if("m").alias("n"))


@query
def polygon_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    corner = lambda i: F.floor(F.abs(F.element_at("embedding", i).cast("double")) * 100).cast("double")
    point = lambda i: F.struct(corner(i).alias("x"), corner(i + 1).alias("y"))
    polygons = F.transform(F.sequence(F.lit(1), F.size("embedding") - 7, F.lit(8)), lambda i: F.array(*(point(i + j) for j in (0, 2, 4, 6))))
    own = table(spark, sf_dir, "embeddings").select("vec_id", polygons.alias("polygons"))
    cells = own.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(15)))).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(15))))
    return masks.fill_polygons(cells, F.col("polygons")).groupBy("vec_id").agg(F.count_if("m").alias("n"))


@query
def resize_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = F.col("p_size") * 7 + 3, F.pmod(F.col("p_partkey"), F.lit(90)) + 11
    rows = table(spark, sf_dir, "part").select("p_partkey", P.contain_size(w, h, 64, 48).alias("fit"), P.cover_crop(w, h, 64, 48).alias("crop"), P.ceil_modulo(w, 8).alias("padded"))
    return rows.select("p_partkey", "fit.*", F.col("crop.x").alias("crop_x"), F.col("crop.y").alias("crop_y"), "padded")


@query
def overlay_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = grid(spark, sf_dir).withColumn("o", F.when(F.col("v") > 128, F.lit(255)))
    return pixels.groupBy("vec_id").agg(F.sum(P.blend(F.col("v"), F.col("o"), 0.5)).alias("total"))


@query
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.lookup(table(spark, sf_dir, "documents"), "src3", 3, "doc_id").select("doc_id", "source", "lang")


@query
def override_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "documents").select("doc_id", F.array(F.struct(F.lit("extract").alias("name"), F.lit("{}").alias("config"))).alias("video_processor"))
    return registry.stages(registry.override_stage(items, "tag", "{}")).select("doc_id", F.col("stage.name").alias("stage_name"))


@query
def pager(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("ref_idx"))
    return registry.neighbours(turns, ["conv_id"])


@query
def reference_or_stand_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The viewer's reader: a document's third turn, or a stand-in."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("ref_idx"), "role")
    return registry.references(turns, table(spark, sf_dir, "documents"), ["doc_id"], F.lit("not found"), "role", place=2)


@query
def clear_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") == "en", F.array("source")).alias("reference_frame_tags"))
    return registry.clear_tags(rows).select("doc_id", F.coalesce(F.size("reference_frame_tags"), F.lit(-1)).alias("n_tags"), F.col("reference_frame_tags").isNull().alias("missing"))


# Pixels with channels


def colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, i, vec_id, y, x, bgr): frames as 2 x 11 pixels of three channels; what the last pixel lacks is 0."""
    byte = lambda e: F.pmod(F.floor(F.coalesce(e.cast("double"), F.lit(0.0)) * 256), F.lit(256)).cast("long")
    pixel = lambda p: F.array(*(byte(F.try_element_at("embedding", 3 * p + j)) for j in (1, 2, 3)))
    cells = F.transform(F.sequence(F.lit(0), F.lit(21)), pixel)
    rows = frames(spark, sf_dir).select("k", "i", "vec_id", F.posexplode(cells).alias("p", "bgr"))
    return rows.select("k", "i", "vec_id", F.floor(F.col("p") / 11).cast("int").alias("y"), (F.col("p") % 11).alias("x"), "bgr")


def labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return colors(spark, sf_dir).withColumn("lab", P.bgr_to_lab(F.col("bgr"))).drop("bgr")


@query
def lab_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda i: F.sum(F.element_at("lab", i))
    return labs(spark, sf_dir).groupBy("vec_id").agg(at(1).alias("l"), at(2).alias("a"), at(3).alias("b"))


@query
def keyframes_lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.keyframes(labs(spark, sf_dir), ["k"], ["y", "x"], "lab", diff=10, changes=13, channels=True)


@query
def difference_opened(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = masks.difference_mask(labs(spark, sf_dir), ["k"], ["y", "x"], "lab", 8, kernel=2)
    return found.groupBy("k", "i").agg(F.count_if("m").alias("n"), F.sum(F.when(F.col("m"), F.col("x") + 11 * F.col("y")).otherwise(0)).alias("places"))


@query
def split_column_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = colors(spark, sf_dir).select("vec_id", "y", "x", F.posexplode("bgr").alias("c", "v"))
    return masks.split_column(rows, ["vec_id"], 11, left=0.25, right=0.75, channel="c")


@query
def swap_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    red = F.element_at(P.swap_channels(F.col("bgr")), 1)
    return colors(spark, sf_dir).groupBy("vec_id").agg(F.sum(red * (F.col("x") + 1)).alias("weighted"))


@query
def opened_thrice(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = masks.opened(grid(spark, sf_dir).withColumn("m", F.col("v") > 60), ["vec_id"], 2, erode=1, dilate=3)
    return kept.groupBy("vec_id").agg(F.count_if("m").alias("n"), F.sum(F.when(F.col("m"), F.col("x") + 8 * F.col("y")).otherwise(0)).alias("places"))


@query
def prompt_kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.array(F.lit("hand"), F.lit("pen"), F.lit("cup"))
    rows = grid(spark, sf_dir).withColumn("prompt", F.explode(named))
    least = F.when(F.col("prompt") == "hand", 250).when(F.col("prompt") == "pen", 252).otherwise(254)
    grown = masks.dilate_prompts(rows.withColumn("m", F.col("v") > least), ["vec_id"], {"hand": 4, "pen": 1}, whole=2)
    return grown.groupBy("vec_id").agg(F.count_if("m").alias("n"), F.sum(F.when(F.col("m"), F.col("x") + 8 * F.col("y")).otherwise(0)).alias("places"))


# Ranges, canvases and logos


@query
def sampled_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extraction stage: even samples of the detected range, each with its progress."""
    rows = recordings(spark, sf_dir).select("k", "i", "hit", "v")
    found = series.first_last_hit(rows, ["k"], stride=3)
    ranges = found.where("start_idx >= 0 and end_idx >= 0")
    sampled = series.even_sample(rows.select("k", "i", "v"), ["k"], ranges=ranges)
    return series.progress(sampled, ["k"], ranges).select("k", "sample_no", "i", "v", F.round("progress", 9).alias("progress"))


def _starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, start_frame_idx): one start for each series of frames, missing, before the first or behind the last one for some."""
    start = F.when(F.col("k") % 5 == 0, F.lit(None).cast("long")).when(F.col("k") % 5 == 1, F.lit(-1).cast("long")).when(F.col("k") % 5 == 2, F.lit(10_000_000).cast("long"))
    return frames(spark, sf_dir).select("k").distinct().withColumn("start_frame_idx", start.otherwise(F.col("k")))


@query
def split_at_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = grid(spark, sf_dir)
    columns = masks.split_column(pixels, ["k", "i"], 8, left=0.25, right=0.75)
    found = series.seek(_starts(spark, sf_dir), columns, ["k"], "start_frame_idx", "split_x", "split_x")
    kept = masks.right_half(pixels, found, ["k"], 8)
    return kept.groupBy("k").agg(F.count("*").alias("n"), F.sum(F.col("v") * (F.col("x") + 1)).alias("weighted"))


@query
def canvas_from_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir)
    meta = _starts(spark, sf_dir).select("k", "start_frame_idx", (F.col("k") == 3).alias("canvas_detected"), F.array(F.lit(1), F.lit(2), F.lit(3), F.lit(4)).alias("canvas_coordinates"), F.lit(20).alias("width"), F.lit(16).alias("height"))
    boxes = rows.where("k <> 4").select("k", "i", _detections(40, 10).alias("detections"))
    found = masks.detect_canvas(meta, boxes, ["k"])
    return found.select("k", "canvas_detected", F.array_join("canvas_coordinates", ",").alias("box"))


@query
def logo_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = frames(spark, sf_dir).where("vec_id % 7 <> 3").select("vec_id", _detections(20, 2).alias("detections"))
    marked = masks.logo_boxes(grid(spark, sf_dir), found, ["vec_id"], 8, 8, least=0.05)
    return marked.groupBy("vec_id").agg(F.count_if("m").alias("n"), F.sum(F.when(F.col("m"), F.col("v")).otherwise(0)).alias("total"))


@query
def logo_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logo stage: frames whose flag is not set, the masks of two prompts without those of failed frames, fill and flag."""
    flag = F.when(F.col("vec_id") % 5 == 0, True).when(F.col("vec_id") % 5 == 1, False)
    pixels = grid(spark, sf_dir).select("k", "i", "y", "x", "v", flag.alias("logo_removed"))
    prompts = F.explode(F.array(F.struct(F.lit("logo").alias("prompt"), (F.col("v") > 240).alias("m")), F.struct(F.lit("text").alias("prompt"), (F.col("v") < 12).alias("m"))))
    found = pixels.where("i % 7 <> 3").select("k", "i", "y", "x", prompts.alias("p")).select("k", "i", "y", "x", "p.*")
    done = masks.remove_logos(pixels, found, ["k"])
    return done.groupBy("k", "i").agg(F.sum(F.col("v") * (F.col("x") + 8 * F.col("y") + 1)).alias("weighted"), F.bool_and("logo_removed").alias("done"))


@query
def success_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("ok")), "doc_id", "left")
    return series.success_counts(rows, ["source"], "ok")


@query
def resize_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = F.col("p_size") * 7 + 3, F.pmod(F.col("p_partkey"), F.lit(90)) + 11
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", P.short_side_crop(w, h, 64).alias("s"), P.stretch_size(64, 48).alias("t"), P.uncontain(w, h, 64, 48).alias("u")
    )
    return rows.select(
        "p_partkey", F.col("s.width").alias("short_w"), F.col("s.height").alias("short_h"), F.col("s.x").alias("crop_x"), F.col("s.y").alias("crop_y"), F.col("t.width").alias("stretch_w"),
        F.col("u.x").alias("box_x"), F.col("u.y").alias("box_y"), F.col("u.width").alias("box_w"), F.round("u.scale_x", 6).alias("scale_x"),
    )


# More of the registry, tags and stages


@query
def playlist_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source is a playlist of its documents, each language a channel of its own; one url is unknown."""
    docs = table(spark, sf_dir, "documents")
    urls = docs.select(F.explode(F.array("source", "lang")).alias("url")).distinct().unionByName(docs.limit(1).select(F.lit("nowhere").alias("url")))
    catalog = docs.select(F.col("source").alias("url"), F.col("doc_id").alias("id")).unionByName(docs.select(F.col("lang").alias("url"), F.col("doc_id").alias("id")))
    return registry.expand(urls.withColumn("is_playlist", F.lit(True)), catalog).select("url", "id")


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("processed"), (F.col("toxic") == 1).alias("exclude_video"))
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars").join(labels, "doc_id", "left")


@query
def fetch_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"))
    meta = _flags(spark, sf_dir).withColumn("canvas_detected", F.col("lang") == "en")
    return registry.to_fetch(meta, stored, ["doc_id"]).select("doc_id", "canvas_detected")


@query
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.to_delete(_flags(spark, sf_dir), F.col("lang") == "en").select("doc_id", "source")


@query
def toggle_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), (F.col("conv_id") % 2 == 0).alias("exclude_video")).distinct()
    return registry.set_excluded(_flags(spark, sf_dir), changes, ["doc_id"]).select("doc_id", "exclude_video")


@query
def processed_with_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"))
    return registry.shown(_ranges(spark, sf_dir), shown, ["k"])


@query
def needs_logo(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _flags(spark, sf_dir).withColumnRenamed("processed", "logo_removed")
    return masks.needs_logo_removal(rows).groupBy("source").agg(F.count("*").alias("n"))


@query
def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored attributes, decoded: the events' JSON and their types, which are none."""
    return table(spark, sf_dir, "events").select("event_id", X.decoded_attribute(F.col("props")).alias("props"), X.decoded_attribute(F.col("event_type")).alias("kind"), X.decoded_attribute(F.concat(F.lit("["), "event_type")).alias("broken"))


@query
def file_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("doc_id") % 2 == 0, F.concat("source", F.lit(".mp4"))).otherwise(F.concat("source", F.lit(".mp4.log")))
    return table(spark, sf_dir, "documents").select("doc_id", X.strip_suffix(name, ".mp4").alias("stem"))


@query
def select_tags_mcut(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tags.selected_tags(_scores(spark, sf_dir), ["vec_id"], mcut=True)
    return found.select("vec_id", "rating", "caption", F.array_join("characters", "|").alias("characters"))


@query
def tag_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tagging stage: media to prompts, rows of this tagger left out, one caption a prompt."""
    entry = lambda who, prompt, what: F.struct(prompt.alias("prompt"), F.lit(who).alias("image_tagger"), F.lit("t").alias("processor"), what.alias("tag"))
    own = F.when(F.col("doc_id") % 3 == 0, F.array(entry("wd", F.lit("p"), F.lit("old")))).when(F.col("doc_id") % 3 == 1, F.array(entry("other", F.lit("p"), F.lit("old"))))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.array("lang").alias("art_media"), F.array("source").alias("art_style"), own.alias("reference_frame_tags"))
    done = tags.tag_references(rows, PROMPTS, "wd", entry("wd", F.col("prompt"), F.concat(F.lit("seen: "), F.col("prompt"))))
    return done.select("doc_id", "prompt", F.array_join(F.transform("reference_frame_tags", lambda t: t["tag"]), "|").alias("captions"))


@query
def process_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main path: every unprocessed recording through its own list of stages."""
    step = lambda name, config: F.struct(F.lit(name).alias("name"), F.lit(config).alias("config"))
    rows = recordings(spark, sf_dir).select("k", "i", "v", "m")
    chain = F.when(F.col("k") % 3 == 0, F.array(step("temporal_median", '{"window": 11}'))).when(F.col("k") % 3 == 1, F.array(step("clean", '{"fill": 7}'), step("temporal_median", None)))
    items = rows.select("k").distinct().select("k", (F.col("k") % 4 == 0).alias("processed"), chain.otherwise(F.array(step("reference", ""))).alias("video_processor"))
    return stages.process(items, rows, ["k"]).select("k", "i", "v")


@query
def process_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixel frames through lists with parameters of their own: canvases cut and smoothed, logos filled and frames sampled, masks grown."""
    pixels = grid(spark, sf_dir)
    box = F.when(F.col("i") % 2 == 0, F.array(F.lit(0.4), F.lit(-1.0), F.lit(7.6), F.lit(6.5)))
    rows = pixels.select("k", "i", "y", "x", "v", (F.col("v") > 250).alias("m"), box.alias("box"), (F.col("v") > 200).alias("logo"), (F.col("i") % 5 == 0).alias("logo_removed"))
    step = lambda name, config="{}": F.struct(F.lit(name).alias("name"), F.lit(config).alias("config"))
    lists = F.when(F.col("k") % 3 == 0, F.array(step("canvas", '{"erosion": 1}'), step("temporal_median", '{"window": 3}')))
    lists = lists.when(F.col("k") % 3 == 1, F.array(step("logos"), step("extract", '{"most": 7}'))).otherwise(F.array(step("masks", '{"kernel": 3}')))
    items = rows.select("k").distinct().select("k", (F.col("k") == 7).alias("processed"), lists.alias("video_processor"), F.lit(2).cast("long").alias("start_frame_idx"))
    done = stages.process(items, rows, ["k"])
    return done.groupBy("k", "i").agg(F.count("*").alias("n"), F.sum(F.col("v") * (F.col("x") + 8 * F.col("y") + 1)).alias("weighted"), F.count_if("m").alias("n_masked"))


# Blur, movement and sizes


@query
def never_changed_blurred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.never_changed(filters.blurred(grid(spark, sf_dir), ["k", "i"]), ["k"], ["y", "x"], threshold=15.98)


@query
def blurred_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A kernel of five, which reaches beyond both borders of narrow frames."""
    soft = filters.blurred(grid(spark, sf_dir), ["vec_id"], size=5, sigma=1.5)
    return soft.groupBy("vec_id").agg(F.sum(F.col("v") * (F.col("x") + 8 * F.col("y") + 1)).alias("weighted"))


@query
def keyframes_blurred(spark: SparkSession, sf_dir: str) -> DataFrame:
    soft = filters.blurred(colors(spark, sf_dir), ["k", "i"], "bgr", channels=3)
    labs_ = soft.withColumn("lab", P.bgr_to_lab(F.col("bgr"))).drop("bgr")
    return series.keyframes(labs_, ["k"], ["y", "x"], "lab", diff=10, changes=20, channels=True)


@query
def movement_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences in a window, each eroded and dilated into the mask."""
    found = movement.movement_masks(grid(spark, sf_dir), ["k"], threshold=6.9)
    return found.groupBy("k", "i").agg(F.count_if("m").alias("n"), F.sum(F.when(F.col("m"), F.col("x") + 8 * F.col("y")).otherwise(0)).alias("places"))


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames cut to a size of their own, from 3 x 6 to 8 x 8."""
    w, h = (3 + F.col("vec_id") % 6).cast("int"), (6 + F.col("vec_id") % 3).cast("int")
    return grid(spark, sf_dir).select("vec_id", w.alias("w"), h.alias("h"), "y", "x", "v").where("x < w and y < h")


@query
def resize_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames fitted into 12 x 9 and padded, and brought back to their size."""
    there = filters.padded(_sized(spark, sf_dir), ["vec_id"], ("w", "h"), 12, 9, fill=7, kind="bilinear")
    back = filters.unpadded(there, ["vec_id"], ("w", "h"), 12, 9, kind="bilinear")
    total = lambda df, kind: df.groupBy("vec_id").agg(F.count("*").alias("n"), F.sum(F.col("v") * (F.col("x") + 12 * F.col("y") + 1)).alias("weighted")).withColumn("kind", F.lit(kind))
    return total(there, "padded").unionByName(total(back, "back"))
