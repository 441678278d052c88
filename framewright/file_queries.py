"""Queries that write tables as the files a pipeline keeps (catalogs, registries, splits, logs) and read them back.

The files go to the folder that the cluster shares; they hold what Spark derives from the given tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.operators import registry, splits
from framewright.plans import catalog
from framewright.queries import colors, query, recordings, table
from framewright.sources import layout, readers, versions, writers
from framewright.sources.scratch import scratch_path
from framewright.streaming import arrivals, ordered


def _items(spark: SparkSession, sf_dir: str) -> str:
    """The documents as a catalog of JSON lines, in the order of their ids whatever files and partitions they come from; its path."""
    path = f"{scratch_path(spark, 'items')}.jsonl"
    step = lambda n: F.struct(n.alias("name"), F.lit("{}").alias("config"))
    docs = table(spark, sf_dir, "documents").orderBy("doc_id").select(
        F.lit("youtube").alias("source"),
        F.col("doc_id").cast("string").alias("url"),
        F.array(step(F.col("lang")), step(F.when(F.col("doc_id") % 3 != 0, F.col("source")))).alias("video_processor"),
        F.array("source").alias("channel_ids"),
        F.when(F.col("doc_id") % 2 == 0, F.array("lang", "source")).alias("art_style"),
        F.when(F.col("doc_id") % 5 == 0, F.lit(True)).alias("is_playlist"),
    )
    writers.write_items(docs, path)
    return path


@query
def items_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_items(spark, _items(spark, sf_dir)).select("url", F.array_join("art_style", "; ").alias("art"), "is_playlist", F.element_at("channel_ids", 1).alias("channel"))


@query
def stage_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_stage_configs(spark, _items(spark, sf_dir)).groupBy("name", "config").agg(F.count("*").alias("n"))


@query
def register_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registration job on catalog files: the first of equal ids stays, a missing file is left out, and a second run adds nothing."""
    base = scratch_path(spark, "registry")
    docs = table(spark, sf_dir, "documents")
    known = docs.select(F.col("doc_id").cast("string").alias("url"), F.md5("text").alias("id"), F.lit("t").alias("title"), F.lit("l").alias("license"), F.lit("c").alias("channel"), F.col("source").alias("channel_id"))
    files = [_items(spark, sf_dir), f"{base}/missing.jsonl"]
    catalog.register_files(spark, base, files, known)
    return catalog.register_files(spark, base, files, known).groupBy("channel_id", "processed").agg(F.count("*").alias("n"))


@query
def registry_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry that is saved, read as missing before, and replaced."""
    path, schema = scratch_path(spark, "registry"), "doc_id long, source string"
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    for rows in (docs.where("doc_id % 2 = 0"), docs):
        old = readers.read_registry(spark, path, schema)
        writers.save_registry(old.unionByName(rows.join(old.select("doc_id"), "doc_id", "left_anti")), path)
    return registry.source_counts(readers.read_registry(spark, path, schema))


@query
def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "splits")
    split = F.when(F.col("quality") == 1, "train").otherwise("test")
    table(spark, sf_dir, "labels").select(F.to_json(F.create_map(F.lit("youtube"), F.create_map(F.col("doc_id").cast("string"), split))).alias("value")).write.text(path)
    return readers.read_split_file(spark, path, lines=True)


@query
def split_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dataset")
    splits.export_split(splits.assign_split(table(spark, sf_dir, "documents").select("doc_id", "source"), None, ["doc_id"], "doc_id"), path)
    return spark.read.parquet(path).groupBy("split", "source").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query
def fold_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "folds")
    dealt = splits.fold_sets(splits.folds(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id")).drop("chunk")
    splits.export_folds(dealt, path)
    return spark.read.parquet(path).groupBy("fold", "part", "source").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query
def labels_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "labels")
    table(spark, sf_dir, "documents").select(F.concat_ws(", ", "lang", "source").alias("name"), (F.col("doc_id") % 10).cast("int").alias("category")).write.option("header", True).csv(path)
    return readers.read_labels(spark, path).groupBy("name", "category").agg(F.count("*").alias("n"))


def _folders(spark: SparkSession, sf_dir: str) -> str:
    """One text file for each (source, language) of the documents, two folders deep; its path."""
    path = scratch_path(spark, "folders")
    groups = table(spark, sf_dir, "documents").groupBy("source", F.col("lang").alias("video_id")).agg(F.count("*").alias("n"), F.max("n_chars").alias("most"))
    value = F.when(F.col("video_id") == "de", F.lit('{"n": 1')).otherwise(F.to_json(F.struct("n", "most")))
    groups.select("source", "video_id", value.alias("value")).repartition("source", "video_id").write.partitionBy("source", "video_id").text(path)
    return path


@query
def metadata_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = readers.read_metadata(spark, _folders(spark, sf_dir))
    return found.select("source", "video_id", "ok", F.try_element_at("meta", F.lit("n")).cast("long").alias("n"))


@query
def log_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = table(spark, sf_dir, "documents").select("source", F.explode(F.array("lang", F.lit("none"))).alias("video_id")).distinct()
    logs = readers.read_logs(spark, _folders(spark, sf_dir), folders, glob="*.txt")
    return logs.select("source", "video_id", (F.col("value") == readers.NO_LOG).alias("missing"))


@query
def folder_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_folders(spark, _folders(spark, sf_dir))


@query
def registry_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registries as JSON maps of maps, one file a source."""
    path = scratch_path(spark, "json")
    groups = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    item = F.create_map(F.col("source"), F.create_map("lang", F.struct("n")))
    groups.select(F.concat_ws("-", "source", "lang").alias("file"), F.to_json(item).alias("value")).repartition("file").write.partitionBy("file").text(path)
    return readers.read_registry_json(spark, path)


@query
def process_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processing job over a stored registry: all open items, then one anew, then a stage of its own for all that are not excluded; each item is stored once."""
    base = scratch_path(spark, "job")
    rows = recordings(spark, sf_dir).select(F.lit("youtube").alias("source"), F.col("k").cast("string").alias("video_id"), "i", "v", "m")
    rows.write.parquet(f"{base}/frames")
    steps = F.array(F.struct(F.lit("clean").alias("name"), F.lit('{"fill": 3}').alias("config")))
    none = [F.lit(None).cast(t).alias(n) for n, t in (c.split(" ", 1) for c in catalog.REGISTRY.split(", ")) if n not in ("source", "video_id", "video_processor", "processed", "exclude_video")]
    number = F.col("video_id").cast("long")
    known = rows.select("source", "video_id").distinct().select("source", "video_id", steps.alias("video_processor"), (number % 2 == 0).alias("processed"), (number % 3 == 0).alias("exclude_video"), *none)
    writers.save_registry(known.select(*catalog.COLUMNS), f"{base}/registry")
    catalog.process_registry(spark, base)
    catalog.process_registry(spark, base)
    catalog.process_registry(spark, base, only=("youtube", "1"))
    catalog.process_registry(spark, base, override=("reference", "{}"))
    stored = catalog.read_processed(spark, base).groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("total"))
    flags = versions.read(spark, f"{base}/registry", catalog.REGISTRY).select(F.concat_ws(":", "source", "video_id").alias("k"), "processed")
    return flags.join(stored, "k", "left")


@query
def reference_clean_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "job")
    table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("ref_idx"), "role").write.parquet(f"{base}/reference_frames")
    meta = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") == "en", F.array("source")).alias("reference_frame_tags"))
    meta.write.parquet(f"{base}/video_meta")
    catalog.clean_up(spark, base, variations=True, tags=True)
    kept = spark.read.parquet(f"{base}/reference_frames").select(F.lit("frames").alias("kind"), F.col("conv_id").alias("id"), F.col("ref_idx").alias("n"))
    tags = spark.read.parquet(f"{base}/video_meta").select(F.lit("tags").alias("kind"), F.col("doc_id").alias("id"), F.coalesce(F.size("reference_frame_tags"), F.lit(-1)).alias("n"))
    return kept.unionByName(tags)


@query
def pipelines_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pipelines in one dataset, by split; excluded items and items without frames stay out."""
    bases, out = [scratch_path(spark, "job") for _ in range(2)], scratch_path(spark, "dataset")
    none = [F.lit(None).cast(t).alias(n) for n, t in (c.split(" ", 1) for c in catalog.REGISTRY.split(", ")) if n not in ("source", "video_id", "exclude_video")]
    for n, base in enumerate(bases):
        docs = table(spark, sf_dir, "documents").where(F.col("doc_id") % 2 == n).select("source", F.col("doc_id").cast("string").alias("video_id"), (F.col("lang") == "en").alias("exclude_video"), *none)
        writers.save_registry(docs.select(*catalog.COLUMNS), f"{base}/registry")
        frames = table(spark, sf_dir, "documents").where("doc_id % 3 <> 0").select("source", F.col("doc_id").cast("string").alias("video_id"), "n_chars")
        frames.write.parquet(f"{base}/frames")
    catalog.export_pipelines(spark, bases, out)
    return spark.read.parquet(out).select("source", F.col("video_id").cast("string").alias("video_id"), "split", "n_chars")


@query
def items_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and their turns in buckets by item: eligible items and their counts without an exchange, then one item's rows out of one bucket."""
    path = scratch_path(spark, "buckets")
    name = f"b{path[-12:]}"
    docs = table(spark, sf_dir, "documents").select("source", F.col("doc_id").cast("string").alias("video_id"), (F.col("lang") == "en").alias("exclude_video"))
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("frame_no"), "role", F.encode("text", "UTF-8").alias("blob"))
    frames = turns.join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id").select("source", F.col("doc_id").cast("string").alias("video_id"), "frame_no", "role", "blob")
    known = layout.write_by_item(docs, f"{name}_items", f"{path}/items", 16)
    meta, pixels = layout.write_frames_by_item(frames, name, f"{path}/frames", 16)
    counted = registry.frame_counts(registry.eligible(known, meta, [layout.KEY]), meta, [layout.KEY]).select(layout.KEY, "n_frames")
    one = layout.lookup_by_item(pixels, "src3", "3").select(layout.KEY, F.octet_length("blob").cast("long").alias("n_frames"))
    return counted.unionByName(one)


def _streamed(spark: SparkSession, rows: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a stream makes of rows (k, i, v, m) that arrive in three lots, in no order."""
    path, schema = scratch_path(spark, "stream"), "k long, i long, v long, m boolean"
    # Placed once: each lot would else index all recordings anew.
    rows.select("k", "i", "v", "m").write.parquet(f"{path}/rows")
    placed = spark.read.schema(schema).parquet(f"{path}/rows")
    for n in range(3):
        placed.where(F.pmod(F.xxhash64("k", "i"), F.lit(3)) == n).write.mode("append").parquet(f"{path}/in")
        ordered.drain(operator(arrivals.read_arrivals(spark, f"{path}/in", schema)), f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out")


@query
def stream_clean_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, recordings(spark, sf_dir).select("k", "i", "v", "m"), ordered.clean_fill_ordered).select("k", "i", F.col("v").alias("clean_v"))


@query
def stream_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recordings(spark, sf_dir).select("k", "i", "v")
    ends = rows.groupBy("k").agg((F.max("i") + 1).alias("i")).select("k", "i", F.lit(0).cast("long").alias("v"), F.lit(True).alias("m"))
    return _streamed(spark, rows.withColumn("m", F.lit(False)).unionByName(ends), ordered.median_ordered).select("k", "i", F.col("v").alias("median_v"))


@query
def stills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each label's brightest pixels, written as an image file and decoded again."""
    path = scratch_path(spark, "stills")
    top = F.array(*(F.max(F.element_at("bgr", c)) for c in (1, 2, 3)))
    frames = colors(spark, sf_dir).groupBy("k", "y", "x").agg(top.alias("bgr")).select(F.lit("label").alias("source"), F.concat(F.lit("v"), "k").alias("video_id"), "y", "x", "bgr")
    writers.write_stills(writers.bitmaps(frames, ["source", "video_id"]), path)
    digits = F.hex("data")
    byte = lambda i: F.conv(F.substr(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("long") * (i + 1)
    places = F.sequence(F.lit(0), F.octet_length("data") - 1)
    return readers.read_stills(spark, path).select("source", "video_id", "width", "height", F.aggregate(F.transform(places, byte), F.lit(0).cast("long"), lambda a, b: a + b).alias("weighted"))
