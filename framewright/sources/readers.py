"""Readers of catalogs, registries, split files, labels, metadata, stills and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.schema import ITEM


def exists(spark: SparkSession, path: str) -> bool:
    """Is there such a file or folder, or a match of such a pattern?"""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def read_items(spark: SparkSession, path: str, catalog_file: int = 0) -> DataFrame:
    """Source items, one JSON object a line; a malformed line fails the read.

    ``catalog_file`` and ``line`` give an item's place: the file's number, and within it a number that grows from line to line.
    """
    raw = spark.read.schema(
        "source string, url string, video_processor array<struct<name:string,config:string>>, channel_ids array<string>, art_style array<string>, "
        "art_genre array<string>, art_media array<string>, is_playlist boolean, only_channel_vid boolean"
    )
    # A part of a file starts at its block and numbers its lines; 33 bits hold a part's lines.
    line = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("n"))
    items = raw.option("mode", "FAILFAST").json(path).withColumns({"line": line, "catalog_file": F.lit(catalog_file)})
    none = F.array().cast("array<string>")
    filled = {c: F.coalesce(c, none) for c in ("art_style", "art_genre", "art_media")} | {c: F.coalesce(c, F.lit(False)) for c in ("is_playlist", "only_channel_vid")}
    return items.withColumns(filled).select(*[f.name for f in ITEM], "catalog_file", "line")


def read_stage_configs(spark: SparkSession, path: str) -> DataFrame:
    """(name, config) of each entry; malformed lines and entries without a name are skipped."""
    raw = spark.read.schema("video_processor array<struct<name:string,config:string>>, _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    one = raw.where(F.col("_corrupt_record").isNull()).select(F.explode("video_processor").alias("s"))
    return one.select("s.name", "s.config").where(F.col("name").isNotNull())


def read_split_file(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(source, video_id, split) of a JSON map of maps, or of one such map a line."""
    raw = spark.read.text(path, wholetext=not lines).select(F.from_json("value", "map<string,map<string,string>>").alias("m"))
    return raw.select(F.explode("m").alias("source", "ids")).select("source", F.explode("ids").alias("video_id", "split"))


def read_registry(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A saved registry, or an empty one where none was saved yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name string, category int").option("header", True).csv(path)


def read_stills(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images (BGR bytes) with the source and video that their folders name; unreadable files are dropped."""
    images = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path).select("image.*")
    return images.withColumns({"source": _folder(F.col("origin"), 2), "video_id": _folder(F.col("origin"), 1)})


def _folder(path: Column, up: int) -> Column:
    """The name of a folder above a file; of a folder named key=value, the value."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -up - 1), "^[a-z_]+=", "")


def read_folders(spark: SparkSession, path: str) -> DataFrame:
    """(source, video_id) of the files two levels under ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return files.select(_folder(F.col("path"), 2).alias("source"), _folder(F.col("path"), 1).alias("video_id")).distinct()


def read_registry_json(spark: SparkSession, path: str) -> DataFrame:
    """(source, video_id, item): a registry as one JSON map of maps, each item as JSON text."""
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,map<string,variant>>")).alias("source", "items"))
    return raw.select("source", F.explode("items").alias("video_id", "item")).withColumn("item", F.to_json("item"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(source, video_id, ok, meta) of the JSON files two levels under ``path``; what does not parse is not ok and empty."""
    files = spark.read.option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).text(path, wholetext=True)
    parsed = F.from_json(F.to_json(F.try_parse_json("value")), "map<string,string>")
    none = F.create_map().cast("map<string,string>")
    return files.select(
        _folder(F.input_file_name(), 2).alias("source"), _folder(F.input_file_name(), 1).alias("video_id"), parsed.isNotNull().alias("ok"), F.coalesce(parsed, none).alias("meta")
    )


#: What stands for the log of a folder without one.
NO_LOG = "Log file not found."


def read_logs(spark: SparkSession, path: str, folders: DataFrame | None = None, glob: str = "*.log") -> DataFrame:
    """(source, video_id, value) of the log files two levels under ``path``; ``folders`` (source, video_id) without one get a text that says so."""
    files = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path, wholetext=True)
    logs = files.select(_folder(F.input_file_name(), 2).alias("source"), _folder(F.input_file_name(), 1).alias("video_id"), "value")
    if folders is None:
        return logs
    return folders.select("source", "video_id").join(logs, ["source", "video_id"], "left").withColumn("value", F.coalesce("value", F.lit(NO_LOG)))
