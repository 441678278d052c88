"""Tables laid out by item: buckets on one key, frames' metadata apart from their pixels.

Rows of an item lie in one bucket, sorted by it. So a lookup reads one bucket of a table, and what is joined or counted by
item, tables of as many buckets with each other, needs no exchange. The buckets are known to the session's catalog; ``open_by_item`` tells a new
session of files that are there already. Joins on the key and the frame's place need none either where
spark.sql.requireAllClusterKeysForCoPartition is off. Pixels, which few jobs need, are a table of their own with the same buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "video_key"
PIXELS = ("image", "blob", "pixels")


def item_key(source: Column, video_id: Column) -> Column:
    """One column for an item's two keys: Spark leaves out buckets for a single one only. Colons of the source are escaped, so no two items share a key."""
    return F.concat(F.replace(F.replace(source, F.lit("%"), F.lit("%25")), F.lit(":"), F.lit("%3A")), F.lit(":"), video_id)


def write_by_item(df: DataFrame, name: str, path: str, buckets: int, mode: str = "errorifexists") -> DataFrame:
    """Store rows with source and video_id as the bucketed table ``name``; ``mode`` append adds to its buckets."""
    keyed = df.withColumn(KEY, item_key(F.col("source"), F.col("video_id")))
    # One task a bucket writes one file a bucket.
    keyed.repartition(buckets, KEY).write.format("parquet").mode(mode).option("path", path).bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(name)
    return df.sparkSession.table(name)


def open_by_item(spark: SparkSession, name: str, path: str, buckets: int) -> DataFrame:
    """Files that ``write_by_item`` left at ``path``, as a table of this session."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def write_frames_by_item(frames: DataFrame, name: str, path: str, buckets: int, mode: str = "errorifexists") -> tuple[DataFrame, DataFrame]:
    """(metadata, pixels): two tables with the frames' places in both."""
    image = [c for c in PIXELS if c in frames.columns]
    place = ["source", "video_id", "frame_no"]
    meta = write_by_item(frames.drop(*image), f"{name}_meta", f"{path}/meta", buckets, mode)
    return meta, write_by_item(frames.select(*place, *image), f"{name}_pixels", f"{path}/pixels", buckets, mode)


def lookup_by_item(table: DataFrame, source: str, video_id: str) -> DataFrame:
    """One item's rows, out of one bucket."""
    key = source.replace("%", "%25").replace(":", "%3A") + ":" + video_id
    return table.where(F.col(KEY) == key)
