"""Writers of registries and archives."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def save_registry(df: DataFrame, path: str) -> None:
    """Replace a registry by way of a staged copy.

    A failed write leaves the old one in place and nothing else. The old one is moved aside before the
    new one takes its name and is deleted last, so at every moment one of them is whole.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, old, aside = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path.rstrip('/')}.{mark}.new", path, f"{path.rstrip('/')}.{mark}.old"))
    fs = old.getFileSystem(conf)
    try:
        df.write.parquet(new.toString())
    except Exception:
        fs.delete(new, True)
        raise
    had = fs.exists(old)
    if had and not fs.rename(old, aside):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, old):
        if had:
            fs.rename(aside, old)
        raise OSError(f"cannot move {new.toString()} to {path}")
    fs.delete(aside, True)


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it is missing."""
    fs, place = _place(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(place) if f.isDirectory()) if fs.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _place(spark, path)
    fs.delete(place, True)


def write_items(df: DataFrame, path: str) -> None:
    """Rows as JSON lines, missing values left out."""
    df.write.json(path)


def _little(n: Column, size: int) -> Column:
    """A number's bytes in hexadecimal, the lowest first."""
    digits = F.lpad(F.hex(n), 2 * size, "0")
    return F.concat(*(F.substring(digits, 2 * i - 1, 2) for i in range(size, 0, -1)))


def bitmaps(pixels: DataFrame, keys: list[str], value: str = "bgr") -> DataFrame:
    """(keys, image): an uncompressed 24-bit bitmap of each frame's pixels (y, x, value: 8-bit blue, green and red)."""
    byte = lambda v: F.lpad(F.hex(v), 2, "0")
    cell = F.struct("x", F.array_join(F.transform(value, byte), "").alias("h"))
    joined = lambda cells: F.array_join(F.transform(cells, lambda c: c["h"]), "")
    rows = pixels.groupBy(*keys, "y").agg(joined(F.sort_array(F.collect_list(cell))).alias("h"), F.count("*").alias("w"))
    # Rows are filled up to four bytes and stand from the bottom up.
    filled = rows.withColumn("h", F.concat("h", F.repeat(F.lit("00"), F.pmod(-3 * F.col("w"), F.lit(4)).cast("int"))))
    whole = filled.groupBy(*keys).agg(joined(F.sort_array(F.collect_list(F.struct((-F.col("y")).alias("y"), "h")))).alias("h"), F.max("w").alias("w"), F.count("*").alias("n"))
    size = F.floor(F.length("h") / 2)
    # Fixed values of the format: its mark, and where headers end.
    head = [F.lit("424D"), _little(size + 54, 4), F.lit("0000000036000000" + "28000000"), _little(F.col("w"), 4), _little(F.col("n"), 4), F.lit("01001800" + "00000000"), _little(size, 4), F.lit("00" * 16)]
    return whole.select(*keys, F.unhex(F.concat(*head, "h")).alias("image"))


def write_stills(images: DataFrame, path: str) -> None:
    """One image file for each row (source, video_id, image), two folders deep. The line end that the writer adds stands behind the image's own end."""
    images.select("source", "video_id", F.col("image").cast("string").alias("value")).repartition("source", "video_id").write.partitionBy("source", "video_id").text(path)


def write_frames(df: DataFrame, path: str) -> None:
    """Frames by source; the blobs are compressed already."""
    df.write.mode("append").option("compression", "none").partitionBy("source").parquet(path)
