"""Tables in numbered versions, so that writers at the same time lose nothing.

A table's folder holds its data, a folder a version, and a list of manifests: file n names the data of version n. A writer
makes new data out of the newest version and then claims the next number, which only one can: the file is made under a name
of its own and gets its number by a rename (on local disks a link) that fails where the number is taken. Who
comes second starts anew from the version that won. Readers follow the newest manifest, and never see half a version.
"""

from __future__ import annotations

import os
import random
import time
import uuid
from collections.abc import Callable
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Versions that stay for readers that began before.
KEPT = 10


class Conflict(RuntimeError):
    """The version was claimed by another writer."""


def _fs(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _manifests(spark: SparkSession, path: str) -> list[int]:
    fs, place = _fs(spark, f"{path}/_versions")
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(place) if f.getPath().getName().isdigit()) if fs.exists(place) else []


def _named(spark: SparkSession, path: str, version: int) -> str:
    fs, place = _fs(spark, f"{path}/_versions/{version:012d}")
    stream = fs.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def newest(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """The newest version's number and the folder of its data; 0 for a plain folder, or none, that was never versioned."""
    for version in reversed(_manifests(spark, path)):
        return version, f"{path}/_data/{_named(spark, path, version)}"
    fs, place = _fs(spark, path)
    plain = fs.exists(place) and any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(place))
    return 0, path if plain else None


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest version, or an empty table."""
    data = newest(spark, path)[1]
    return spark.createDataFrame([], schema) if data is None else spark.read.schema(schema).parquet(data)


def claim(spark: SparkSession, path: str, version: int, name: str) -> None:
    """Make ``name`` the data of a version; Conflict where the version has some."""
    fs, own = _fs(spark, f"{path}/_versions/.{uuid.uuid4().hex}")
    target = f"{path}/_versions/{version:012d}"
    stream = fs.create(own, False)
    stream.write(bytearray(name.encode()))
    stream.close()
    try:
        if fs.getScheme() == "file":
            os.link(urlparse(own.toString()).path, urlparse(target).path)
        else:
            jvm = spark.sparkContext._jvm
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(own.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(own, jvm.org.apache.hadoop.fs.Path(target), options)
    except FileExistsError as e:
        raise Conflict(version) from e
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception):
            raise Conflict(version) from e
        raise
    finally:
        fs.delete(own, False)


def update(spark: SparkSession, path: str, schema: str, change: Callable[[DataFrame], DataFrame], tries: int = 20) -> int:
    """Store what ``change`` makes of the newest version as the next one; its number.

    ``change`` runs again on the version that won wherever another writer was quicker, so it must not depend on what it saw before.
    """
    path = path.rstrip("/")
    for n in range(tries):
        version, data = newest(spark, path)
        old = spark.createDataFrame([], schema) if data is None else spark.read.schema(schema).parquet(data)
        name = uuid.uuid4().hex
        fs, place = _fs(spark, f"{path}/_data/{name}")
        try:
            change(old).write.parquet(place.toString())
            claim(spark, path, version + 1, name)
        except Conflict:
            fs.delete(place, True)
            time.sleep(random.uniform(0, 0.05 * 2 ** min(n, 6)))  # noqa: S311
            continue
        except Exception:
            fs.delete(place, True)
            raise
        expire(spark, path)
        return version + 1
    raise Conflict(f"{path}: no version could be claimed in {tries} tries")


def expire(spark: SparkSession, path: str, kept: int = KEPT) -> None:
    """Delete the data and manifests of all but the last versions, and a plain table's files that versions have replaced."""
    numbers = _manifests(spark, path)
    for version in numbers[:-kept]:
        for gone in (f"{path}/_data/{_named(spark, path, version)}", f"{path}/_versions/{version:012d}"):
            fs, place = _fs(spark, gone)
            fs.delete(place, True)
    if len(numbers) >= kept:
        fs, place = _fs(spark, path)
        for f in fs.listStatus(place):
            if not f.getPath().getName().startswith(("_", ".")):
                fs.delete(f.getPath(), True)
