"""Helpers shared by the training-data operators: shared scratch tables and Arrow byte access."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.sources.scratch import scratch_path

#: Tables written inside ``tidy``, innermost scope last.
_scopes: list[list[str]] = []


def write_table(df: DataFrame, label: str, **options: str) -> str:
    """Write ``df`` as a Parquet table in the shared folder; its path."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").options(**options).parquet(path)
    return path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table of ``write_table``."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def in_scope(path: str, keep: bool = False) -> None:
    """Let a table go at the end of the scope it was written in, or of the one around it."""
    scope = len(_scopes) - 1 - keep
    if scope >= 0:
        _scopes[scope].append(path)


def materialize(df: DataFrame, label: str, keep: bool = False, **options: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    This cuts the lineage in a way that survives the loss of any executor. Inside ``tidy`` the table
    goes at the end of the scope, or with ``keep`` at the end of the one around it. ``options`` go to the Parquet writer.
    """
    path = write_table(df, label, **options)
    in_scope(path, keep)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Drops the tables that were materialized inside, once what depends on them is written."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            drop_table(spark, path)


def release(spark: SparkSession) -> None:
    """Let the driver forget finished plans, so that their shuffle files go before the next step."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def parts(spark: SparkSession) -> int:
    """The session's shuffle width, for explicit repartitioning."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_join(rows: DataFrame, table: DataFrame, key: str, n_rows: int, how: str = "left", hot: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with ``table`` (one row a key) on ``key``, no key's rows going to one task alone.

    Keys that hold more than one in ``parts`` of all ``n_rows`` rows are dealt over all tasks, their
    row of ``table`` being copied to each; of such keys there are fewer than ``parts``, which bounds the
    broadcast. Rows without a key, which meet nothing, are dealt as well. ``hot`` (__hot) gives those keys
    where the caller has counted them.
    """
    width = parts(rows.sparkSession)
    if hot is None:
        hot = rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > n_rows / width).select(F.col(key).alias("__hot"))
    salt = F.when(F.col("__hot").isNotNull() | F.col(key).isNull(), (F.monotonically_increasing_id() % width).cast("int")).otherwise(0)
    left = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left").withColumn("__salt", salt).drop("__hot")
    salts = F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.lit(width - 1))).otherwise(F.array(F.lit(0)))
    right = table.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left").withColumn("__salt", F.explode(salts)).drop("__hot")
    return left.join(right, [key, "__salt"], how).drop("__salt")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of an Arrow binary or string column without nulls, the offsets rebased to 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return at - at[0], np.zeros(0, np.uint8)
    return at - at[0], np.frombuffer(data, np.uint8)[at[0] : at[-1]]


def slices(offsets: np.ndarray, most: int):
    """Row ranges (a, b) of about ``most`` bytes each; a longer row stands alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), elementwise."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class RollingHash:
    """Hashes of byte substrings from one running sum of b[j] * M**j modulo 2**64."""

    MULT = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self._pow = np.ones(1, np.uint64)
        self._inv = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._pow) >= n:
            return
        size = max(n, 2 * len(self._pow))
        m = self.MULT
        inv = pow(m, -1, 1 << 64)
        for name, value in (("_pow", m), ("_inv", inv)):
            steps = np.full(size, value, np.uint64)
            steps[0] = 1
            setattr(self, name, np.multiply.accumulate(steps))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Running sums, one longer than ``data``."""
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._pow[: len(data)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hashes of data[start:end]; equal content gives equal hashes wherever it stands."""
        return mix64((prefix[end] - prefix[start]) * self._inv[start])

    def grams(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Mixed hashes of all k-byte substrings."""
        n = max(0, len(prefix) - k)
        return mix64((prefix[k : k + n] - prefix[:n]) * self._inv[:n])
