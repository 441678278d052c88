"""Frames that arrive as files: last-clean fill with per-series state, and activity sessions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_arrivals(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream over the Parquet files that appear in a folder."""
    return spark.readStream.schema(schema).parquet(path)


def clean_fill_stream(frames: DataFrame, seed: int = 0) -> DataFrame:
    """(k, i, clean_v): masked values of a stream (k, i, v, m) become the last clean one of their series.

    The state of a series is one value. Rows are ordered within a micro-batch; a series' files must
    arrive in order.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values("i")
        last = state.get[0] if state.exists else seed
        clean = rows["v"].where(~rows["m"]).ffill().fillna(last).astype("int64")
        state.update((int(clean.iloc[-1]),))
        yield pd.DataFrame({"k": rows["k"], "i": rows["i"], "clean_v": clean})

    return frames.groupBy("k").applyInPandasWithState(step, "k long, i long, clean_v long", "last long", "append", GroupStateTimeout.NoTimeout)


def activity_sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(user_id, start, end, n) of runs of events without a longer gap; later arrivals than ``late`` are dropped."""
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp"))
    session = stamped.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count("*").alias("n"))
    return session.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")
