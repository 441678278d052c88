"""Streams whose files come in any order: frames wait until the gap before them closes, then go through with their series' state.

A series' state is the place that comes next, the frames that wait, and what the operator carries: the last clean value,
or the frames of half a window. A frame that waits longer than ``patience`` gives its gap up: the missing places are passed
over, and what comes for them later is dropped, as is every place that comes twice. State is kept in RocksDB and checkpointed, so a restart goes on where it
stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OUT = "k long, i long, v long"
#: Places of a series whose waiting frames are one entry of its state.
LOT = 256


class _Ordered(StatefulProcessor):
    """Gives each series' frames to ``step`` in order; ``step`` returns what is known by then."""

    def __init__(self, patience_ms: int) -> None:
        self.patience = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "i long")
        self.waiting = handle.getMapState("lots", "lot long", "i array<long>, v array<long>, m array<boolean>")
        self.carried = handle.getValueState("carried", "a array<long>, b array<long>")

    def begin(self) -> tuple[list, list]:
        raise NotImplementedError

    def step(self, state: tuple[list, list], i: int, v: int, m: bool) -> list[tuple[int, int]]:
        raise NotImplementedError

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        at = self.next.get()[0] if self.next.exists() else 0
        fresh: dict[int, tuple[int, bool]] = {}
        for part in rows:
            for i, v, m in zip(part["i"].tolist(), part["v"].tolist(), part["m"].tolist(), strict=True):
                # The first of a place counts; places that were passed are late.
                if i >= at and i not in fresh:
                    fresh[i] = (v, m)
        yield from self._go(key, at, fresh)
        if not list(self.handle.listTimers()) and self._waits():
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience)

    def _waits(self) -> bool:
        return next(iter(self.waiting.keys()), None) is not None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        left = [k[0] for k in self.waiting.keys()]
        if left:
            yield from self._go(key, min(self._lot(min(left))), {})
            if self._waits():
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience)

    def _lot(self, lot: int) -> dict[int, tuple[int, bool]]:
        """The frames of a lot that wait."""
        if not self.waiting.containsKey((lot,)):
            return {}
        return {int(i): (int(v), bool(m)) for i, v, m in zip(*self.waiting.getValue((lot,)), strict=True)}

    def _go(self, key, at: int, fresh: dict[int, tuple[int, bool]]) -> Iterator[pd.DataFrame]:
        """All frames from ``at`` on that follow without a gap."""
        kept = self.carried.get() if self.carried.exists() else None
        state = self.begin() if kept is None else ([int(x) for x in kept[0]], [int(x) for x in kept[1]])
        out: list[tuple[int, int]] = []
        # Each lot is read once and written once, however many of its frames come or go.
        lots: dict[int, dict[int, tuple[int, bool]]] = {}
        for i, frame in fresh.items():
            if i // LOT not in lots:
                lots[i // LOT] = self._lot(i // LOT)
            lots[i // LOT].setdefault(i, frame)
        while True:
            if at // LOT not in lots:
                lots[at // LOT] = self._lot(at // LOT)
            if at not in lots[at // LOT]:
                break
            out += self.step(state, at, *lots[at // LOT].pop(at))
            at += 1
        for lot, frames in lots.items():
            if frames:
                places = sorted(frames)
                self.waiting.updateValue((lot,), (places, [frames[i][0] for i in places], [frames[i][1] for i in places]))
            else:
                self.waiting.removeKey((lot,))
        self.next.update((at,))
        self.carried.update(state)
        if out:
            yield pd.DataFrame({"k": [key[0]] * len(out), "i": [i for i, _ in out], "v": [v for _, v in out]})

    def close(self) -> None:
        pass


class _Clean(_Ordered):
    def __init__(self, patience_ms: int, seed: int) -> None:
        super().__init__(patience_ms)
        self.seed = seed

    def begin(self) -> tuple[list, list]:
        return [self.seed], []

    def step(self, state, i, v, m):
        if not m:
            state[0][0] = v
        return [(i, state[0][0])]


class _Median(_Ordered):
    """A frame's median is known when half a window has come behind it; the last ones of a series wait for its end."""

    def __init__(self, patience_ms: int, window: int) -> None:
        super().__init__(patience_ms)
        self.window = window

    def begin(self) -> tuple[list, list]:
        return [0], []  # the place that goes out next, and the last values

    def step(self, state, i, v, m):
        (out,), values = state
        half = self.window // 2
        if not m:
            values.append(v)
            del values[: -self.window - 1]
        n, first = (i, i - len(values)) if m else (i + 1, i + 1 - len(values))
        if n <= self.window:
            return [(p, values[p - first]) for p in range(out, n)] if m else []
        until = n if m else n - half
        found = []
        for p in range(out, until):
            r = min(p, n - 1 - p, half) if m else min(p, half)
            found.append((p, int(np.median(values[p - r - first : p + r + 1 - first]))))
        state[0][0] = max(out, until)
        return found


def _run(frames: DataFrame, processor: StatefulProcessor) -> DataFrame:
    return frames.groupBy("k").transformWithStateInPandas(processor, _OUT, "Append", "processingTime")


def clean_fill_ordered(frames: DataFrame, seed: int = 0, patience_ms: int = 600_000) -> DataFrame:
    """(k, i, v): masked values of a stream (k, i, v, m) become the last clean one of their series, whatever order its files come in."""
    return _run(frames, _Clean(patience_ms, seed))


def median_ordered(frames: DataFrame, window: int = 11, patience_ms: int = 600_000) -> DataFrame:
    """(k, i, v): the running median of ``series.temporal_median`` on a stream (k, i, v, m).

    A row with m at the place behind a series' last one ends it; until then its last half window, or a series no longer than the window, waits.
    """
    if window % 2 == 0:
        raise ValueError("the window must be odd")
    return _run(frames, _Median(patience_ms, window))


def register_stream(items: DataFrame, late: str = "7 days") -> DataFrame:
    """New registry rows of a stream (source, video_id, ..., arrived): ids present, each (source, video_id) once.

    An id that comes again within ``late`` of its first arrival is left out by the stream itself; the registry's own keys hold
    against what comes later.
    """
    known = items.where((F.col("video_id") != "") & F.col("video_id").isNotNull()).withColumn("arrived", F.col("arrived").cast("timestamp"))
    return known.withWatermark("arrived", late).dropDuplicatesWithinWatermark(["source", "video_id"]).withColumns({"processed": F.lit(False), "exclude_video": F.lit(False)})


def drain(stream: DataFrame, out: str, checkpoint: str, seconds: int = 3600) -> None:
    """One micro-batch over all that has come, appended to a Parquet folder; the next call goes on where it ended."""
    spark, name = stream.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(once=True).start()
        try:
            if not query.awaitTermination(seconds):
                raise TimeoutError(out)
        finally:
            query.stop()
    finally:
        spark.conf.set(name, before)
