"""Probing series from both ends with a model that only sees what must be seen.

Probes go in rounds of growing batches. A round takes the next probes of the series that have no hit yet, joins them with
their frames, and asks the model; the answers are written before the next round begins. Rounds grow twofold, so ``most`` probes take
log2(most) rounds, each over fewer series than the last. Frames between probes, and behind a first hit's
batch, are never read by the model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.sources.scratch import scratch_path
from framewright.sources.writers import delete

#: Maps probed rows to themselves with a boolean column ``hit``.
Model = Callable[[DataFrame], DataFrame]


def per_batch(build: Callable[[], Callable[[list], list[bool]]], value: str, batch: int = 1) -> Model:
    """A model that is built once a task and called with ``batch`` frames at a time; it is not called on a probe behind its series' first hit in the round."""

    def model(rows: DataFrame) -> DataFrame:
        kind = rows.select("__probe", "__side", "__key", value).schema
        ordered = rows.select("__probe", "__side", "__key", value).repartition("__key", "__side").sortWithinPartitions("__key", "__side", "__probe")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            detect, last, open_ = build(), None, True
            for table in batches:
                probes, sides, names, frames = (c.to_pylist() for c in table.columns)
                hits: list[bool | None] = [None] * len(probes)
                a = 0
                while a < len(probes):
                    own = (names[a], sides[a])
                    if own != last:
                        last, open_ = own, True
                    b = a + 1
                    while b < len(probes) and b < a + batch and (names[b], sides[b]) == own:
                        b += 1
                    if open_:
                        hits[a:b] = [bool(h) for h in detect(frames[a:b])]
                        open_ = not any(hits[a:b])
                    a = b
                yield pa.RecordBatch.from_arrays([table.column(0), table.column(1), table.column(2), pa.array(hits, pa.bool_())], ["__probe", "__side", "__key", "hit"])

        names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kind.fields[:3])
        return ordered.mapInArrow(run, f"{names}, hit boolean")

    return model


def probe_ends(frames: DataFrame, keys: list[str], model: Model, stride: int = 30, most: int = 300, miss: str = "none", first_batch: int = 1) -> DataFrame:
    """(keys, start_idx, end_idx, n_probed): the first hit among the probes from the start and among those from the end.

    The same answer as ``series.first_last_hit``, with a model in place of a column of hits; ``n_probed`` counts the frames the model
    was given for a series. Without a hit: -1 for ``miss="none"``, the whole series for ``miss="all"``.
    """
    spark = frames.sparkSession
    made: list[str] = []

    def kept(df: DataFrame, label: str) -> DataFrame:
        made.append(scratch_path(spark, label))
        df.write.parquet(made[-1])
        return spark.read.schema(df.schema).parquet(made[-1])

    key = F.struct(*keys)
    sizes = kept(frames.groupBy(*keys).agg((F.max("i") + 1).alias("__n")), "probe-sizes")
    sides = sizes.withColumn("__side", F.explode(F.array(F.lit("start"), F.lit("end"))))
    answers = None
    open_, done, batch = sides, 0, max(1, first_batch)
    while done < most:
        upto = min(done + batch, most)
        # Probe j is at j * stride from its end; those beyond the series do not exist.
        last = F.least(F.lit(upto - 1), F.floor((F.col("__n") - 1) / stride))
        wanted = open_.where(last >= done).withColumn("__probe", F.explode(F.sequence(F.lit(done), last.cast("int"))))
        place = F.when(F.col("__side") == "start", F.col("__probe") * stride).otherwise(F.col("__n") - 1 - F.col("__probe") * stride)
        probes = wanted.select(*keys, "__side", "__probe", place.cast("long").alias("i"))
        seen = model(frames.join(probes, [*keys, "i"]).withColumn("__key", key))
        found = seen.where("hit is not null").groupBy("__key", "__side").agg(F.min(F.when(F.col("hit"), F.col("__probe"))).alias("__first"), F.count("*").alias("__seen"))
        round_ = kept(found.select("__key.*", "__side", "__first", "__seen"), "probe-round")
        answers = round_ if answers is None else answers.unionByName(round_)
        # Series go on that have no hit yet and have frames left.
        open_ = kept(open_.join(round_.where("__first is not null").select(*keys, "__side"), [*keys, "__side"], "left_anti").where(F.floor((F.col("__n") - 1) / stride) >= upto), "probe-open")
        done, batch = upto, batch * 2
        if open_.limit(1).count() == 0:
            break
    first = lambda side: F.min(F.when(F.col("__side") == side, F.col("__first")))
    best = sizes.join(answers, keys, "left").groupBy(*keys, "__n").agg(first("start").alias("__s"), first("end").alias("__e"), F.coalesce(F.sum("__seen"), F.lit(0)).alias("n_probed"))
    none = (F.lit(-1), F.lit(-1)) if miss == "none" else (F.lit(0), F.col("__n") - 1)
    start = F.coalesce(F.col("__s") * stride, none[0]).cast("long")
    end = F.coalesce(F.col("__n") - 1 - F.col("__e") * stride, none[1]).cast("long")
    out = kept(best.select(*keys, start.alias("start_idx"), end.alias("end_idx"), "n_probed"), "probe-ends")
    for path in made[:-1]:
        delete(spark, path)
    return out
