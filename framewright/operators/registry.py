"""Registering sources, keeping their metadata, and reference frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def register(items: DataFrame, catalog: DataFrame, registry: DataFrame | None = None, order: list[str] | None = None) -> DataFrame:
    """New registry rows: items expanded by url, ids present, allowed channels, not registered yet, the first wins.

    An id that is empty, then one that is registered, then one of a foreign channel is skipped.
    """
    expanded = expand(items.where(F.col("source") == "youtube"), catalog)
    ids = expanded.where(F.col("id") != "")
    if registry is not None:
        ids = ids.join(registry.select(F.col("source"), F.col("video_id").alias("id")), ["source", "id"], "left_anti")
    allowed = ids.where(~F.coalesce(F.col("only_channel_vid"), F.lit(False)) | F.array_contains("channel_ids", F.col("channel_id")))
    rank = F.row_number().over(Window.partitionBy("source", "id").orderBy(*(order or ["url"])))
    first = allowed.withColumn("__r", rank).where("__r = 1").drop("__r")
    return enriched(first.withColumnRenamed("id", "video_id").withColumn("url", F.col("video_id")))


def expand(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """A row for each entry of an item's url: one for a video, none or many for a playlist or channel."""
    return items.join(catalog, "url")


def enriched(df: DataFrame) -> DataFrame:
    """New rows with their flags."""
    return df.withColumns({"processed": F.lit(False), "exclude_video": F.lit(False)})


def with_key(df: DataFrame, source: Column, id_col: str, art: list[str]) -> DataFrame:
    """``df`` with its key across sources and its art fields in one text."""
    return df.withColumns({"video_key": F.concat_ws(":", source, F.col(id_col)), "art": F.array_join(F.array(*art), "; ")})


def source_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count("*").alias("n_videos"))


def union_pipelines(pipelines: dict[str, DataFrame], id_cols: dict[str, str]) -> DataFrame:
    """(pipeline, video_id) of several registries, one after the other."""
    tables = [df.select(F.lit(name).alias("pipeline"), F.col(id_cols[name]).alias("video_id")) for name, df in pipelines.items()]
    return reduce(DataFrame.unionByName, tables)


def to_fetch(registry: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Items whose recording is not stored yet; once it is fetched anew, its canvas is unknown."""
    return registry.join(stored.select(*keys).distinct(), keys, "left_anti").withColumn("canvas_detected", F.lit(False))


def to_delete(registry: DataFrame, remove_after: Column) -> DataFrame:
    """Items that are processed and whose recordings need not be kept."""
    return registry.where(F.coalesce(F.col("processed"), F.lit(False)) & F.coalesce(remove_after, F.lit(False)))


def last_changes(changes: DataFrame, keys: list[str], columns: list[str], order: str | None = None) -> DataFrame:
    """One row a key: of each column the last value that is not null, by ``order``, else the largest."""
    last = lambda c: F.max(c) if order is None else F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order)))
    return changes.groupBy(*keys).agg(*[last(c).alias(c) for c in columns])


def set_excluded(registry: DataFrame, changes: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """The exclude flag of ``changes`` (keys, exclude_video) in place of the old one; of several the last by ``order``, else a true one."""
    new = last_changes(changes, keys, ["exclude_video"], order).withColumnRenamed("exclude_video", "__x")
    return registry.join(new, keys, "left").withColumn("exclude_video", F.coalesce("__x", "exclude_video", F.lit(False))).drop("__x")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], order: str | None = None) -> DataFrame:
    """Last write wins, column by column; nulls of ``new`` leave the old value. Of several new rows of a key the last by ``order`` counts, else the largest value."""
    a, b = old.select(*keys, *columns), last_changes(new, keys, columns, order).withColumnsRenamed({c: f"__{c}" for c in columns})
    return a.join(b, keys, "full_outer").select(*keys, *[F.coalesce(f"__{c}", c).alias(c) for c in columns])


def append(old: DataFrame, new: DataFrame, keys: list[str], order: list[str], index: str = "frame_no") -> DataFrame:
    """``new`` rows behind the old ones of their key; their places continue the old count."""
    taken = old.groupBy(*keys).agg(F.count("*").alias("__n"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    placed = new.withColumn("__p", place).join(taken, keys, "left").withColumn(index, (F.coalesce("__n", F.lit(0)) + F.col("__p")).cast("int")).drop("__n", "__p")
    return old.unionByName(placed)


def replace(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` in place of the old ones with their keys; keys that are not there change nothing."""
    known = new.join(old.select(*keys), keys, "left_semi")
    return old.join(known.select(*keys), keys, "left_anti").unionByName(known)


def remove_reference(df: DataFrame, keys: list[str], which: Column, index: str = "ref_idx") -> DataFrame:
    """Without the rows that ``which`` names; later ones move up. Where ``which`` is null, a row stays."""
    kept = df.where(~F.coalesce(which, F.lit(False)))
    return kept.withColumn(index, (F.row_number().over(Window.partitionBy(*keys).orderBy(index)) - 1).cast("int"))


def remove_reference_at(df: DataFrame, keys: list[str], place: int, index: str = "ref_idx") -> DataFrame:
    """Without each key's row at a place; IndexError where no row has it."""
    if df.where(F.col(index) == place).limit(1).count() == 0:
        raise IndexError(place)
    return remove_reference(df, keys, F.col(index) == place, index)


def references(df: DataFrame, shown: DataFrame, keys: list[str], stand_in: Column, value: str, index: str = "ref_idx", place: int = 0) -> DataFrame:
    """``shown`` items with their reference at a place, or ``stand_in`` where it is missing, and whether it is."""
    own = df.where(F.col(index) == place).select(*keys, F.col(value))
    joined = shown.select(*keys).distinct().join(own, keys, "left")
    return joined.withColumn("missing", F.col(value).isNull()).withColumn(value, F.coalesce(value, stand_in))




def drop_variations(df: DataFrame, index: str = "ref_idx") -> DataFrame:
    """The original reference alone."""
    return df.where(F.col(index) == 0)


def clear_tags(df: DataFrame, tags: str = "reference_frame_tags") -> DataFrame:
    return df.withColumn(tags, F.when(F.col(tags).isNotNull(), F.slice(F.col(tags), 1, 0)))


def eligible(registry: DataFrame, frames: DataFrame, keys: list[str], skip_excluded: bool = True) -> DataFrame:
    """Rows that are not excluded and have a frame."""
    kept = registry.where(~F.coalesce(F.col("exclude_video"), F.lit(False))) if skip_excluded else registry
    return kept.join(frames.select(*keys), keys, "left_semi")


def found_range(df: DataFrame) -> DataFrame:
    """Rows whose start and end were found; missing ones count as -1."""
    return df.where((F.coalesce("start_frame_idx", F.lit(-1)) >= 0) & (F.coalesce("end_frame_idx", F.lit(-1)) >= 0))


def shown(df: DataFrame, frames: DataFrame, keys: list[str]) -> DataFrame:
    """Items with a range that have frames."""
    return found_range(df).join(frames.select(*keys), keys, "left_semi")


def unprocessed(df: DataFrame) -> DataFrame:
    return df.where(~F.coalesce(F.col("processed"), F.lit(False)))


def frame_counts(registry: DataFrame, frames: DataFrame, keys: list[str]) -> DataFrame:
    counts = frames.groupBy(*keys).agg(F.count("*").alias("n_frames"))
    return registry.join(counts, keys, "left").withColumn("n_frames", F.coalesce("n_frames", F.lit(0)))


def stages(registry: DataFrame, column: str = "video_processor") -> DataFrame:
    """One row for each stage of each item, in order."""
    return registry.select("*", F.posexplode(column).alias("stage_no", "stage")).drop(column)


def override_stage(registry: DataFrame, name: str, config: str, column: str = "video_processor") -> DataFrame:
    """One stage in place of each item's own list."""
    return registry.withColumn(column, F.array(F.struct(F.lit(name).alias("name"), F.lit(config).alias("config"))))


def lookup(registry: DataFrame, source: str, video_id: object, id_col: str = "video_id") -> DataFrame:
    """One item, or no row if it is unknown."""
    return registry.where((F.col("source") == source) & (F.col(id_col) == video_id))


def neighbours(df: DataFrame, keys: list[str], index: str = "ref_idx") -> DataFrame:
    """The places that a pager's back and forward buttons lead to; the ends stay where they are."""
    last = F.count("*").over(Window.partitionBy(*keys)) - 1
    return df.withColumns({"previous": F.greatest(F.lit(0), F.col(index) - 1), "next": F.least(last, F.col(index) + 1)})
