"""Tag scores, captions and prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.functions.text import appended, escape_parens, medium_key, tag_name


def mcut_threshold(df: DataFrame, keys: list[str], score: str = "p", tie: str = "name") -> DataFrame:
    """Midpoint of the largest drop between neighbours in falling order, the first of equals."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    ranked = df.select(*keys, F.col(score).alias("p"), F.lead(score).over(w).alias("q"), F.row_number().over(w).alias("r")).where(F.col("q").isNotNull())
    best = F.max_by(F.struct("p", "q"), F.struct((F.col("p") - F.col("q")).alias("d"), (-F.col("r")).alias("r")))
    return ranked.groupBy(*keys).agg(best.alias("c")).select(*keys, ((F.col("c.p") + F.col("c.q")) / 2).alias("threshold"))


def selected_tags(df: DataFrame, keys: list[str], general: float = 0.35, character: float = 0.85, mcut: bool = False, floor: float = 0.15) -> DataFrame:
    """General tags (category 0) and character tags (category 4) above their thresholds, most likely first, and the best rating (category 9).

    ``df`` has name, category and p. The general ones are also joined into one caption with parentheses
    escaped. With ``mcut`` each key's thresholds are the largest drops of either category, that of
    characters ``floor`` at least; without two tags there is no drop and no tag.
    """
    rated = df.where("category = 9").groupBy(*keys).agg(F.max_by("name", F.struct("p", "name")).alias("rating"))
    if mcut:
        drops = lambda c, into: mcut_threshold(df.where(F.col("category") == c), keys).select(*keys, F.col("threshold").alias(into))
        df = df.join(drops(0, "__g"), keys, "left").join(drops(4, "__c"), keys, "left")
        general, character = F.col("__g"), F.greatest(F.col("__c"), F.lit(floor))
    kept = df.where((F.col("category") == 0) & (F.col("p") > general) | (F.col("category") == 4) & (F.col("p") > character))
    entry = F.struct((-F.col("p")).alias("o"), F.col("name").alias("t"), tag_name(F.col("name")).alias("name"))
    names = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col("category") == c, entry))), lambda x: x["name"])
    grouped = kept.groupBy(*keys).agg(names(0).alias("general"), names(4).alias("characters"))
    return df.select(*keys).distinct().join(grouped, keys, "left").join(rated, keys, "left").select(
        *keys,
        "rating",
        escape_parens(F.array_join(F.coalesce("general", F.array().cast("array<string>")), ", ")).alias("caption"),
        F.coalesce("characters", F.array().cast("array<string>")).alias("characters"),
    )


def tagged_by(tags: Column, tagger: str) -> Column:
    """Has this tagger written a caption already?"""
    return F.exists(F.coalesce(tags, F.array().cast("array<struct<prompt:string,image_tagger:string,processor:string,tag:string>>")), lambda t: t["image_tagger"] == tagger)


def append_caption(df: DataFrame, tagger: str, caption: Column, tags: str = "reference_frame_tags") -> DataFrame:
    """A caption entry added where this tagger has none yet; ``caption`` is a struct like the list's entries."""
    return df.withColumn(tags, F.when(tagged_by(F.col(tags), tagger), F.col(tags)).otherwise(appended(F.col(tags), caption)))


def prompts_for(df: DataFrame, prompts: dict[str, list[str]], media: str = "art_media", style: str = "art_style") -> DataFrame:
    """One row for each prompt of the row's medium; rows of unknown media are dropped."""
    table = F.create_map(*[x for k, v in prompts.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return df.withColumn("prompt", F.explode(F.try_element_at(table, medium_key(F.col(media), F.col(style)))))


def uncovered(wanted: DataFrame, made: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted prompts that no variation covers yet."""
    return wanted.join(made.select(*keys, "prompt").distinct(), [*keys, "prompt"], "left_anti")


def best_aspect(df: DataFrame, sizes: list[tuple[int, int]], width: str = "width", height: str = "height") -> DataFrame:
    """The size whose ratio is nearest, the first of equals; null without sizes."""
    if not sizes:
        return df.withColumn("best_size", F.lit(None).cast("struct<width:int,height:int>"))
    ratio = F.col(width) / F.col(height)
    choice = [F.struct(F.abs(ratio - F.lit(w / h)).alias("d"), F.lit(i).alias("i"), F.lit(w).alias("width"), F.lit(h).alias("height")) for i, (w, h) in enumerate(sizes)]
    best = F.array_min(F.array(*choice))
    return df.withColumn("best_size", F.struct(best["width"].alias("width"), best["height"].alias("height")))


def tag_references(df: DataFrame, prompts: dict[str, list[str]], tagger: str, caption: Column, tags: str = "reference_frame_tags") -> DataFrame:
    """The tagging stage: rows that this tagger has not written for yet, once for each prompt of their medium, with its caption added.

    ``caption`` is a struct like the list's entries and may use ``prompt``.
    """
    return append_caption(prompts_for(df.where(~tagged_by(F.col(tags), tagger)), prompts), tagger, caption, tags)
