"""Train, eval and test splits and stratified folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def uniform(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on id and seed alone, in any engine with md5."""
    head = F.substring(F.md5(F.concat(id_col.cast("string"), F.lit(f":{seed}"))), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def assign_split(df: DataFrame, explicit: DataFrame | None, keys: list[str], id_col: str, train: float = 0.8, evaluate: float = 0.1, seed: int = 42, only_listed: bool = False) -> DataFrame:
    """Listed rows take their split; the others draw one, or are dropped with ``only_listed``.

    Draws are keyed by id, so neither row order nor the other ids change them.
    """
    if train + evaluate > 1:
        raise ValueError("train and eval must not exceed 1")
    u = uniform(F.col(id_col), seed)
    drawn = F.when(u <= train, "train").when(u <= train + evaluate, "eval").otherwise("test")
    if explicit is None:
        return df.withColumn("split", drawn)
    joined = df.join(explicit.select(*keys, "split"), keys, "inner" if only_listed else "left")
    return joined.withColumn("split", F.coalesce("split", drawn))


def folds(df: DataFrame, stratum: str, id_col: str, n: int = 5, seed: int = 42) -> DataFrame:
    """Each stratum shuffled by a keyed hash and dealt in turn: chunk 0 .. n - 1, starting anew for each stratum.

    A place in a stratum is the rank among the rows whose hashes begin alike and the number of rows whose
    hashes begin lower, so a stratum with most of the rows is sorted in 4,096 parts.
    """
    order = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    keyed = df.withColumn("__o", order).withColumn("__b", F.substring("__o", 1, 3))
    counts = keyed.groupBy(F.col(stratum).alias("__s"), F.col("__b").alias("__p")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__s").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.withColumn("__ahead", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy(stratum, "__b").orderBy("__o", id_col)) - 1
    placed = keyed.withColumn("__r", rank).join(ahead, F.col(stratum).eqNullSafe(F.col("__s")) & F.col("__b").eqNullSafe(F.col("__p")))
    return placed.withColumn("chunk", F.pmod(F.col("__ahead") + F.col("__r"), F.lit(n)).cast("int")).select(*df.columns, "chunk")


def fold_sets(df: DataFrame, n: int = 5) -> DataFrame:
    """Every row once a fold: test where its chunk is the fold, else train."""
    copies = df.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return copies.withColumn("part", F.when(F.col("chunk") == F.col("fold"), "test").otherwise("train"))


def export_split(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).partitionBy("split", "source").parquet(path)


def export_folds(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").partitionBy("fold", "part", "source").parquet(path)
