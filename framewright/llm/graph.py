"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import drop_table, in_scope, spread_join, write_table


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (u, v): the component is its smallest node.

    Each round halves the stars' depth and writes the edges to the shared folder; it ends when the
    edges no longer change. Neighbour lists are never gathered: a star is a minimum and a join, and the
edges of a node with very many of them are dealt over the tasks.
    """
    spark, names = edges.sparkSession, ["u", "v"]
    path = write_table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    kind = edges.schema["u"].dataType.simpleString()
    before = None
    while True:
        now = spark.read.schema(f"u {kind}, v {kind}").parquet(path)
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64(*names))).first())
        if state == before or not state[0]:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = spread_join(both.where("v > u"), low, "u", state[0], "inner").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_low.select("u", F.col("m").alias("v")))
        last, path = path, write_table(small.where("u <> v").distinct(), "edges")
        drop_table(spark, last)
    in_scope(path)
    own = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
