"""Operator 4: mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets: sources in code-point order, null last, weigh 5, 2, 1, repeating, and share 150 % of all
words; a target stops at twice its source's words and the excess is shared anew by weight.

Documents of a source are permuted by a keyed hash; runs of hash values are its blocks. A source's
block quota is what meets its target: whole passes over all its blocks, then the first blocks of the
permutation. What then is missing, less than a block, comes from the documents of the blocks that follow,
about ``BLOCK_DOCS`` of them: those that still fit are drawn, the largest first, and at last the smallest
that does not fit where this comes nearer. So a source misses its target by half of that document at
most. Documents are always drawn whole, and none more than twice.

The quotas go to output shards by a splitting tree: each node halves its shards and draws, from the
multivariate hypergeometric distribution, how many of the blocks of each source go left. Its leaves
are exact quotas [source, shard], and each shard draws the next run of a source's permuted blocks that
its quota names: the runs are disjoint, a block beyond all quotas is drawn by nobody, and what a source
gives is the sum over the shards. Within a shard, draws are ordered by another keyed hash.

Sources are rows of tables throughout: they are ranked by range partitions, their targets are found by
aggregates, and the tree works on lots of ``LOT`` sources in tasks, below a tree over the lots. One row
a lot comes to the driver. A source with a third of all rows is summed per block first. Documents are
joined with one decision row a source, which Spark broadcasts if it is small. A tree draws from up to
10^9 blocks of about ``BLOCK_DOCS`` documents.

Null and empty texts have size 0; a source without words has target 0. Rows that agree in id, source
and text share one fate. An empty table gives no rows. Reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.llm.common import materialize, parts, tidy

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = 20
BLOCK_DOCS = 256
#: A source has this many blocks at least, or as many as it has documents.
MIN_BLOCKS = 64
RUN_BLOCKS = 4096
SHARDS = 16
#: Sources that one task splits.
LOT = 4096
_BITS = 60


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def permutation_key(id_col: Column, source: Column, text: Column, seed: int) -> Column:
    """The first 60 bits of an md5 of seed, id, source and text."""
    none = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), none(id_col), none(source), none(text)))
    return F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("long")


def ranked_sources(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, words, docs, place, w): the sources in code-point order, null last, counted from 0 across range partitions."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    ranged = totals.withColumn("none", F.col("source").isNull()).repartitionByRange(parts(sized.sparkSession), "none", "source")
    ranged = materialize(ranged.withColumn("part", F.spark_partition_id()), "mix-sources")
    # One row a partition, however many sources there are.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("none", "source")) - 1
    placed = ranged.withColumn("inside", inside).join(starts, "part").withColumn("place", F.col("ahead") + F.col("inside"))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int") + 1).cast("double")
    return placed.select("source", "words", "docs", "place", w.alias("w"))


def water_fill(sources: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sources`` (words, w, ...) with ``target``: shares by weight of ``share`` times all words, none above ``cap`` times its own.

    Each round is one aggregate that finds who stands above the cap at the present level; the level only rises.
    """
    total = share * float(sources.agg(F.sum("words")).first()[0] or 0)
    left, over, capped = total, 0.0, -1
    above = F.lit(False)
    while True:
        r = sources.agg(F.sum(F.when(above, F.col("words"))), F.sum(F.when(~above, F.col("w"))), F.count_if(above)).first()
        if r[2] == capped:
            break
        left, over, capped = total - cap * float(r[0] or 0), float(r[1] or 0), r[2]
        if not over:
            return sources.withColumn("target", cap * F.col("words"))
        above = F.col("w") * F.lit(left) / F.lit(over) > cap * F.col("words")
    return sources.withColumn("target", F.when(above, cap * F.col("words")).otherwise(F.col("w") * F.lit(left) / F.lit(over)))


def split_quotas(blocks: np.ndarray, room: np.ndarray, seed: int | list[int]) -> np.ndarray:
    """Exact quotas [source, shard] of ``blocks`` blocks a source over shards that take ``room`` blocks each, by the splitting tree."""
    rng = np.random.Generator(np.random.PCG64(seed))
    out = np.zeros((len(blocks), len(room)), np.int64)
    todo = [(0, len(room), blocks.astype(np.int64))]
    while todo:
        a, b, held = todo.pop()
        if b - a == 1 or held.sum() == 0:
            out[:, a] = held
            continue
        mid = (a + b) // 2
        left = rng.multivariate_hypergeometric(held, int(room[a:mid].sum()), method="marginals")
        todo += [(a, mid, left), (mid, b, held - left)]
    return out


def deal(units: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source, dealt): how many of a source's blocks the shards up to each one take; ``units`` has (source, place, n)."""
    lots = units.withColumn("lot", F.floor(F.col("place") / LOT))
    totals = lots.groupBy("lot").agg(F.sum("n").alias("n")).orderBy("lot").collect()  # one row for LOT sources
    whole = np.array([r["n"] for r in totals], np.int64)
    edges = int(whole.sum()) * np.arange(shards + 1) // shards
    rooms = split_quotas(whole, np.diff(edges), seed)
    room = units.sparkSession.createDataFrame([(r["lot"], q.tolist()) for r, q in zip(totals, rooms, strict=True)], "lot long, room array<bigint>")

    def split(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        quotas = split_quotas(rows["n"].to_numpy(), np.array(rows["room"].iloc[0]), [seed, int(rows["lot"].iloc[0])])
        return pd.DataFrame({"source": rows["source"], "dealt": np.cumsum(quotas, axis=1).tolist()})

    return lots.join(room, "lot").groupBy("lot").applyInPandas(split, "source string, dealt array<bigint>")


def _block(key: Column, n_blocks: Column) -> Column:
    return F.shiftright(F.shiftright(key, _BITS - 31) * n_blocks, 31)


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def plan(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(sized documents, one decision row a source)."""
    key = permutation_key(F.col(id_col), F.col(source_col), F.col(text_col), seed)
    picked = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), key.alias("key"))
    sized = materialize(picked, "mix-sizes")
    with tidy(df.sparkSession):
        filled = water_fill(materialize(ranked_sources(sized), "mix-ranked"))
        n_blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.least("docs", F.lit(MIN_BLOCKS))).cast("long")
        passes = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("int")
        sources = filled.select("source", "place", "words", "docs", "target", n_blocks.alias("n_blocks"), passes.alias("passes"))
        sources = materialize(sources.withColumn("rest", F.col("target") - F.col("passes") * F.col("words")), "mix-targets")

        # Words before each block, by runs of blocks and then within a run: no window holds a whole source.
        # About BLOCK_DOCS documents lie in so many blocks.
        zone = F.ceil(F.lit(float(BLOCK_DOCS)) * F.col("n_blocks") / F.col("docs")).alias("zone")
        own = sources.select(F.col("source").alias("o"), "n_blocks", "rest", zone)
        placed = sized.join(own, _same(sized["source"], F.col("o"))).select("source", "size", "key", "rest", "zone", _block(F.col("key"), F.col("n_blocks")).alias("block"))
        per_block = placed.groupBy("source", "block", "rest").agg(F.sum("size").alias("w")).withColumn("run", F.floor(F.col("block") / RUN_BLOCKS))
        per_block = materialize(per_block, "mix-blocks")
        before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
        per_run = per_block.groupBy("source", "run").agg(F.sum("w").alias("w"))
        per_run = per_run.select(F.col("source").alias("s"), F.col("run").alias("r"), F.coalesce(F.sum("w").over(before("source", "run")), F.lit(0)).alias("ahead"))
        inside = per_block.withColumn("within", F.coalesce(F.sum("w").over(before("source", "run", "block")), F.lit(0)))
        offsets = inside.join(per_run, _same(F.col("source"), F.col("s")) & (F.col("run") == F.col("r"))).withColumn("ahead", F.col("ahead") + F.col("within"))
        edge = offsets.where((F.col("ahead") <= F.col("rest")) & (F.col("ahead") + F.col("w") > F.col("rest")))
        missing = F.floor(F.col("rest") - F.col("ahead") + 0.5).cast("long")
        edge = materialize(edge.select(F.col("source").alias("s"), F.col("block").alias("b"), missing.alias("missing")), "mix-edges")

        # Of the blocks from the edge on, the documents that still fit; equal rows are one entry, which bounds their number.
        beyond = (F.col("block") >= F.col("b")) & (F.col("block") < F.col("b") + F.col("zone"))
        at_edge = placed.where("size > 0").join(edge, _same(F.col("source"), F.col("s"))).where(beyond)
        entries = at_edge.groupBy("source", "missing", "key").agg(F.sum("size").alias("words"))
        listed = entries.groupBy("source", "missing").agg(F.array_sort(F.collect_list(F.struct((-F.col("words")).alias("less"), "key"))).alias("entries"))
        none = F.lit(None).cast("bigint")
        state = lambda left, keys, less, key: F.struct(left.alias("left"), keys.alias("keys"), less.alias("less"), key.alias("key"))
        took = lambda acc, x: state(acc["left"] + x["less"], F.concat(acc["keys"], F.array(x["key"])), acc["less"], acc["key"])
        passed = lambda acc, x: state(acc["left"], acc["keys"], x["less"], x["key"])
        step = lambda acc, x: F.when(acc["left"] >= -x["less"], took(acc, x)).otherwise(passed(acc, x))
        nearer = lambda acc: F.when(-acc["less"] < 2 * acc["left"], F.concat(acc["keys"], F.array(acc["key"]))).otherwise(acc["keys"])
        start = state(F.col("missing"), F.array().cast("array<bigint>"), none, none)
        chosen = listed.select(F.col("source").alias("c"), F.aggregate("entries", start, step, nearer).alias("keys"))
        both = sources.join(edge, _same(F.col("source"), F.col("s")), "left").join(chosen, _same(F.col("source"), F.col("c")), "left")
        # A source without words has no edge and no partial pass.
        edge_block, keys = F.coalesce("b", F.lit(0)), F.coalesce("keys", F.array().cast("array<bigint>"))
        last = F.array_max(F.transform(keys, lambda k: _block(k, F.col("n_blocks")))) + 1
        units = F.col("passes") * F.col("n_blocks") + F.coalesce(last, edge_block)
        full = materialize(both.select("source", "place", "words", "target", "n_blocks", "passes", edge_block.alias("edge_block"), keys.alias("edge_keys"), units.alias("n")), "mix-units")
        dealt = deal(full.select("source", "place", "n"), shards, seed).withColumnRenamed("source", "d")
        decided = full.join(dealt, _same(F.col("source"), F.col("d"))).select("source", "words", "target", "n_blocks", "passes", "edge_block", "edge_keys", "dealt")
        return sized, materialize(decided, "mix-decisions", keep=True)


def draws_column() -> Column:
    """array<struct<pass, block, shard>> of a document's draws, from its key and its source's decision row."""
    block = _block(F.col("key"), F.col("n_blocks"))
    # The partial pass takes the blocks before the edge, and from there on the documents chosen.
    partly = (block < F.col("edge_block")) | F.array_contains("edge_keys", F.col("key"))
    count = F.col("passes") + partly.cast("int")
    passes = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    place = lambda p: p * F.col("n_blocks") + block
    shard = lambda p: F.size(F.filter("dealt", lambda upto: upto <= place(p)))
    found = F.transform(passes, lambda p: F.struct(p.alias("pass"), block.alias("block"), shard(p).alias("shard")))
    # A place beyond the shards' quotas is drawn by none of them.
    return F.filter(found, lambda d: d["shard"] < F.size("dealt"))


def mix_report(df: DataFrame, **names) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document; taken is the sum over the shards' draws."""
    sized, decisions = plan(df, **names)
    own = decisions.withColumnRenamed("source", "own")
    joined = sized.join(own, _same(F.col("source"), F.col("own"))).withColumn("draws", draws_column())
    return joined.select("doc_id", "size", F.col("words").alias("source_size"), "target", (F.size("draws") * F.col("size")).cast("long").alias("taken"))


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row a draw: the columns of ``df``, then __shard and __order (the place within the shard)."""
    _, decisions = plan(df, id_col, source_col, text_col, shards, seed)
    narrow = decisions.withColumnRenamed("source", "__source").drop("words", "target")
    names = df.columns
    key = permutation_key(F.col(id_col), F.col(source_col), F.col(text_col), seed)
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), key.alias("key"), F.col(source_col).cast("string").alias("__own"))
    drawn = row.join(narrow, _same(F.col("__own"), F.col("__source"))).select("__row", "key", F.explode(draws_column()).alias("__draw"))
    return drawn.select(
        *[F.col("__row").getField(c).alias(c) for c in names],
        F.col("__draw.shard").alias("__shard"),
        F.xxhash64(F.lit(seed), F.col("key"), F.col("__draw.pass")).alias("__order"),
    )
