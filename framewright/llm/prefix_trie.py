"""Operator 12: the prefix trie of conversations, by padded matrices of turn ids in range shards.

A turn's id is a 128-bit hash of its role and text, made where the rows are read; texts are not shuffled.
Conversations become byte strings of 16 bytes a turn and are range-partitioned by (string, conv_id), so every
node's members are neighbours, and equal conversations may lie in several shards. A shard sorts blocks of
padded id columns with a lexsort; only rows that reach a block are in its matrix, so a few very long
conversations cost their own turns. Changes from row to row, or-accumulated along the columns, mark where
nodes start, and reduceat adds up each depth.

Nodes on the path of a shard's first or last row may go on in a neighbour. Shards give what they hold of
such seam nodes, with a hash of the prefix; parts of a node meet by that hash. Each seam node belongs to one
of the paths through it, and running sums from a path's end to the root give every seam node the totals of
its subtree. Work and rows follow the number of turns; a shard's memory follows ``SHARD_TURNS``.

Rows without a conv_id take no part. A null role or text is empty. Turns come by number, null first, equal
numbers by the turns' hashes; repeated rows are turns of their own. An empty table has no nodes, not even a
root. One conversation is one row of 24 bytes a turn. A node's members' list is hashed where its rows lie; lists
that several shards hold are hashed piece after piece, in order, as SHA-256 demands, without being gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.llm.common import buffers, materialize, parts

SHARD_TURNS = 500_000
COLUMNS = 16
CHUNK = 8192
_INNER, _OPEN, _SEAM, _ENDS = range(4)
_PIECE = (
    "kind int, shard int, side int, depth long, hash binary, parent binary, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, size long, ends binary"
)
_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
_FIELDS = [(c.split()[0], _TYPES[c.split()[1]]) for c in _PIECE.split(", ")]


def turn_id(role: str = "role", text: str = "text") -> Column:
    """128 bits of a turn's role and text."""
    clean = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    return F.unhex(F.md5(F.concat(F.length(clean[0]).cast("string"), F.lit(":"), *clean)))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) with turns (turn, id, size) in order."""
    size = F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long")
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), turn_id().alias("id"), size.alias("size")).alias("t"))
    # Conversations that share turns later are neighbours from here on.
    placed = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).repartition("base")
    return placed.groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, ids, sizes): the first h turns of conversation c - c % 5, then c's own behind its first h; h = crc32(c) % 9."""
    own = sequences(conversations)
    head = F.first(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, 8)), ignorenulls=True).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    both = own.select("conv_id", "turns", head.alias("head"), h.alias("h"))
    first = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    made = both.select("conv_id", F.concat(first, F.slice("turns", F.col("h") + 1, F.size("turns") + 1)).alias("turns"))
    return with_ids(made)


def with_ids(df: DataFrame) -> DataFrame:
    """(conv_id, ids, sizes) of (conv_id, turns)."""
    return df.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("ids"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


def _sums(values: np.ndarray, parent: np.ndarray, n: int) -> np.ndarray:
    """Values of neighbours under one parent, added up for each of ``n`` parents."""
    out = np.zeros(n, np.int64)
    if len(values):
        at = np.flatnonzero(np.diff(parent, prepend=-1))
        out[parent[at]] = np.add.reduceat(values, at)
    return out


def levels(conv: np.ndarray, ids: np.ndarray, lens: np.ndarray, sizes: np.ndarray, columns: int = COLUMNS) -> tuple[np.ndarray, list[dict]]:
    """The rows' order and, for each depth from 0, its nodes in that order: first and one-past-last place, conv_id, n_end, size.

    ``ids`` holds two non-zero words a turn, all conversations behind each other.
    """
    n = len(conv)
    begin = np.concatenate([[0], np.cumsum(lens)])[:-1]
    order = np.argsort(conv, kind="stable")
    found = [{"start": np.zeros(1, np.int64), "stop": np.array([n]), "conv": conv.min(keepdims=True), "n_end": np.array([(lens == 0).sum()]), "size": np.zeros(1, np.int64)}]
    slots, group, depth = np.arange(n), np.zeros(n, np.int64), 0
    while len(slots):
        rows = order[slots]
        reach = np.minimum(lens[rows] - depth, columns)
        there = np.arange(columns) < reach[:, None]
        matrix = np.zeros((len(rows), columns, 2), np.uint64)
        matrix[there] = ids[(begin[rows][:, None] + depth + np.arange(columns))[there]]
        keys = [conv[rows], lens[rows] > depth + columns] + [matrix[:, j, w] for j in range(columns - 1, -1, -1) for w in (1, 0)] + [group]
        by = np.lexsort(keys)
        rows, matrix, there = rows[by], matrix[by], there[by]
        order[slots] = rows
        changed = np.ones((len(rows), columns), bool)
        changed[1:] = (matrix[1:] != matrix[:-1]).any(axis=2)
        changed[1:, 0] |= group[1:] != group[:-1]
        marks = np.logical_or.accumulate(changed, axis=1)
        for j in range(columns):
            if not there[:, j].any():
                break
            at = np.flatnonzero(marks[:, j])
            keep = there[at, j]
            first, stop = slots[at], slots[np.append(at[1:], len(rows)) - 1] + 1
            found.append({
                "start": first[keep], "stop": stop[keep], "conv": np.minimum.reduceat(conv[rows], at)[keep],
                "n_end": np.add.reduceat((lens[rows] == depth + j + 1).astype(np.int64), at)[keep], "size": sizes[begin[rows[at[keep]]] + depth + j],
            })
        on = lens[rows] > depth + columns
        group, slots = np.cumsum(marks[:, -1])[on], slots[on]
        depth += columns
    return order, found


def _path(ids: np.ndarray) -> list[bytes]:
    """Hashes of all prefixes of one conversation."""
    running, out = hashlib.md5(), [hashlib.md5().digest()]
    for word in ids:
        running.update(word.tobytes())
        out.append(running.copy().digest())
    return out


def shard(conv: np.ndarray, ids: np.ndarray, lens: np.ndarray, sizes: np.ndarray, number: int = 0) -> Iterator[dict]:
    """The nodes of a shard, with seam nodes and pieces of their members' lists, as columns of ``_PIECE``."""
    order, found = levels(conv, ids, lens, sizes)
    n, sorted_conv = len(conv), conv[order]
    begin = np.concatenate([[0], np.cumsum(lens)])
    paths = [_path(ids[begin[r] : begin[r + 1]]) for r in (order[0], order[-1])]
    leaves = saved = parent = kids = None
    for depth in range(len(found) - 1, -1, -1):
        f, m = found[depth], len(found[depth]["start"])
        seam = (f["start"] == 0) | (f["stop"] == n)
        below = 0 if kids is None else _sums(kids, parent, m)
        under = (np.zeros(m, np.int64), np.zeros(m, np.int64)) if leaves is None else (_sums(leaves, parent, m), _sums(saved, parent, m))
        f["n_children"] = np.zeros(m, np.int64) + below
        count = f["stop"] - f["start"]
        f["n_leaves"] = under[0] + (~seam & (f["n_children"] == 0))
        f["saved"] = under[1] + np.where(seam, 0, (count - 1) * f["size"])
        if depth:
            parent = np.searchsorted(found[depth - 1]["start"], f["start"], "right") - 1
            f["up"] = parent
        leaves, saved, kids = np.where(seam, 0, f["n_leaves"]), np.where(seam, 0, f["saved"]), (~seam).astype(np.int64)
        f["seam"] = seam
    for depth, f in enumerate(found):
        seam = f["seam"]
        inner = np.flatnonzero(~seam)
        if len(inner):
            up, top = f["up"][inner], found[depth - 1]
            open_ = top["seam"][up]
            ends = [hashlib.sha256(",".join(map(str, sorted_conv[a : a + k].tolist())).encode()).digest() for a, k in zip(f["start"][inner].tolist(), f["n_end"][inner].tolist(), strict=True)]
            yield {
                "kind": np.where(open_, _OPEN, _INNER), "side": np.where(top["start"][up] == 0, 0, 1), "depth": depth, "conv_id": f["conv"][inner], "parent_conv_id": top["conv"][up],
                "n_convs": (f["stop"] - f["start"])[inner], "n_children": f["n_children"][inner], "n_leaves": f["n_leaves"][inner], "saved_tokens": f["saved"][inner], "ends": ends, "shard": number,
            }
        for i in np.flatnonzero(seam).tolist():
            side = 0 if f["start"][i] == 0 else 1
            own = {"kind": _SEAM, "shard": number, "depth": depth, "size": int(f["size"][i])}
            value = {"conv_id": int(f["conv"][i]), "n_convs": int(f["stop"][i] - f["start"][i])} | {k: int(f[c][i]) for k, c in (("n_children", "n_children"), ("n_leaves", "n_leaves"), ("saved_tokens", "saved"))}
            yield own | value | _names(paths[side], depth) | {"side": side}
            if side == 0 and f["stop"][i] == n:  # on both paths; its values are given once
                yield own | {"n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0, "side": 1} | _names(paths[1], depth)
            members = sorted_conv[f["start"][i] : f["start"][i] + f["n_end"][i]]
            for a in range(0, len(members), CHUNK):
                text = ",".join(map(str, members[a : a + CHUNK].tolist())).encode()
                yield {"kind": _ENDS, "shard": number, "conv_id": int(members[a]), "hash": paths[side][depth], "ends": text}


def _names(path: list[bytes], depth: int) -> dict:
    return {"hash": path[depth], "parent": path[depth - 1] if depth else None}


def _batch(piece: dict) -> pa.RecordBatch:
    n = max((len(v) for v in piece.values() if isinstance(v, (list, np.ndarray))), default=1)
    arrays = []
    for name, kind in _FIELDS:
        v = piece.get(name)
        arrays.append(pa.array(v, kind) if isinstance(v, (list, np.ndarray)) else pa.array([v] * n, kind))
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in _FIELDS])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, ids, lens, sizes = [], [], [], []
    for batch in batches:
        conv.append(batch.column(0).to_numpy())
        at, data = buffers(batch.column(1))
        lens.append(np.diff(at) // 16)
        ids.append(data.view(">u8").astype(np.uint64).reshape(-1, 2))
        sizes.append(batch.column(2).flatten().to_numpy())
    if not sum(map(len, conv)):
        return
    words = np.concatenate(ids)
    words[:, 1] |= np.uint64(1)  # never zero, which pads
    small: list[pa.RecordBatch] = []
    for piece in shard(np.concatenate(conv), words, np.concatenate(lens), np.concatenate(sizes), TaskContext.get().partitionId()):
        small.append(_batch(piece))
        if len(small) >= 1000 or small[-1].num_rows > 1000:
            yield from pa.Table.from_batches(small).combine_chunks().to_batches(max_chunksize=10_000)
            small = []
    if small:
        yield from pa.Table.from_batches(small).combine_chunks().to_batches(max_chunksize=10_000)


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, ends) from pieces in the order of (hash, first conv_id); one piece is held at a time."""
    last, running = None, hashlib.sha256()
    emit = lambda: pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([running.digest()], pa.binary())], ["hash", "ends"])
    for batch in batches:
        for name, text in zip(batch.column(0), batch.column(1), strict=True):
            own = name.as_py()
            if own != last:
                if last is not None:
                    yield emit()
                last, running = own, hashlib.sha256()
            else:
                running.update(b",")
            running.update(text.as_py())
    if last is not None:
        yield emit()


def trie(sequences: DataFrame, shards: int) -> DataFrame:
    """All nodes of (conv_id, ids, sizes): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    pieces = materialize(sequences.select("conv_id", "ids", "sizes").repartitionByRange(shards, "ids", "conv_id").mapInArrow(_shards, _PIECE), "trie-pieces")
    path = pieces.where(F.col("kind") == _SEAM)
    add = {c: F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    seams = path.groupBy("hash").agg(F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("size").alias("size"), F.min(F.struct("shard", "side")).alias("owner"), *add.values())
    seams = materialize(seams, "trie-seams")
    kids = seams.where("parent is not null").groupBy(F.col("parent").alias("hash")).agg(F.count("*").alias("seam_children"))
    up = seams.select(F.col("hash").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = seams.join(kids, "hash", "left").join(up, "parent", "left")
    children = F.col("n_children") + F.coalesce("seam_children", F.lit(0))
    whole = whole.select(
        "hash", "owner", "depth", "conv_id", "parent_conv_id", "n_convs", children.alias("n_children"),
        (F.col("n_leaves") + (children == 0).cast("long")).alias("leaves"), (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("saved"),
    )
    whole = materialize(whole, "trie-whole")
    along = path.select("shard", "side", "depth", "hash").join(whole.select("hash", "owner", "conv_id", "leaves", "saved"), "hash")
    along = materialize(along, "trie-paths")
    mine = (F.col("owner.shard") == F.col("shard")) & (F.col("owner.side") == F.col("side"))
    below = Window.partitionBy("shard", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    running = along.select("hash", *[F.sum(F.when(mine, F.col(c)).otherwise(0)).over(below).alias(c) for c in ("leaves", "saved")])
    totals = running.groupBy("hash").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    lists = pieces.where(F.col("kind") == _ENDS).select("hash", "ends", "conv_id").repartition("hash").sortWithinPartitions("hash", "conv_id")
    lists = lists.select("hash", "ends").mapInArrow(_hash_pieces, "hash binary, ends binary")

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    none = F.unhex(F.sha2(F.lit("").cast("binary"), 256))
    seam_nodes = whole.join(totals, "hash").join(lists, "hash", "left").select(*columns, F.coalesce("ends", none).alias("ends"))
    inner = pieces.where(F.col("kind") == _INNER).select(*columns, "ends")
    tops = along.select("shard", "side", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("top"))
    open_ = pieces.where(F.col("kind") == _OPEN).drop("parent_conv_id").join(tops, ["shard", "side", "depth"]).withColumnRenamed("top", "parent_conv_id")
    every = inner.unionByName(open_.select(*columns, "ends")).unionByName(seam_nodes)
    return every.select(*columns, F.lower(F.hex("ends")).alias("ends_sha256"))


def report(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    shards = max(parts(conversations.sparkSession), -(-conversations.count() // SHARD_TURNS))
    return trie(rebuilt(conversations), shards)
