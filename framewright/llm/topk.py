"""Operator 8: exact top-k inner products by a three-phase uniform threshold.

A score is the sum of two partial scores: that over the half of the components with the most energy in
the table (the head), and that over the rest (the tail). Queries meet candidates block by block.

Phase 1 gathers local lists: of each candidate block the k best heads of every query, with their whole
scores, merged to k a query within a task. The k-th best (score, id) of all lists is a safe cutoff; a pair that ties
with its score and has a larger id is out. Phase 2 sends
the cutoff back to all blocks. There a block is passed over if the lengths of its longest vector and
the queries cannot reach it, and a pair goes on only if its head and the largest tail that the lengths
of both tails allow reach it. Phase 3 resolves the tails of the remaining pairs, and no others, exactly, and again
gives k a query and task at most, however many scores are equal.

Equal vectors are one entry that keeps its k + 1 smallest ids, as many as any query can report. Blocks
hold ``BLOCK`` entries and there are as many parts as blocks, up to the session's shuffle width; query
blocks are copied to every part, which all queries against all rows cannot do without, and no pair of
rows is ever a row of a join. Rows with a null id, a null vector, or a null or non-finite component take
no part; vectors of different length are never compared; a query's own id is no candidate; repeated (id,
vector) rows count once. Ties go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.llm.common import materialize, parts

QUERY_BLOCK = 1024
BLOCK = 4096
#: Query blocks whose lists a task merges at a time.
HELD = 64
#: Tails are resolved pair by pair while under one pair in this many remains, and column by column above.
SPARSE = 16
_PACKED = "part int, dim int, first array<bigint>, ids array<bigint>, matrix binary"


def quantize(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null unless all components are finite."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(as_double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(as_double, lambda x: F.floor(x * scale)))


def _pack(most: int, order: dict[int, list[int]]):
    """Rows (ids, v) as blocks of one dimension, components in ``order``; entry i of a block has ids[first[i] : first[i + 1]]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def block(dim: int, rows: list) -> pa.RecordBatch:
            first = np.cumsum([0, *(len(r[0]) for r in rows)])
            ids = [i for r in rows for i in r[0]]
            matrix = np.array([r[1] for r in rows], np.int64).reshape(len(rows), dim)[:, order.get(dim, range(dim))]
            values = [[part], [dim], [first], [ids], [matrix.tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["part", "dim", "first", "ids", "matrix"])

        held: dict[int, list] = {}
        for batch in batches:
            for ids, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = held.setdefault(len(v), [])
                rows.append((ids, v))
                if len(rows) == most:
                    yield block(len(v), held.pop(len(v)))
        for dim, rows in held.items():
            yield block(dim, rows)

    return run


def _matrix(raw: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw, np.int64).reshape(n, dim)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows: in doubles while these hold them, else in Python integers."""
    bound = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return exact.astype(np.int64) if a.shape[1] else np.zeros((len(a), len(b)), np.int64)


def _pairs(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Exact products of a[rows[i]] with b[cols[i]], a lot at a time."""
    safe = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1]) < 1 << 63
    out = np.zeros(len(rows), np.int64)
    for i in range(0, len(rows), 1 << 16):
        x, y = a[rows[i : i + (1 << 16)]], b[cols[i : i + (1 << 16)]]
        out[i : i + len(x)] = np.einsum("ij,ij->i", x, y) if safe else (x.astype(object) * y.astype(object)).sum(axis=1).astype(np.int64)
    return out


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, : (x.shape[1] + 1) // 2], x[:, (x.shape[1] + 1) // 2 :]


def _length(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths of rows, never too small."""
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-6


def _largest(values: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k largest values; of equals the first ones, so that ties agree on the smallest ids."""
    if k >= values.shape[1]:
        return np.tile(np.arange(values.shape[1]), (len(values), 1))
    cols = np.argpartition(~values, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(values, cols, axis=1).min(axis=1, keepdims=True)
    tied = np.flatnonzero((values >= least).sum(axis=1) > k)
    for row in tied.tolist():
        more = np.flatnonzero(values[row] > least[row])
        cols[row] = np.concatenate([more, np.flatnonzero(values[row] == least[row])[: k - len(more)]])
    return cols


def merged(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's k best (score, id), larger scores and then smaller ids first."""
    by = np.lexsort((ids, ~score), axis=1)[:, :k]
    return np.take_along_axis(score, by, axis=1), np.take_along_axis(ids, by, axis=1)


def best_heads(q: np.ndarray, c: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1: whole scores int64[queries, up to k] of each query's k best heads, and their columns; the lowest number where there are fewer."""
    (q_head, q_tail), (c_head, c_tail) = _halves(q), _halves(c)
    head = _product(q_head, c_head)
    lowest = np.iinfo(np.int64).min
    best = min(k, len(c))
    cols = _largest(np.where(ok, head, lowest // 2), best)
    rows = np.repeat(np.arange(len(q)), best)
    score = head[rows, cols.ravel()] + _pairs(q_tail, c_tail, rows, cols.ravel())
    return np.where(ok[rows, cols.ravel()], score, lowest).reshape(len(q), best), cols


def above(q: np.ndarray, c: np.ndarray, cutoff: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Phases 2 and 3: (rows, cols, scores) of all pairs that reach their query's cutoff, and how many tails were resolved."""
    none = np.zeros(0, np.int64)
    # What rounding may add to a score, generously.
    slack = 1.0 + 1e-9 * float(_length(q).max(initial=0)) * float(_length(c).max(initial=0))
    limit = cutoff.astype(np.float64) - slack
    open_rows = np.flatnonzero(_length(q) * _length(c).max(initial=0) >= limit)
    if not len(open_rows):
        return none, none, none, 0
    (q_head, q_tail), (c_head, c_tail) = _halves(q[open_rows]), _halves(c)
    head = _product(q_head, c_head)
    rows, cols = np.nonzero(head + _length(q_tail)[:, None] * _length(c_tail)[None, :] >= limit[open_rows, None])
    if SPARSE * len(rows) < head.size:
        score, resolved = head[rows, cols] + _pairs(q_tail, c_tail, rows, cols), len(rows)
    else:
        met = np.unique(cols)
        at = np.zeros(len(c), np.int64)
        at[met] = np.arange(len(met))
        tail = _product(q_tail, c_tail[met])
        score, resolved = head[rows, cols] + tail[rows, at[cols]], tail.size
    keep = score >= cutoff[open_rows[rows]]
    return open_rows[rows[keep]], cols[keep], score[keep], resolved


def _allowed(query_ids: np.ndarray, first: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """False where an entry holds nothing but the query's own id."""
    ok = np.ones((len(query_ids), len(first) - 1), bool)
    single = np.flatnonzero(np.diff(first) == 1)
    where = {int(ids[first[i]]): i for i in single.tolist()}
    for row, q in enumerate(query_ids.tolist()):
        if q in where:
            ok[row, where[q]] = False
    return ok


class _Held:
    """Lists of query blocks, merged to k a query, of ``HELD`` blocks at a time."""

    def __init__(self, k: int) -> None:
        self.k, self.lists = k, {}

    def put(self, key: int, qid: np.ndarray, score: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        if key in self.lists:
            _, old, old_ids = self.lists.pop(key)
            score, ids = np.concatenate([old, score], axis=1), np.concatenate([old_ids, ids], axis=1)
        elif len(self.lists) == HELD:
            yield self.out(next(iter(self.lists)))
        self.lists[key] = qid, *merged(score, ids, self.k)

    def out(self, key: int) -> pa.RecordBatch:
        qid, score, ids = self.lists.pop(key)
        rows, cols = np.nonzero(score > np.iinfo(np.int64).min)
        return pa.RecordBatch.from_arrays([pa.array(qid[rows]), pa.array(ids[rows, cols]), pa.array(score[rows, cols])], ["query_id", "vec_id", "score"])

    def rest(self) -> Iterator[pa.RecordBatch]:
        for key in list(self.lists):
            yield self.out(key)


def _local_lists(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(k)
        for batch in batches:
            for row in batch.to_pylist():
                qid = np.array(row["q_ids"], np.int64)
                first, ids = np.array(row["first"]), np.array(row["ids"], np.int64)
                q, c = _matrix(row["q_matrix"], len(qid), row["dim"]), _matrix(row["matrix"], len(first) - 1, row["dim"])
                score, cols = best_heads(q, c, _allowed(qid, first, ids), k)
                # An entry's smallest id but the query's own.
                own = ids[first[cols]]
                other = ids[np.minimum(first[cols] + 1, first[cols + 1] - 1)]
                yield from held.put(row["block"], qid, score, np.where(own == qid[:, None], other, own))
        yield from held.rest()

    return run


def _listed(rows: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs as lists of up to k a row, padded with the lowest number."""
    by = np.lexsort((ids, ~score, rows))
    rows, score, ids = rows[by], score[by], ids[by]
    begin = np.searchsorted(rows, np.arange(n))
    at = np.arange(len(rows)) - begin[rows]
    out, out_ids = np.full((n, k), np.iinfo(np.int64).min), np.zeros((n, k), np.int64)
    kept = at < k
    out[rows[kept], at[kept]], out_ids[rows[kept], at[kept]] = score[kept], ids[kept]
    return out, out_ids


def _above(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = np.iinfo(np.int64)
        held = _Held(k)
        for batch in batches:
            for row in batch.to_pylist():
                qid = np.array(row["q_ids"], np.int64)
                cutoff = np.array([limits.min if t is None else t["score"] for t in row["cutoffs"]], np.int64)
                last = np.array([limits.max if t is None else t["vec_id"] for t in row["cutoffs"]], np.int64)
                first, ids = np.array(row["first"]), np.array(row["ids"], np.int64)
                rows, cols, score, _ = above(_matrix(row["q_matrix"], len(qid), row["dim"]), _matrix(row["matrix"], len(first) - 1, row["dim"]), cutoff)
                # What only ties with the cutoff must not have a larger id; an entry's ids ascend.
                open_ = (score > cutoff[rows]) | (ids[first[cols]] <= last[rows])
                rows, cols, score = rows[open_], cols[open_], score[open_]
                count = np.diff(first)[cols]
                at = np.repeat(first[cols] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
                rows, score, found = np.repeat(rows, count), np.repeat(score, count), ids[at]
                other = qid[rows] != found
                yield from held.put(row["block"], qid, *_listed(rows[other], score[other], found[other], len(qid), k))
        yield from held.rest()

    return run


def by_energy(entries: DataFrame) -> dict[int, list[int]]:
    """For each vector length, its components by falling sum of squares: one row a component comes to the driver."""
    each = entries.select(F.size("v").alias("dim"), F.posexplode("v").alias("at", "x"))
    sums = each.groupBy("dim", "at").agg(F.sum(F.col("x").cast("double") * F.col("x")).alias("e")).collect()
    order: dict[int, list[int]] = {}
    for r in sorted(sums, key=lambda r: (r["dim"], -r["e"], r["at"])):
        order.setdefault(r["dim"], []).append(r["at"])
    return order


def search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best; both inputs have (vec_id, v array<bigint>)."""
    spark = vectors.sparkSession
    clean = vectors.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).select("vec_id", "v").dropDuplicates(["vec_id", "v"])
    # Spark keeps the k + 1 first rows of each group before the exchange, so a very common vector moves little.
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    entries = clean.withColumn("r", rank).where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = materialize(entries, "topk-entries")
    width = max(1, min(parts(spark), -(-entries.count() // BLOCK)))
    order = by_energy(entries)
    blocks = materialize(entries.select("ids", "v").repartition(width).sortWithinPartitions(F.get("ids", F.lit(0))).mapInArrow(_pack(BLOCK, order), _PACKED), "topk-blocks")
    asked = queries.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).select("vec_id", "v").dropDuplicates(["vec_id", "v"])
    asked = materialize(asked, "topk-queries")
    n_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    packed = asked.select(F.array("vec_id").alias("ids"), "v").repartition(n_blocks).mapInArrow(_pack(QUERY_BLOCK, order), _PACKED)
    packed = packed.select(F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"), F.xxhash64("ids", "matrix").alias("block"))
    packed = materialize(packed, "topk-query-blocks")

    def meet(query_blocks: DataFrame) -> DataFrame:
        everywhere = query_blocks.withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
        return everywhere.hint("shuffle_hash").join(blocks, (F.col("q_part") == F.col("part")) & (F.col("q_dim") == F.col("dim")))

    lists = meet(packed).select("block", "dim", "q_ids", "q_matrix", "first", "ids", "matrix").mapInArrow(_local_lists(k), "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = lists.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= k)
    cutoff = top.groupBy("query_id").agg(F.max(F.when(F.col("r") == k, F.struct("score", "vec_id"))).alias("cutoff"))
    # Cutoffs ride with their query block, in the order of its ids.
    keyed = packed.select("block", F.posexplode("q_ids").alias("i", "query_id"))
    carried = (
        keyed.join(cutoff, "query_id", "left")
        .groupBy("block")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "cutoff"))), lambda x: x["cutoff"]).alias("cutoffs"))
    )
    found = (
        meet(packed.join(carried, "block"))
        .select("block", "dim", "q_ids", "q_matrix", "cutoffs", "first", "ids", "matrix")
        .mapInArrow(_above(k), "query_id long, vec_id long, score long")
    )
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
