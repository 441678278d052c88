"""Operator 1: token-id blocks with Elias-Fano document boundaries.

Documents are ordered by id over the range partitions of a Spark sort. Each task concatenates the
ids of its documents into blocks: one binary id array (16 or 32 bits an id, little endian) and one
Elias-Fano record of the document ends, which takes about 2 + log2(ids a document) bits a document
instead of 64. Every 64th set bit of the upper part is sampled, so ``select(i)`` returns an offset
after reading at most a few bytes, and ``lot(j)`` the 64 offsets behind sample j from the bytes between
two samples. Reading goes by these alone: no table of a block's offsets is ever made. The blocks are rows of a Parquet table in the shared folder, so
any store that Spark writes will do and a lost executor loses nothing. Starts across tasks need
only one total per task. ``lookup`` fetches the ids of single documents.

Null and empty texts hold the end id alone. Documents with a null id come first; equal ids follow
the order of their texts. An empty table gives an empty store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from math import floor, log2

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.llm.bpe import encoder
from framewright.llm.common import materialize, parts

BLOCK_IDS = 1 << 20
_MAGIC = b"EFB1"
_SAMPLE = 64
_BLOCK = "part int, seq int, base long, n_ids long, width int, doc_ids array<bigint>, bounds binary, ids binary"


def pack_bounds(ends: np.ndarray) -> bytes:
    """Elias-Fano record of a non-decreasing array: header, lower bits, upper bits, select samples."""
    n = len(ends)
    top = int(ends[-1]) if n else 0
    low = max(0, floor(log2(top / n))) if n and top > n else 0
    values = ends.astype(np.uint64)
    lower = np.zeros(0, np.uint8)
    if low and n:
        lower = np.packbits(((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    upper = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    upper[ones] = 1
    bits = np.packbits(upper, bitorder="little")
    samples = ones[::_SAMPLE].astype("<u4")
    head = struct.pack("<4sIIIII", _MAGIC, n, low, len(lower), len(bits), len(samples))
    return head + lower.tobytes() + bits.tobytes() + samples.tobytes()


class Bounds:
    """Reads a record of ``pack_bounds``."""

    def __init__(self, record: bytes) -> None:
        magic, self.n, self.low, a, b, c = struct.unpack_from("<4sIIIII", record)
        if magic != _MAGIC:
            raise ValueError("not an Elias-Fano record")
        self._lower = np.frombuffer(record, np.uint8, a, 24)
        self._upper = np.frombuffer(record, np.uint8, b, 24 + a)
        self._samples = np.frombuffer(record, "<u4", c, 24 + a + b)

    def select(self, i: int) -> int:
        """The i-th value, found from the nearest sample before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self._samples[i // _SAMPLE])
        left = i % _SAMPLE
        byte, skip = divmod(at, 8)
        while True:
            bits = np.flatnonzero(np.unpackbits(self._upper[byte : byte + 16], bitorder="little")[skip:])
            if left < len(bits):
                one = byte * 8 + skip + int(bits[left])
                break
            left -= len(bits)
            byte, skip = byte + 16, 0
        value = (one - i) << self.low
        if self.low:
            first = i * self.low
            bits = np.unpackbits(self._lower[first // 8 : (first + self.low + 7) // 8], bitorder="little")
            value |= int(sum(int(x) << j for j, x in enumerate(bits[first % 8 : first % 8 + self.low])))
        return value

    def lot(self, j: int) -> np.ndarray:
        """The values from sample ``j`` up to the next one, 64 at most."""
        first = j * _SAMPLE
        if not 0 <= first < self.n:
            raise IndexError(first)
        n = min(_SAMPLE, self.n - first)
        at = int(self._samples[j])
        end = int(self._samples[j + 1]) if j + 1 < len(self._samples) else 8 * len(self._upper)
        ones = 8 * (at >> 3) + np.flatnonzero(np.unpackbits(self._upper[at >> 3 : (end + 7) >> 3], bitorder="little"))
        ones = ones[np.searchsorted(ones, at) :][:n]
        values = (ones - np.arange(first, first + n)) << self.low
        if self.low:
            a, b = first * self.low, (first + n) * self.low
            bits = np.unpackbits(self._lower[a >> 3 : (b + 7) >> 3], bitorder="little")[a & 7 :][: b - a].reshape(n, self.low)
            values |= (bits.astype(np.int64) << np.arange(self.low)).sum(axis=1)
        return values

    def lots(self) -> Iterator[np.ndarray]:
        yield from map(self.lot, range(len(self._samples)))


def write_store(df: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode every whole text, append ``end_id``, and store the blocks in ascending id order."""
    ordered = (
        df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .repartitionByRange(parts(df.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], enc.width)
        keys: list = []
        held: list[np.ndarray] = []
        size = base = seq = 0

        def block() -> pa.RecordBatch:
            ends = np.cumsum([len(x) + 1 for x in held])
            ids = np.concatenate([x for ids in held for x in (ids, end)])
            rows = [[part], [seq], [base], [len(ids)], [enc.width().itemsize], [keys], [pack_bounds(ends)], [ids.tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], ["part", "seq", "base", "n_ids", "width", "doc_ids", "bounds", "ids"]
            )

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = enc.encode(text.as_py())
                keys.append(key.as_py())
                held.append(ids)
                size += len(ids) + 1
                if size >= block_ids:
                    yield block()
                    base, seq, size = base + size, seq + 1, 0
                    keys, held = [], []
        if held:
            yield block()

    return materialize(ordered.mapInArrow(run, _BLOCK), "token-store")


def _placed(store: DataFrame) -> DataFrame:
    """The blocks of a store with the number of ids before each."""
    totals = store.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row a write task: as many as the writer had partitions, however large the table is.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_base"))
    return store.join(F.broadcast(starts), "part").select((F.col("part_base") + F.col("base")).alias("start"), "width", "doc_ids", "bounds", "ids")


def _ids(raw: pa.Scalar, width: int, a: int, b: int) -> np.ndarray:
    return np.frombuffer(raw.as_buffer(), np.uint16 if width == 2 else np.uint32, b - a, a * width).astype("<u4")


def read_store(store: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each stored document, from the stored bytes, 64 documents at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, width, keys, bounds, raw in zip(*batch.columns, strict=True):
                begins, sizes, sums, last = [], [], [], 0
                for ends in Bounds(bounds.as_py()).lots():
                    first = last
                    view = memoryview(_ids(raw, width.as_py(), first, int(ends[-1]))).cast("B")
                    for end in ends.tolist():
                        begins.append(last)
                        sizes.append(end - last)
                        sums.append(zlib.crc32(view[4 * (last - first) : 4 * (end - first)]))
                        last = end
                begins = np.array(begins, np.int64) + start.as_py()
                yield pa.RecordBatch.from_arrays(
                    [keys.values, pa.array(begins), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    return _placed(store).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(store: DataFrame, doc_ids: list[int]) -> DataFrame:
    """(doc_id, start, ids) of the documents named: two selects each, and no other ids are read from a block."""
    wanted = sorted(set(doc_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for start, width, keys, bounds, raw in zip(*batch.columns, strict=True):
                record = Bounds(bounds.as_py())
                for i in np.flatnonzero(np.isin(keys.values.to_numpy(zero_copy_only=False), wanted)).tolist():
                    a, b = record.select(i - 1) if i else 0, record.select(i)
                    rows.append((keys.values[i].as_py(), start.as_py() + a, _ids(raw, width.as_py(), a, b).tolist()))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["doc_id", "start", "ids"])

    return _placed(store).where(F.arrays_overlap("doc_ids", F.array(*map(F.lit, wanted)))).mapInArrow(run, "doc_id long, start long, ids array<bigint>")
