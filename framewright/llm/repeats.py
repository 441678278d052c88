"""Operator 3: repeated byte strings removed by maximal repeat groups.

A string of ``LENGTH`` bytes has one anchor: the 50-byte gram with the smallest hash in it, the
leftmost of equals. Equal strings have equal anchors at equal offsets, so only the texts around
anchors that occur twice need comparing, about one gram in 76.

Stage 1 finds the repeated anchors. A slice of documents settles its own repeats and sends one entry
for each (anchor, surroundings) on, dealt by hash; an anchor that is common within the slice is dealt
by its surroundings too, so a very common passage is spread. Anchors whose whole surroundings (150
bytes before, 200 from its start on) occur twice are settled there: every string in them repeats.

Stage 2 gathers the remaining surroundings by anchor, one for each different one, and treats each
group as an enhanced suffix array: suffixes from the anchor on in order, their common prefixes, and a
stack scan over the tree of common-prefix intervals. Within an interval, members are ordered by what
stands before the anchor; where their left extensions differ, an interval of that order ends, and its
members share a maximal repeat. Strings of ``LENGTH`` bytes inside it are marked for all its members.
``repeat_groups`` gives the maximal repeats themselves with every member, ``report`` the bytes they cover.

A group of more than ``BOUND`` surroundings is split by its next bytes: the strings over an anchor start
0 to 150 bytes before it; those of the nearer half share the bytes right of the anchor that all of them
reach, those of the farther half the bytes left of it, so each half is grouped by its shared bytes, and
so on down to single strings. Members that agree in all that a half's strings cover are settled there,
and one of them goes on for the others, so that a common passage leaves only the half its edge lies in.
No group above the bound is ever gathered, and none is left out.

Texts are bytes of UTF-8; matches never cross documents. Equal texts are worked on once, removed wholly
if they have ``LENGTH`` bytes or more, and their digest is handed to all their rows. Null and empty texts
have no bytes; repeated rows and rows without ids are documents like others. An empty table gives no
rows. Extra columns are ignored. Hashes of 64 bits name anchors, surroundings and texts. Long texts are
looked at in pieces and their surroundings sent in lots, so beside a text a task holds an entry an anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import RollingHash, buffers, materialize, mix64, parts, release, slices, spread_join

LENGTH = 200
GRAM = 50
BOUND = 4096
SLICE = 1 << 20
#: Bytes of a text whose windows are looked at together, and places of a text whose surroundings are sent together.
PIECE, LOT = 1 << 21, 4096
#: Entries that a task gathers before it deals them out.
DEAL = 400_000
_POSITION = np.uint64((1 << 24) - 1)
_ENTRY = np.dtype([("key", "<u8"), ("hull", "<u8"), ("node", "<i8"), ("pos", "<i4"), ("before", "u1"), ("after", "u1"), ("flag", "u1")])
_MULTI, _KNOWN, _MARKER = 1, 2, 4
_rolling = RollingHash()


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    out, n = values, 1
    while 2 * n <= width:
        out = np.minimum(out[:-n], out[n:])
        n *= 2
    return out if n == width else np.minimum(out[: n - width], out[width - n :])


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM, piece: int = PIECE) -> tuple[np.ndarray, ...]:
    """(document, place, key, bytes before, bytes after, hash of the surroundings) of the anchors of documents end to end.

    Windows are looked at in pieces, each with the bytes that its anchors' surroundings reach, so what is held beside the bytes
    themselves is one entry an anchor.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none.astype(np.uint64), none, none, none.astype(np.uint64)
    # Positions ride in the low bits, so pieces stay under 2**24 grams; windows overlap between pieces.
    width, n = length - gram + 1, len(data) - length + 1
    start = np.concatenate([[0], ends[:-1]])
    found, places = [], []
    for a in range(0, n, piece):
        b = min(n, a + piece)
        low = max(0, a - length + gram)
        prefix = _rolling.prefix(data[low : b + 2 * length])
        key = _rolling.grams(prefix, gram)
        packed = (key[a - low : b - low + width - 1] & ~_POSITION) | np.arange(b + width - 1 - a, dtype=np.uint64)
        least = window_minimum(packed, width)
        doc_end = np.repeat(ends, np.diff(np.clip(np.concatenate([[0], ends]), a, b)))
        at = a + np.unique((least[np.arange(a, b) + length <= doc_end] & _POSITION).astype(np.int64))
        doc = np.searchsorted(ends, at, "right")
        before = np.minimum(at - start[doc], length - gram)
        after = np.minimum(ends[doc] - at, length)
        places.append(at)
        found.append((doc, at - start[doc], key[at - low], before, after, _rolling.spans(prefix, at - before - low, at + after - low)))
    once = np.unique(np.concatenate(places), return_index=True)[1]
    return tuple(np.concatenate(x)[once] for x in zip(*found, strict=True))


def merge_spans(node: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of a node made one."""
    if not len(node):
        return node, start, end
    order = np.lexsort((start, node))
    node, start, end = node[order], start[order].astype(np.int64), end[order].astype(np.int64)
    rank = np.cumsum(np.concatenate([[0], (node[1:] != node[:-1]).astype(np.int64)])) << 32
    reach = np.maximum.accumulate(rank + end)
    first = np.flatnonzero(np.concatenate([[True], (rank + start)[1:] > reach[:-1]]))
    return node[first], start[first], (np.append(reach[first[1:] - 1], reach[-1]) - rank[first])


_MARKS = "node long, start int, end int, key long"


def _marks(node, start, end, key=None) -> pa.RecordBatch:
    keys = pa.nulls(len(node), pa.int64()) if key is None else pa.array(key.view(np.int64), pa.int64())
    columns = [pa.array(node, pa.int64()), pa.array(start.astype(np.int32), pa.int32()), pa.array(end.astype(np.int32), pa.int32()), keys]
    return pa.RecordBatch.from_arrays(columns, ["node", "start", "end", "key"])


def _first_of(*columns: np.ndarray) -> np.ndarray:
    """Does a row differ from the one before?"""
    change = np.zeros(len(columns[0]), bool)
    if len(change):
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
    return change


def _settle(e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted entries without repeated places, and flags: (entries, surroundings repeat, key has several surroundings)."""
    e = e[np.lexsort((e["flag"] & _MARKER, e["pos"], e["node"], e["hull"], e["key"]))]
    place = _first_of(e["key"], e["hull"], e["node"], e["pos"])
    at = np.flatnonzero(place)
    flag = np.bitwise_or.reduceat(e["flag"] & ~np.uint8(_MARKER), at) if len(at) else np.zeros(0, np.uint8)
    marker = np.minimum.reduceat(e["flag"] & _MARKER, at) if len(at) else flag
    known = np.maximum.reduceat(e["flag"] & _MARKER, at) if len(at) else flag
    e = e[at].copy()
    e["flag"] = flag | marker
    new_key, new_hull = _first_of(e["key"]), _first_of(e["key"], e["hull"])
    key_id, hull_id = np.cumsum(new_key) - 1, np.cumsum(new_hull) - 1
    n_places = np.bincount(hull_id)
    multi = np.zeros(len(n_places), bool)
    np.logical_or.at(multi, hull_id, (e["flag"] & _MULTI) > 0)
    repeats = (n_places > 1) | multi
    several = np.bincount(key_id[new_hull]) > 1
    np.logical_or.at(several, key_id, ((e["flag"] & _KNOWN) > 0) | (known > 0))
    return e, repeats[hull_id], several[key_id]


def _find(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Stage 1, per slice: rows (bucket, entries, node, start, end)."""
    schema = ["bucket", "entries", "node", "start", "end"]
    turn = 0

    def row(bucket: int, entries: bytes | None, spans: tuple) -> pa.RecordBatch:
        lists = [pa.array([x.astype(k)], pa.list_(t)) for x, k, t in zip(spans, (np.int64, np.int32, np.int32), (pa.int64(), pa.int32(), pa.int32()), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([entries], pa.binary()), *lists], schema)

    nothing = (np.zeros(0, np.int64),) * 3

    def deal(sent: np.ndarray) -> Iterator[pa.RecordBatch]:
        by = np.where(sent["flag"] & _KNOWN, mix64(sent["key"] ^ sent["hull"]), sent["key"]) % np.uint64(width)
        order = np.argsort(by, kind="stable")
        sent, by = sent[order], by[order]
        cut = np.searchsorted(by, np.arange(width + 1, dtype=np.uint64))
        for i in range(width):
            if cut[i] < cut[i + 1]:
                yield row(i, sent[cut[i] : cut[i + 1]].tobytes(), nothing)

    waiting: list[np.ndarray] = []
    held = 0
    for batch in batches:
        nodes = batch.column(0).to_numpy(zero_copy_only=False)
        offsets, data = buffers(batch.column(1))
        for a, b in slices(offsets, SLICE):
            _, once = np.unique(nodes[a:b], return_index=True)
            once = np.sort(once) + a
            if len(once) == b - a:
                part = data[offsets[a] : offsets[b]]
            else:
                part = np.concatenate([data[offsets[i] : offsets[i + 1]] for i in once.tolist()])
            size = offsets[once + 1] - offsets[once]
            doc, pos, key, before, after, hull = anchors(part, np.cumsum(size))
            if not len(doc):
                continue
            e = np.zeros(len(doc), _ENTRY)
            e["key"], e["hull"], e["node"], e["pos"], e["before"], e["after"] = key, hull, nodes[once][doc], pos, before, after
            e, repeats, several = _settle(e)
            first = _first_of(e["key"], e["hull"])
            rest = e[~first]
            spans = _settled_spans(rest)
            sent, several = e[first], several[first]
            sent["flag"] = np.where(repeats[first], _MULTI, 0) | np.where(several, _KNOWN, 0)
            marker = sent[_first_of(sent["key"]) & several].copy()
            marker["flag"] = _MARKER
            waiting.append(np.concatenate([sent, marker]))
            held += len(waiting[-1])
            if held >= DEAL:
                yield from deal(np.concatenate(waiting))
                waiting, held = [], 0
            if len(spans[0]):
                yield row(turn % width, None, spans)
                turn += 1
    if waiting:
        yield from deal(np.concatenate(waiting))


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stage 1, per bucket: settled spans, and requests (key set, place in start) for surroundings to compare."""
    held: list[np.ndarray] = []
    for batch in batches:
        for entries, node, start, end in zip(*batch.columns[1:], strict=True):
            if entries.is_valid:
                held.append(np.frombuffer(entries.as_buffer(), _ENTRY))
            else:
                yield _marks(*(x.values.to_numpy() for x in (node, start, end)))
    if not held:
        return
    e, repeats, several = _settle(np.concatenate(held))
    real = (e["flag"] & _MARKER) == 0
    ready = e[real & repeats]
    yield _marks(*_settled_spans(ready))
    # One entry speaks for each surroundings; a marker stands for one that its own bucket sends.
    e, several = e[real], several[real]
    ask = e[_first_of(e["key"], e["hull"]) & several]
    yield _marks(ask["node"], ask["pos"], ask["pos"], ask["key"])


def _common(rows: list[bytes], order: list[int], width: int) -> np.ndarray:
    """Common prefix of each string with its predecessor in ``order``; the first entry is 0."""
    table = np.zeros((len(order), width + 1), np.uint8)
    size = np.array([len(rows[i]) for i in order])
    for at, i in enumerate(order):
        table[at, : size[at]] = np.frombuffer(rows[i], np.uint8)
    differ = table[1:] != table[:-1]
    differ[:, width] = True
    out = np.zeros(len(order), np.int64)
    out[1:] = np.minimum(np.argmax(differ, axis=1), np.minimum(size[1:], size[:-1]))
    return out


def prefix_intervals(lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of the tree of common-prefix intervals, children before parents, by one scan with a stack.

    ``lcp[i]`` is the common prefix of entries i - 1 and i of an ordered list.
    """
    stack: list[tuple[int, int]] = [(0, 0)]
    for i, depth in enumerate([*lcp[1:].tolist(), 0], 1):
        lo = i - 1
        while stack[-1][0] > depth:
            high, lo = stack.pop()
            yield high, lo, i - 1
        if depth > stack[-1][0]:
            stack.append((depth, lo))


class Surroundings:
    """An enhanced suffix array over the texts around one anchor.

    ``left`` holds the bytes before the anchor backwards, ``right`` those from the anchor on.
    """

    def __init__(self, left: list[bytes], right: list[bytes], length: int = LENGTH, gram: int = GRAM) -> None:
        n = len(left)
        self.n, self.length, self.gram = n, length, gram
        self.suffix = np.array(sorted(range(n), key=right.__getitem__))
        self.lcp = _common(right, self.suffix.tolist(), length)
        self.left_order = np.array(sorted(range(n), key=left.__getitem__))
        self.lcs = _common(left, self.left_order.tolist(), length - gram)
        rank = np.empty(n, np.int64)
        rank[self.left_order] = np.arange(n)
        self.rank_at = rank[self.suffix]
        self.place = np.empty(n, np.int64)
        self.place[self.suffix] = np.arange(n)

    def _by_left(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """An interval's members in the order of their left sides (as ranks), and what neighbours there share."""
        r = np.sort(self.rank_at[lo : hi + 1])
        if len(r) == 2:
            return r, np.array([self.lcs[r[0] + 1 : r[1] + 1].min()])
        return r, np.minimum.reduceat(self.lcs[: r[-1] + 1], r[:-1] + 1)

    def offsets(self) -> np.ndarray:
        """Which offsets o make the string that starts o bytes before the anchor a repeat: bool[n, length - gram + 1].

        A member's longest shared left side ends where the left extensions of its innermost interval begin to differ.
        """
        most = self.length - self.gram
        change = np.zeros((self.n, most + 2), np.int32)
        for depth, lo, hi in prefix_intervals(self.lcp):
            if depth < self.gram:
                continue
            least = max(0, self.length - depth)
            r, between = self._by_left(lo, hi)
            reach = np.zeros(len(r), np.int64)
            reach[:-1] = between
            reach[1:] = np.maximum(reach[1:], between)
            hit = np.flatnonzero(reach >= least)
            if len(hit):
                member = self.left_order[r[hit]]
                change[member, least] += 1
                change[member, reach[hit] + 1] -= 1
        return np.cumsum(change, axis=1)[:, : most + 1] > 0

    def groups(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(bytes before the anchor, bytes from it on, members) of every maximal repeat of ``length`` bytes or more.

        Of a common-prefix interval, the intervals of the left order are the sets whose left extensions differ
        at once behind what they share; one is maximal if its right extensions differ, too, and not only those of
        the whole interval.
        """
        for depth, lo, hi in prefix_intervals(self.lcp):
            if depth < self.gram:
                continue
            r, between = self._by_left(lo, hi)
            least = max(0, self.length - depth)
            found = [(0, 0, len(r) - 1)] if between.min() == 0 else []
            for before, a, b in [*prefix_intervals(np.concatenate([[0], between])), *found]:
                members = self.left_order[r[a : b + 1]]
                at = self.place[members]
                if before >= least and self.lcp[at.min() + 1 : at.max() + 1].min() == depth:
                    yield before, depth, members


def repeat_offsets(left: list[bytes], right: list[bytes], length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    return Surroundings(left, right, length, gram).offsets()


def _settled_spans(e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return merge_spans(e["node"], e["pos"].astype(np.int64) - e["before"], e["pos"].astype(np.int64) + e["after"])


_MEMBER = "key binary, n long, a int, b int, node long, pos int, left binary, right binary"


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, asks, b) to the members of groups: offsets from a to b of the strings over one anchor."""
    kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in _MEMBER.split(", ")]
    for batch in batches:
        for node, asks, text in zip(*batch.columns, strict=True):
            own, b = node.as_py(), memoryview(text.as_buffer())
            for i in range(0, len(asks.values), LOT):
                pos, key, n = (c.to_pylist() for c in asks.values.slice(i, LOT).flatten())
                sides = [[bytes(b[max(0, p - LENGTH + GRAM) : p])[::-1] for p in pos], [bytes(b[p : p + LENGTH]) for p in pos]]
                columns = [[k.to_bytes(8, "little", signed=True) for k in key], n, [0] * len(pos), [LENGTH - GRAM] * len(pos), [own] * len(pos), pos, *sides]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, int, int, list[tuple]]]:
    """(key, a, b, different members) of each group of two or more."""
    from framewright.llm.near_dedup import _groups

    for (key, a, b), rows in _groups(batches, 3):
        members = list({(node, pos): (node, pos, left, right) for node, pos, left, right in rows}.values())
        if len(members) > 1:
            yield key, a, b, members


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stage 2: groups to marked spans."""
    out: list[tuple[int, int, int]] = []
    for _, a, b, members in _members(batches):
        marked = repeat_offsets([m[2] for m in members], [m[3] for m in members])
        marked[:, :a] = False
        marked[:, b + 1 :] = False
        # A run of offsets is a span of starts.
        edge = np.diff(np.pad(marked, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        for i, o in zip(*np.nonzero(edge == 1), strict=True):
            stop = o + int(np.argmax(edge[i, o:] == -1))
            node, pos = members[i][:2]
            out.append((node, pos - stop + 1, pos - int(o) + LENGTH))
        if len(out) > 50_000:
            yield _marks(*merge_spans(*np.array(out, np.int64).T))
            out = []
    if out:
        yield _marks(*merge_spans(*np.array(out, np.int64).T))


_GROUPS = "key binary, member int, length int, node long, start int"


def _list_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups to one row for each member of each maximal repeat."""
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
    for key, a, b, members in _members(batches):
        rows = []
        for n, (before, after, own) in enumerate(Surroundings([m[2] for m in members], [m[3] for m in members]).groups()):
            # The part of a repeat that belongs to this range of offsets.
            reach, least = min(before, b), max(a, LENGTH - after)
            if reach >= least:
                rows += [(key, n, reach + after, members[i][0], members[i][1] - reach) for i in own.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [c.split()[0] for c in _GROUPS.split(", ")])


def _split(large: DataFrame) -> DataFrame:
    """The members of groups above the bound as members of two groups each, by the bytes that each half shares."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    halves = F.array(F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("b").alias("b")))
    rest = ["node", "pos", "left", "right"]
    part = large.select("key", F.explode(halves).alias("h"), *rest).select("key", F.col("h.a").alias("a"), F.col("h.b").alias("b"), *rest)
    # A member too near its text's edge has no string in the range.
    part = part.where((F.octet_length("left") >= F.col("a")) & (F.octet_length("right") >= LENGTH - F.col("b")))
    bytes_of = lambda before, after: F.unhex(F.md5(F.concat(F.col("left").substr(F.lit(1), before), F.col("right").substr(F.lit(1), after))))
    key = F.concat(F.substring("key", 1, 8), bytes_of(F.col("a"), LENGTH - F.col("b")), F.encode(F.concat_ws(":", "a", "b"), "utf-8"))
    # Sides end where a text does, so their lengths belong to what is covered.
    sides = F.encode(F.concat_ws(":", F.least(F.octet_length("left"), F.col("b")), F.least(F.octet_length("right"), LENGTH - F.col("a"))), "utf-8")
    return part.withColumn("key", key).withColumn("hull", F.concat("key", bytes_of(F.col("b"), LENGTH - F.col("a")), sides))


def repeat_members(docs: DataFrame, marks: DataFrame, bound: int) -> tuple[DataFrame, DataFrame]:
    """(members of groups of ``bound`` at most, members that agree in all the strings from a to b, by hull); ``docs`` has (node, b)."""
    asked = marks.where("key is not null").select("node", F.col("start").alias("pos"), "key").distinct()
    counts = materialize(asked.groupBy("key").agg(F.count("*").alias("n")), "repeat-counts")
    asked = spread_join(asked, counts, "key", asked.count()).where("n > 1")
    per_text = asked.groupBy("node").agg(F.collect_list(F.struct("pos", "key", "n")).alias("asks"))
    # Copies go before the exchange: each task sends a text once.
    texts = docs.select("node", "b").dropDuplicates(["node"])
    sent = materialize(texts.join(per_text, "node").select("node", "asks", "b").mapInArrow(_surroundings, _MEMBER), "repeat-members")
    small, alike = sent.where(F.col("n") <= bound), sent.where("false").withColumn("hull", F.col("key"))
    large = sent.where(F.col("n") > bound)
    while n := large.count():
        halves = materialize(_split(large), "repeat-halves")
        one = F.min(F.struct("node", "pos", "left", "right")).alias("m")
        hulls = materialize(halves.groupBy("hull", "key", "a", "b").agg(one, F.count("*").alias("same")), "repeat-hulls")
        settled = spread_join(halves, hulls.where("same > 1").select("hull"), "hull", 2 * n, "inner")
        alike = alike.unionByName(settled.withColumn("n", F.lit(0).cast("long")).select("hull", *sent.columns))
        sized = materialize(hulls.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "repeat-counts")
        found = spread_join(hulls.select("key", "a", "b", "m.*"), sized, "key", 2 * n, "inner").select(*sent.columns)
        found = materialize(found, "repeat-parts")
        small = small.unionByName(found.where(F.col("n") <= bound))
        large = found.where(F.col("n") > bound)
    return small, alike


def _together(small: DataFrame, width: int) -> DataFrame:
    rows = small.select("key", "a", "b", "node", "pos", "left", "right")
    return rows.repartition(width, "key").sortWithinPartitions("key")


def _found(docs: DataFrame) -> DataFrame:
    """Stage 1: settled spans, and requests for surroundings to compare."""
    spark = docs.sparkSession
    width = 2 * parts(spark)
    found = docs.select("node", "b").mapInArrow(
        lambda batches: _find(batches, width), "bucket int, entries binary, node array<bigint>, start array<int>, end array<int>"
    )
    marks = materialize(found.repartition(parts(spark), "bucket").mapInArrow(_decide, _MARKS), "repeat-marks")
    release(spark)
    return marks


def repeated_spans(docs: DataFrame, bound: int = BOUND) -> DataFrame:
    """(node, start, end): spans of repeated bytes of each different text; ``docs`` has (node, b binary)."""
    spark = docs.sparkSession
    marks = _found(docs)
    small, alike = repeat_members(docs, marks, bound)
    matched = materialize(_together(small, parts(spark)).mapInArrow(_compare, _MARKS), "repeat-matches")
    release(spark)
    # All strings that start b to a bytes before the anchor and are not cut off by the text's own ends.
    start = F.col("pos") - F.least(F.col("b"), F.octet_length("left"))
    end = F.col("pos") + F.least(LENGTH - F.col("a"), F.octet_length("right"))
    settled = alike.select("node", start.alias("start"), end.alias("end"))
    return marks.where("key is null").unionByName(matched).select("node", "start", "end").unionByName(settled)


def repeat_groups(df: DataFrame, text_col: str = "text", bound: int = BOUND) -> DataFrame:
    """(key, member, length, node, start): the maximal repeats that different surroundings of an anchor share, each with all
    its members; ``node`` is xxhash64 of the text. Of equal surroundings one stands for all. A repeat reaches up to 150
    bytes before its anchor and 200 from it on, so a longer one is listed at each of its anchors."""
    b = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    docs = df.select(F.xxhash64(b).alias("node"), b.alias("b"))
    small, alike = repeat_members(docs, _found(docs), bound)
    listed = _together(small, parts(df.sparkSession)).mapInArrow(_list_groups, _GROUPS)
    before, after = F.least(F.col("b"), F.octet_length("left")), F.least(LENGTH - F.col("a"), F.octet_length("right"))
    settled = alike.select("hull", F.lit(0).alias("member"), (before + after).cast("int").alias("length"), "node", (F.col("pos") - before).cast("int").alias("start"))
    return listed.unionByName(settled.withColumnRenamed("hull", "key"))


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = BOUND) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every whole text."""
    b = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(b).alias("node"), b.alias("b"))
    spans = repeated_spans(docs, bound)
    counted = docs.groupBy("node").agg(F.count("*").alias("n"), F.max(F.octet_length("b")).alias("end"))
    copies = counted.where(F.col("n") > 1).where(F.col("end") >= LENGTH)
    spans = spans.unionByName(copies.select("node", F.lit(0).alias("start"), F.col("end").cast("int").alias("end")))
    # Written out: the join below is then one of two tables with one row a text.
    per_text = materialize(spans.groupBy("node").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "repeat-spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, count, digest = [], [], []
            sizes = []
            for spans_, text in zip(batch.column(1), batch.column(2), strict=True):
                raw = memoryview(text.as_buffer())
                at, gone, n = 0, 0, 0
                sha = hashlib.sha256()
                if spans_.is_valid and len(spans_.values):
                    first, last = (c.to_numpy().astype(np.int64) for c in spans_.values.flatten())
                    _, start, end = merge_spans(np.zeros(len(first), np.int64), first, last)
                    for a, z in zip(start.tolist(), end.tolist(), strict=True):
                        sha.update(raw[at:a])
                        at, gone, n = z, gone + z - a, n + 1
                sha.update(raw[at:])
                sizes.append(len(raw))
                removed.append(gone)
                count.append(n)
                digest.append(sha.hexdigest())
            numbers = [pa.array(x, pa.int64()) for x in (sizes, removed, count)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.array(digest, pa.string())], ["node", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    texts = docs.select("node", "b").dropDuplicates(["node"])
    cuts = texts.join(per_text, "node", "left").select("node", "spans", "b").mapInArrow(cut, "node long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    cuts = materialize(cuts, "repeat-cuts")
    return spread_join(docs.select("doc_id", "node"), cuts, "node", docs.count()).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
