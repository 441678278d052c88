"""Operator 9: near-duplicates by BagMinHash signatures, banding and verified multiset overlap.

A text is the multiset of its runs of five words (lower case, split at white space; a shorter text
is one run). Its signature holds, for each of 150 positions, the earliest arrival of Poisson
processes that run over the elements' weights: weight 1, then [1, 2), [2, 4), ... each with a rate
equal to its length, arrivals above an element's count thinned out. Two signatures agree at a
position with a probability equal to the weighted Jaccard similarity.

Signatures are cut into 30 bands of 5; at similarity 0.8 a pair misses all bands with probability
7e-6. Texts that share a band are compared by signature within the band, those that agree to 0.67 or
more (four standard errors below 0.8) form loose groups, and in each group every such pair that is
not yet connected is verified by the exact overlap of its multisets: sum of minima over sum of
maxima at least 0.8. Classes are the connected components of verified links.

Equal texts are one node, named by 128 bits of their content. Bands and groups above ``BOUND`` nodes are
split into chunks, each together with the group's smallest node. What that node reaches in its chunk is
linked already; only the nodes that it does not reach meet the other chunks. So a large group of copies
of one text takes work in proportion to its size, no task holds an unbounded group, no link between
different texts is lost, and only spanning links are ever emitted. What has very many rows (a text's
copies, a class's members) is dealt over the tasks wherever it is joined.

Null, empty and blank texts have no runs and are classes of their own; blank is what ``str.split()``
makes nothing of. Repeated rows are copies. Rows without an id take part; a class's id is its smallest
id, null if it has none. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.llm.common import materialize, mix64, spread_join, tidy
from framewright.llm.graph import components

WORDS = 5
SIMILARITY = 0.8
ROWS = 5
BANDS = 30
SIZE = ROWS * BANDS
LOOSE = 0.67
BOUND = 512
_CACHE = 200_000
#: What str.split() splits at, and so what the words of Shingler never hold. None is beyond the first 65,536 characters.
_SPACES = "".join(c for c in map(chr, range(0x10000)) if c.isspace())
#: Rows that a task works on at a time.
_LOT = 512
_K1, _K2, _K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Shingler:
    """Multisets of word runs; remembers the hashes of words it has met, up to a bound."""

    def __init__(self, words: int = WORDS) -> None:
        self.words = words
        self.known: dict[str, bytes] = {}
        self.factor = np.array([pow(0x2545F4914F6CDD1D, i + 1, 1 << 64) for i in range(words)], np.uint64)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(sorted hashes, counts)."""
        chunks = text.lower().split()
        try:
            raw = b"".join(map(self.known.__getitem__, chunks))
        except KeyError:
            if len(self.known) > _CACHE:
                self.known.clear()
            for c in chunks:
                if c not in self.known:
                    self.known[c] = xxhash.xxh3_64_digest(c)
            raw = b"".join(map(self.known.__getitem__, chunks))
        w = np.frombuffer(raw, np.uint64)
        if not len(w):
            return w, np.zeros(0, np.int64)
        k = min(self.words, len(w))
        n = len(w) - k + 1
        total = np.full(n, k, np.uint64)
        for i in range(k):
            total += w[i : i + n] * self.factor[i]
        return np.unique(mix64(total), return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], size: int = SIZE) -> np.ndarray:
    """BagMinHash signatures (uint64[len(bags), size]) of non-empty multisets, taken side by side."""
    out = np.zeros((len(bags), size), np.uint64)
    if not bags:
        return out
    owner = np.repeat(np.arange(len(bags)), [len(h) for h, _ in bags])
    counts = np.concatenate([c for _, c in bags])
    weight = np.array([c.sum() for _, c in bags], float)
    seeds, rate, low, top, owners = [np.concatenate([h for h, _ in bags])], [np.ones(len(counts))], [np.zeros(len(counts))], [counts.astype(float)], [owner]
    elements = seeds[0]
    b, floor = 1, 1
    while (rows := np.flatnonzero(counts > floor)).size:
        seeds.append(mix64(elements[rows] + np.uint64(b) * _K3))
        rate.append(np.full(len(rows), float(floor)))
        low.append(np.full(len(rows), float(floor)))
        top.append(counts[rows].astype(float))
        owners.append(owner[rows])
        b, floor = b + 1, floor * 2
    process = tuple(np.concatenate(x) for x in (seeds, rate, low, top, owners))
    limit = size / weight * (np.log(size) + 3)
    todo = np.ones(len(bags), bool)
    while todo.any():
        own = todo[process[4]]
        earliest = np.full(len(bags) * size, np.inf)
        found = _arrivals(*(x[own] for x in process), limit, size)
        for cell, time, _ in found:
            np.minimum.at(earliest, cell, time)
        flat = out.reshape(-1)
        for cell, time, name in found:
            first = time == earliest[cell]
            flat[cell[first]] = name[first]
        todo &= np.isinf(earliest.reshape(len(bags), size)).any(axis=1)
        limit = limit * 2
    return out


def _arrivals(seed, rate, low, top, owner, limit, size) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(signature cell, time, 64 bits) of all arrivals up to each multiset's limit, by their number in the process."""
    out = []
    time, step = np.zeros(len(seed)), 1
    until = limit[owner]
    while len(seed):
        a = mix64(seed + np.uint64(step * int(_K1) & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log((a >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / rate
        on = np.flatnonzero(time <= until)
        seed, rate, low, top, owner, until, time = (x[on] for x in (seed, rate, low, top, owner, until, time))
        bits = mix64(a[on] ^ _K2)
        # The arrival's weight must lie under the element's count.
        valid = low + rate * ((bits & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32) < top
        cell = owner * size + ((bits >> np.uint64(32)) % np.uint64(size)).astype(np.int64)
        out.append((cell[valid], time[valid], bits[valid]))
        step += 1
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band."""
    rows = sig.reshape(BANDS, ROWS)
    total = np.arange(1, BANDS + 1, dtype=np.uint64) * _K3
    for i in range(ROWS):
        total = mix64(total + rows[:, i])
    return total.view(np.int64)


def node_of(text: Column) -> Column:
    """The name of a text: 128 bits of its content."""
    return F.unhex(F.md5(text))


def is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{_SPACES}]")


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, node, blank, text) to (doc_id, node, blank, sig, bands)."""
    shingle = Shingler()
    for batch in batches:
        for part in (batch.slice(i, _LOT) for i in range(0, batch.num_rows, _LOT)):
            blank = part.column(2).to_pylist()
            signed = iter(signatures([shingle(text.as_py()) for text, b in zip(part.column(3), blank, strict=True) if not b]))
            own = [None if b else next(signed) for b in blank]
            sigs = [None if s is None else s.astype(np.uint8).tobytes() for s in own]
            bands = [None if s is None else band_keys(s) for s in own]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "node", "blank", "sig", "bands"]
            )


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows that agree in their first ``n_keys`` columns."""
    key, rows = None, []
    lots = (batch.slice(i, _LOT) for batch in batches for i in range(0, batch.num_rows, _LOT))
    for lot in lots:
        for row in zip(*(c.to_pylist() for c in lot.columns), strict=True):
            if row[:n_keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:n_keys], []
            rows.append(row[n_keys:])
    if rows:
        yield key, rows


_LINKS = "u binary, v binary, key binary"


def _links(groups: Iterator[tuple[tuple, list[bytes], list[list[int]]]]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) of clusters (key, names, rows), and rows (u, null, key) for what the smallest name does not reach in a split group."""
    u, v, k = [], [], []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in (u, v, k)], ["u", "v", "key"])

    for (key, chunks, *_), names, clusters in groups:
        for cluster in clusters:
            low = min(cluster)
            u += [names[x] for x in cluster if x != low]
            v += [names[low]] * (len(cluster) - 1)
            k += [None] * (len(cluster) - 1)
            if chunks > 1 and low > 0:
                u += [names[x] for x in cluster]
                v += [None] * len(cluster)
                k += [key] * len(cluster)
        if len(u) > 50_000:
            yield batch()
            u, v, k = [], [], []
    yield batch()


def _spread(sigs: np.ndarray, test) -> list[list[int]]:
    """Clusters of rows: from each row on to all unreached ones that agree enough and pass ``test``."""
    left = np.arange(len(sigs))
    need = LOOSE * sigs.shape[1]
    out = []
    while len(left):
        cluster, todo = [int(left[0])], [int(left[0])]
        left = left[1:]
        while todo and len(left):
            seed = todo.pop()
            near = np.flatnonzero((sigs[left] == sigs[seed]).sum(axis=1) >= need)
            near = near[test(seed, left[near])] if len(near) and test is not None else near
            if len(near):
                found = left[near].tolist()
                cluster += found
                todo += found
                left = np.delete(left, near)
        out.append(cluster)
    return out


def _loose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups (key, chunks, i, j) of (node, sig) to links between signatures that agree enough."""

    def clusters() -> Iterator[tuple[tuple, list[bytes], list[list[int]]]]:
        for key, rows in _groups(batches, 4):
            nodes = dict(rows)
            names = sorted(nodes)
            sigs = np.frombuffer(b"".join(nodes[x] for x in names), np.uint8).reshape(len(names), SIZE)
            yield key, names, _spread(sigs, None)

    yield from _links(clusters())


def overlap(h: np.ndarray, c: np.ndarray, others_h: np.ndarray, others_c: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sums of minima between one multiset and ``n`` others given end to end."""
    at = np.minimum(np.searchsorted(h, others_h), len(h) - 1)
    return np.bincount(owner, np.where(h[at] == others_h, np.minimum(c[at], others_c), 0), minlength=n)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups (key, chunks, i, j) of (node, sig, h, c) to links between multisets that overlap enough."""

    def clusters() -> Iterator[tuple[tuple, list[bytes], list[list[int]]]]:
        for key, rows in _groups(batches, 4):
            nodes = {r[0]: r[1:] for r in rows}
            names = sorted(nodes)
            sigs = np.frombuffer(b"".join(nodes[x][0] for x in names), np.uint8).reshape(len(names), SIZE)
            h = [np.frombuffer(nodes[x][1], np.uint64) for x in names]
            c = [np.frombuffer(nodes[x][2], np.uint32).astype(np.int64) for x in names]
            total = np.array([x.sum() for x in c])

            def test(seed: int, others: np.ndarray, h=h, c=c, total=total) -> np.ndarray:
                pick = others.tolist()
                owner = np.repeat(np.arange(len(pick)), [len(h[x]) for x in pick])
                both = overlap(h[seed], c[seed], np.concatenate([h[x] for x in pick]), np.concatenate([c[x] for x in pick]), owner, len(pick))
                return both >= SIMILARITY * (total[seed] + total[others] - both) - 1e-9

            yield key, names, _spread(sigs, test)

    yield from _links(clusters())


def _chunk(node: str, n: Column) -> Column:
    return F.pmod(F.xxhash64(node), n).cast("int")


def _dealt(df: DataFrame, rest: list[str]) -> DataFrame:
    tasks = ["key", "chunks", "i", "j"]
    return df.select(*tasks, *rest).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")


def _linked(members: DataFrame, run, bound: int, label: str) -> DataFrame:
    """(u, v): spanning links within the groups of ``members`` (key, node, low, n, ...), ``low`` being a group's smallest node.

    First each chunk of a group with its smallest node, then the nodes which that did not reach with all chunks.
    """
    rest = [c for c in members.columns if c not in ("key", "low", "n")]
    sized = members.withColumn("chunks", F.ceil(F.col("n") / bound).cast("int"))
    everywhere = F.when(F.col("node") == F.col("low"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array(_chunk("node", F.col("chunks"))))
    first = _dealt(sized.withColumn("i", F.explode(everywhere)).withColumn("j", F.col("i")), rest).mapInArrow(run, _LINKS)
    first = materialize(first, f"{label}-first")
    left = first.where("v is null").select("key", F.col("u").alias("node")).distinct()
    counts = materialize(left.groupBy("key").agg(F.count("*").alias("n_left")), f"{label}-left")
    own = sized.join(counts, "key").withColumn("of", F.ceil(F.col("n_left") / bound).cast("int"))
    # A node that was not reached meets every chunk of its group; every node meets each lot of those.
    asks = own.join(left, ["key", "node"], "left_semi").withColumn("i", _chunk("node", F.col("of"))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    meets = own.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("of") - 1))).withColumn("j", _chunk("node", F.col("chunks")))
    second = _dealt(asks.unionByName(meets).withColumn("chunks", F.lit(1)), rest).mapInArrow(run, _LINKS)
    return first.where("v is not null").select("u", "v").unionByName(second.select("u", "v"))


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = BOUND) -> DataFrame:
    """(doc_id, node, blank, class_node) of every row; class_node is null for blank texts."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keyed = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), node_of(text).alias("node"), is_blank(text).alias("blank"), text.alias("text"))
    signed = materialize(keyed.mapInArrow(_signatures, "doc_id long, node binary, blank boolean, sig binary, bands array<bigint>"), "near-signatures")
    with tidy(df.sparkSession):
        # One row a text: copies go before anything is dealt by band or group.
        nodes = materialize(signed.where("not blank").groupBy("node").agg(F.first("sig").alias("sig"), F.first("bands").alias("bands")), "near-nodes")

        # Bands by their members: only those with two texts or more, and one band for each set of members.
        banded = nodes.select(F.explode("bands").alias("band"), "node")
        mark = F.xxhash64("node")
        members = banded.groupBy("band").agg(
            F.min("node").alias("low"),
            F.sum(F.shiftrightunsigned(mark, 32)).alias("s1"),
            F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))).alias("s2"),
            F.count("*").alias("n"),
        )
        chosen = members.where("n > 1").groupBy("low", "s1", "s2", "n").agg(F.min("band").alias("band")).select("band", "low", "n")
        crowd = materialize(banded.join(chosen, "band").select(F.col("band").cast("string").cast("binary").alias("key"), "node", "low", "n"), "near-bands")
        # A text meets its signature once, and then goes to its bands: at most BANDS of them.
        placed = crowd.groupBy("node").agg(F.collect_list(F.struct("key", "low", "n")).alias("at")).join(nodes.select("node", "sig"), "node")
        crowd = placed.select("node", "sig", F.inline("at")).select("key", "node", "low", "n", "sig")
        groups = materialize(components(_linked(crowd, _loose, bound, "near-loose")), "near-groups")

        sized = groups.groupBy("component").agg(F.count("*").alias("n"))
        member = groups.join(sized, "component").select(F.col("component").alias("key"), "node", F.col("component").alias("low"), "n").join(nodes.select("node", "sig"), "node")
        member = materialize(member, "near-members")

        def multisets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shingle = Shingler()
            for batch in (b.slice(i, _LOT) for b in batches for i in range(0, b.num_rows, _LOT)):
                bags = [shingle(text.as_py()) for text in batch.column(5)]
                own = [pa.array([h.tobytes() for h, _ in bags], pa.binary()), pa.array([c.astype(np.uint32).tobytes() for _, c in bags], pa.binary())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], *own], ["key", "node", "low", "n", "sig", "h", "c"])

        # Copies go before the exchange: each task sends a text once.
        texts = keyed.select("node", "text").dropDuplicates(["node"])
        with_text = member.join(texts, "node").select("key", "node", "low", "n", "sig", "text")
        bags = materialize(with_text.mapInArrow(multisets, "key binary, node binary, low binary, n long, sig binary, h binary, c binary"), "near-bags")
        label = components(_linked(bags, _verified, bound, "near-links")).withColumnRenamed("component", "class_node")
        label = materialize(label, "near-labels", keep=True)
    found = spread_join(signed.select("doc_id", "node", "blank"), label, "node", signed.count())
    return found.select("doc_id", "node", "blank", F.when(~F.col("blank"), F.coalesce("class_node", "node")).alias("class_node"))


def keepers(found: DataFrame) -> DataFrame:
    """(class_node, keep_id, keep_node, n): the row that stands for each class, by smallest id, then node."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("id"), F.col("node").alias("node"))).alias("k")
    best = found.where("not blank").groupBy("class_node").agg(first, F.count("*").alias("n"))
    return best.select("class_node", F.col("k.id").alias("keep_id"), F.col("k.node").alias("keep_node"), "n")


def report(df: DataFrame, **names: str) -> DataFrame:
    """(doc_id, class_id, class_size) of every row; class_id is the smallest doc_id of its class."""
    found = materialize(classes(df, **names), "near-classes")
    return spread_join(found, materialize(keepers(found), "near-keepers"), "class_node", found.count()).select(
        "doc_id",
        F.when(F.col("blank"), F.col("doc_id")).otherwise(F.col("keep_id")).alias("class_id"),
        F.coalesce("n", F.lit(1)).alias("class_size"),
    )


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stand for their class, a repeated row once; blank texts all stay."""
    keep = materialize(keepers(classes(df, id_col, text_col)), "near-keepers")
    own_id = lambda c: [c.isNull(), F.coalesce(c, F.lit(0).cast("long"))]
    keep = keep.select(F.col("keep_node").alias("__node"), *(c.alias(n) for c, n in zip(own_id(F.col("keep_id")), ("__no", "__id"), strict=True)))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    marks = zip((node_of(text), *own_id(F.col(f"`{id_col}`").cast("long")), is_blank(text)), ("__node", "__no", "__id", "__blank"), strict=True)
    own = df.select(*(F.col(f"`{c}`") for c in df.columns), *(c.alias(n) for c, n in marks))
    # Repeated rows go before the exchange, which the join then shares.
    once = Window.partitionBy("__node", "__no", "__id").orderBy("__node")
    single = own.where(~F.col("__blank")).withColumn("__r", F.row_number().over(once)).where("__r = 1").drop("__r")
    stays = single.join(keep, ["__node", "__no", "__id"], "left_semi").select(*own.columns)
    return stays.unionByName(own.where(F.col("__blank"))).drop("__node", "__no", "__id", "__blank")
