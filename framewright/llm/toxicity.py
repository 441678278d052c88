"""Operator 5: toxicity by the nearest labelled examples under exact TF-IDF cosine.

Learning uses a bounded sample of labelled rows: by default the 2,000 toxic and 4,000 clean examples
with the smallest hashes (``max_toxic``, ``max_clean``). Each doc_id counts once however often its row
is repeated, and equal texts with the same label are one example that stands for all of them. Terms
are words and their first four to eight letters, so that inflected forms meet, each in tiers of how
often a text has it; every term in three examples or more is kept whose association with a label passes
a G-test in the sample. The sample bounds their number. Other terms are not in the vectors: the cosine
is exact over the kept terms. Document frequencies for the weights come from all documents.

The examples stand in an inverted index whose postings are cut into blocks of 64 examples. Each
block keeps its largest weight per term, which bounds the cosine of every example in it: blocks are
visited by falling bound until the bound is under the k-th best cosine, so the neighbours are exact.
Votes weigh by cosine and by how many labelled rows an example stands for; a base rate damps them. A
monotone calibration, fitted on the examples left out one at a time, turns votes into scores.

Null and empty texts, and texts without kept terms, get the calibrated base rate of such examples.
Without any usable label every score is 0. A doc_id labelled twice is toxic if any label says so;
null labels are ignored. Labels, language, source and id are never inputs of a score; rows are scored
independently, so repeated rows agree. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
from pyspark.sql.window import Window

from framewright.llm.common import materialize, tidy

MAX_TOXIC = 2000
MAX_CLEAN = 4000
MIN_EXAMPLES = 3
#: The G that a term must reach, whatever the size of the sample; all terms that reach it are kept.
MIN_G = 12.0
#: A stem counts once for each of these numbers of occurrences that it reaches.
TIERS = (1, 2, 3, 5)
NEIGHBOURS = 15
DAMPING = 0.3
BLOCK = 64
FOLDS = 5
_WORD = re.compile(r"[^\W_]+")
_CACHE = 150_000


def held_out(id_col: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def chunk_stems(chunk: str) -> list[str]:
    """Stems of a text without white space: its words and their first four to eight letters."""
    out = []
    for word in _WORD.findall(chunk.lower()):
        out += [word[:n] for n in range(4, min(8, len(word)) + 1)]
        if not 4 <= len(word) <= 8:
            out.append(word)
    return out


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stem, tier, toxic, clean): in how many of the batches' examples a stem stands ``tier`` times or more."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts = Counter(stem for chunk in (text.as_py() or "").split() for stem in chunk_stems(chunk))
            seen[0 if toxic else 1].update((stem, tier) for stem, n in counts.items() for tier in TIERS if n >= tier)
    terms = list(seen[0].keys() | seen[1].keys())
    counts = [pa.array([c[t] for t in terms], pa.int64()) for c in seen]
    names = [pa.array([t[0] for t in terms], pa.string()), pa.array([t[1] for t in terms], pa.int32())]
    yield pa.RecordBatch.from_arrays([*names, *counts], ["stem", "tier", "toxic", "clean"])


class Features:
    """Terms of a text over a vocabulary of (stem, tier)."""

    def __init__(self, vocabulary: list[tuple[str, int]]) -> None:
        self.stems = {stem: i for i, stem in enumerate(dict.fromkeys(stem for stem, _ in vocabulary))}
        self.table = np.full((len(self.stems), len(TIERS)), -1, np.int32)
        for i, (stem, tier) in enumerate(vocabulary):
            self.table[self.stems[stem], TIERS.index(tier)] = i
        self.known: dict[str, bytes] = {}

    def _codes(self, chunk: str) -> bytes:
        raw = np.array([i for i in map(self.stems.get, chunk_stems(chunk)) if i is not None], np.int32).tobytes()
        if len(chunk) <= 64:
            self.known[chunk] = raw
        return raw

    def __call__(self, text: str) -> np.ndarray:
        if len(self.known) > _CACHE:
            self.known.clear()
        known, codes = self.known, self._codes
        found = b"".join([known[c] if c in known else codes(c) for c in text.split()])
        stem, n = np.unique(np.frombuffer(found, np.int32), return_counts=True)
        met = self.table[stem]
        return np.sort(met[(n[:, None] >= np.array(TIERS)) & (met >= 0)])


def select_terms(rows: list[tuple[str, int, int, int]], most: int) -> list[tuple[str, int]]:
    """The first ``most`` of (stem, tier, toxic, clean) rows; of stems that only differ in length and stand in
    the same numbers of examples, the longest stays."""
    held = {(stem[:-1], tier, p, n) for stem, tier, p, n in rows}
    return sorted([(stem, tier) for stem, tier, p, n in rows if (stem, tier, p, n) not in held][:most])


def _ranges(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of its range, member) of all members of the ranges [first, end), one range after the other."""
    size = end - first
    own = np.repeat(np.arange(len(size)), size)
    return own, np.arange(len(own)) + (first - np.cumsum(size) + size)[own]


class BlockMaxIndex:
    """Exact nearest examples by cosine, block by block."""

    def __init__(self, examples: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, idf: np.ndarray) -> None:
        self.idf = idf
        vectors = [self.weigh(t) for t in examples]
        # Examples with the same heaviest term stand together, which keeps the blocks' bounds tight.
        lead = [(int(t[np.argmax(w)]), -float(w.max())) if len(t) else (-1, 0.0) for t, w in vectors]
        order = sorted((i for i in range(len(vectors)) if len(vectors[i][0])), key=lambda i: (lead[i], i))
        self.origin = np.array(order, np.int64)
        self.vectors = [vectors[i] for i in order]
        self.toxic, self.weight = toxic[self.origin], weight[self.origin]
        blank = np.array([i for i in range(len(vectors)) if not len(vectors[i][0])], np.int64)
        total = float(weight.sum())
        self.base = float((weight * toxic).sum()) / total if total else 0.0
        heavy = float(weight[blank].sum())
        self.blank_seen = float((weight[blank] * toxic[blank]).sum()), heavy
        self.blank = (float((weight[blank] * toxic[blank]).sum()) + self.base) / (heavy + 1.0)
        self.n_blocks = -(-len(self.vectors) // BLOCK)
        # Postings by term, then example; a cell is the part of a term's postings that lies in one block.
        term = np.concatenate([t for t, _ in self.vectors] or [np.zeros(0, np.int64)])
        value = np.concatenate([w for _, w in self.vectors] or [np.zeros(0)])
        at = np.repeat(np.arange(len(self.vectors)), [len(t) for t, _ in self.vectors])
        by = np.lexsort((at, term))
        self.post_at, self.post_value = at[by].astype(np.int32), value[by]
        self.post_slot = self.post_at % BLOCK
        key = term[by] * max(1, self.n_blocks) + self.post_at // BLOCK
        start = np.flatnonzero(np.diff(key, prepend=-1))
        self.cell_first = np.append(start, len(key))
        self.cell_block = (key[start] % max(1, self.n_blocks)).astype(np.int32)
        self.cell_max = np.maximum.reduceat(self.post_value, start) if len(key) else np.zeros(0)
        self.term_first = np.searchsorted(key[start], np.arange(len(idf) + 1) * max(1, self.n_blocks))
        self.steps: tuple[np.ndarray, np.ndarray] | None = None
        self.vocabulary: list[tuple[str, int]] = []

    def weigh(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value = self.idf[terms]
        norm = float(np.sqrt((value * value).sum()))
        return terms.astype(np.int64), value / norm if norm else value

    def nearest(self, terms: np.ndarray, value: np.ndarray, skip: int = -1, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """(places, cosines) of the k nearest examples that share a term, the nearest first, ties to the earlier."""
        if not self.n_blocks:
            return np.zeros(0, np.int64), np.zeros(0)
        own, cells = _ranges(self.term_first[terms], self.term_first[terms + 1])
        blocks, own = self.cell_block[cells], value[own]
        bound = np.bincount(blocks, own * self.cell_max[cells], minlength=self.n_blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[: np.count_nonzero(bound > 0)]
        places, cosines = np.zeros(0, np.int64), np.zeros(0)
        done, step = 0, 2
        while done < len(order):
            if len(cosines) == k and bound[order[done]] < cosines[-1] - 1e-12:
                break
            picked = order[done : done + step]
            done += step
            step *= 4
            at = (picked[:, None] * BLOCK + np.arange(BLOCK)[None, :]).ravel()
            slot = np.full(self.n_blocks, -1)
            slot[picked] = np.arange(len(picked))
            met = np.flatnonzero(slot[blocks] >= 0)
            first = self.cell_first[cells[met]]
            size = self.cell_first[cells[met] + 1] - first
            # What holds for a cell is repeated for its postings, instead of being looked up for each.
            posts = np.repeat(first - np.cumsum(size) + size, size)
            posts += np.arange(len(posts))
            place = np.repeat(slot[blocks[met]] * BLOCK, size) + self.post_slot[posts]
            score = np.bincount(place, np.repeat(own[met], size) * self.post_value[posts], minlength=len(at))
            keep = np.flatnonzero((score > 0) & (at != skip))
            places, cosines = np.concatenate([places, at[keep]]), np.concatenate([cosines, score[keep]])
            best = np.lexsort((places, -cosines))[:k]
            places, cosines = places[best], cosines[best]
        return places, cosines

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        if not len(places):
            return self.blank
        w = cosines * cosines * self.weight[places]
        damp = DAMPING * float(self.weight[places].mean())
        return float((w * self.toxic[places]).sum() + damp * self.base) / (float(w.sum()) + damp)

    def calibrate(self) -> None:
        """Pool adjacent violators over the examples' votes, each without itself."""
        cases = [(self.vote(*self.nearest(t, v, skip=i)), self.weight[i] * self.toxic[i], self.weight[i]) for i, (t, v) in enumerate(self.vectors)]
        if self.blank_seen[1]:
            cases.append((self.blank, *self.blank_seen))
        if not cases:
            return
        pools: list[list[float]] = []
        for case in sorted(cases):
            pools.append([float(x) for x in case])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                _, y, w = pools.pop()
                pools[-1][1] += y
                pools[-1][2] += w
        self.steps = np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools])

    def score(self, vote: float) -> float:
        """Between the calibration's steps in a straight line; the raw vote breaks ties within a step."""
        if self.steps is None:
            return vote
        calibrated = float(np.interp(vote, *self.steps))
        return min(1.0, max(0.0, 0.9 * calibrated + 0.1 * vote))


def sample_labels(labels: DataFrame, documents: DataFrame, usable: Column, max_toxic: int, max_clean: int) -> DataFrame:
    """(doc_id, toxic, stands_for): the bounded sample, by keyed hash within each label."""
    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    own = own.where("toxic in (0, 1)").join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = own.groupBy("toxic").agg(F.count("*").alias("n"))
    limit = F.when(F.col("toxic") == 1, max_toxic).otherwise(max_clean)
    # The smallest hashes of each label; both lists are bounded, and each task keeps its own best first.
    order = (F.xxhash64("doc_id"), "doc_id")
    taken = own.where("toxic = 1").orderBy(*order).limit(max_toxic).unionByName(own.where("toxic = 0").orderBy(*order).limit(max_clean))
    return taken.join(F.broadcast(counts), "toxic").select("doc_id", "toxic", (F.col("n") / F.least(F.col("n"), limit)).alias("stands_for"))


def examples_of(documents: DataFrame, drawn: DataFrame, text_col: str = "text", max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> DataFrame:
    """(doc_id, toxic, stands_for, text): one row for each different text and label of the bounded sample ``drawn``.

    Repeated rows of a doc_id are one row before anything is counted; texts are told apart by a 128-bit hash. A doc_id may have
    very many texts, so texts are bounded once more, by their hashes; those that are drawn stand for all.
    """
    # Broadcast: the sample is bounded by the two parameters.
    labelled = documents.select("doc_id", F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
    once = labelled.withColumn("node", F.md5("text")).groupBy("doc_id", "node", "toxic", "stands_for").agg(F.first("text").alias("text"))
    # A doc_id whose rows differ in text spreads what it stands for over them.
    texts = F.count("*").over(Window.partitionBy("doc_id"))
    once = once.withColumn("stands_for", F.col("stands_for") / texts)
    once = once.groupBy("node", "toxic").agg(F.min("doc_id").alias("doc_id"), F.sum("stands_for").alias("stands_for"), F.first("text").alias("text"))
    counts = once.groupBy("toxic").agg(F.count("*").alias("n"))
    limit = {1: max_toxic, 0: max_clean}
    taken = reduce(DataFrame.unionByName, (once.where(F.col("toxic") == t).orderBy("node", "doc_id").limit(n) for t, n in limit.items()))
    share = F.col("n") / F.least("n", F.when(F.col("toxic") == 1, max_toxic).otherwise(max_clean))
    return taken.join(F.broadcast(counts), "toxic").select("doc_id", "toxic", (F.col("stands_for") * share).alias("stands_for"), "text")


def with_terms(documents: DataFrame, text_col: str, vocabulary: list[tuple[str, int]]) -> DataFrame:
    """``documents`` and the kept terms of each text in a last column, named unlike all others."""
    at = documents.columns.index(text_col)
    name = "__terms" + "_" * max((len(c) for c in documents.columns if c.startswith("__terms")), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of = Features(vocabulary)
        for batch in batches:
            terms = pa.array([terms_of(text.as_py() or "") for text in batch.column(at)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, terms], [*batch.schema.names, name])

    return documents.mapInArrow(run, StructType([*documents.schema.fields, StructField(name, ArrayType(IntegerType()))]))


def learn_terms(examples: DataFrame) -> list[tuple[str, int]]:
    """The vocabulary: every (stem, tier) in enough examples whose G against the labels is high enough."""
    counted = examples.select("toxic", "text").mapInArrow(_term_counts, "stem string, tier int, toxic long, clean long")
    per_term = counted.groupBy("stem", "tier").agg(F.sum("toxic").alias("p"), F.sum("clean").alias("n")).where(F.col("p") + F.col("n") >= MIN_EXAMPLES)
    size = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_clean:
        return []
    p, n, a, b = F.col("p"), F.col("n"), F.lit(float(n_toxic)), F.lit(float(n_clean))
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    rate = (p + n) / (a + b)
    g = 2 * (part(p, a * rate) + part(n, b * rate) + part(a - p, a * (1 - rate)) + part(b - n, b * (1 - rate)))
    kept = per_term.withColumn("g", g).where(F.col("g") >= MIN_G).orderBy(F.desc("g"), "stem", "tier").collect()
    return select_terms([(r["stem"], r["tier"], r["p"], r["n"]) for r in kept], len(kept))


def fit(documents: DataFrame, labels: DataFrame, usable: Column, text_col: str = "text", max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> tuple[BlockMaxIndex | None, DataFrame, list[int]]:
    """(index, ``documents`` with the terms of each text, the examples' doc_ids); inputs have (doc_id, text) and (doc_id, toxic)."""
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    with tidy(documents.sparkSession):
        drawn = materialize(sample_labels(labels, ids, usable, max_toxic, max_clean), "toxicity-labels")
        examples = materialize(examples_of(ids, drawn, "text", max_toxic, max_clean), "toxicity-examples")
        vocabulary = learn_terms(examples)
        features = materialize(with_terms(documents, text_col, vocabulary), "toxicity-features", keep=True)
        if not vocabulary:
            return None, features, []

        # Document frequencies over all documents; one row for each kept term comes back.
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros(len(vocabulary), np.int64)
            for batch in batches:
                n += np.bincount(batch.column(0).flatten().to_numpy(), minlength=len(n))
            met = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(n[met])], ["t", "n"])

        df = np.zeros(len(vocabulary))
        for r in features.select(features.columns[-1]).mapInArrow(count, "t int, n long").groupBy("t").agg(F.sum("n").alias("n")).collect():
            df[r["t"]] = r["n"]
        n_docs = features.count()
        rows = with_terms(examples, "text", vocabulary).select("doc_id", "__terms", "toxic", "stands_for").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["doc_id"], r["toxic"], r["__terms"]))
    vectors = [np.array(r["__terms"], np.int64) for r in rows]
    index = BlockMaxIndex(vectors, np.array([r["toxic"] for r in rows], float), np.array([r["stands_for"] for r in rows], float), np.log((n_docs + 1) / (df + 1)) + 1)
    index.calibrate()
    index.vocabulary = vocabulary
    return index, features, [r["doc_id"] for r in rows]


class Scorer:
    """Scores term sets; remembers those it has met, up to a bound."""

    def __init__(self, index: BlockMaxIndex | None) -> None:
        self.index = index
        self.met: dict[bytes, tuple[float, np.ndarray, np.ndarray]] = {}

    def __call__(self, terms: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """(score, places of the nearest examples, their cosines)."""
        none = np.zeros(0, np.int64), np.zeros(0)
        if self.index is None:
            return 0.0, *none
        key = terms.tobytes()
        if key not in self.met:
            if len(self.met) > 50_000:
                self.met.clear()
            near = self.index.nearest(*self.index.weigh(terms)) if len(terms) else none
            self.met[key] = self.index.score(self.index.vote(*near)), *near
        return self.met[key]


def score(index: BlockMaxIndex | None, features: DataFrame, example_ids: list[int], evidence: int = 3) -> DataFrame:
    """(doc_id, score, evidence): evidence names the nearest examples as id:label:cosine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(index)
        for batch in batches:
            scores, why = [], []
            for terms in batch.column(1):
                s, places, cosines = scorer(np.array(terms.as_py(), np.int32))
                near = zip(places[:evidence].tolist(), cosines.tolist())
                scores.append(s)
                why.append(",".join(f"{example_ids[index.origin[i]]}:{int(index.toxic[i])}:{x:.4f}" for i, x in near))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(why, pa.string())], ["doc_id", "score", "evidence"])

    return features.select("doc_id", features.columns[-1]).mapInArrow(run, "doc_id long, score double, evidence string")


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) of every document; held-out rows teach nothing."""
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    index, features, ids = fit(own, labels.select("doc_id", "toxic"), ~held_out(F.col("doc_id")))
    return score(index, features, ids).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence"
    )


def reject(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents`` that score under ``threshold``, all columns kept; nothing is shuffled to filter."""
    index, features, _ = fit(documents, labels.select("doc_id", "toxic"), ~held_out(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(index)
        for batch in batches:
            stays = pa.array([scorer(np.array(terms.as_py(), np.int32))[0] < threshold for terms in batch.column(batch.num_columns - 1)], pa.bool_())
            yield batch.select(range(batch.num_columns - 1)).filter(stays)

    return features.mapInArrow(run, documents.schema)
