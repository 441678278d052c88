"""The trie against a dictionary of prefixes: hot groups over several shards, very long conversations, awkward rows."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from framewright.llm import prefix_trie
from framewright.llm.queries import oracle_sql

SCHEMA = "conv_id long, turn long, role string, text string, hash binary, depth int, ends string, shard int"


def brute(rows):
    """Nodes by prefix, straight from the definition."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own.setdefault(conv, []).append(((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        full = own.get(c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5)), [])[:h] + turns[h:]
        for d in range(len(full) + 1):
            nodes.setdefault(tuple(full[:d]), []).append((c, len(full) == d))
    kids, leaves, saved = {k: 0 for k in nodes}, {k: 0 for k in nodes}, {k: 0 for k in nodes}
    for k in nodes:
        if k:
            kids[k[:-1]] += 1
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] += kids[k] == 0
        saved[k] += (len(nodes[k]) - 1) * len(k[-1][1].encode()) if k else 0
        if k:
            leaves[k[:-1]] += leaves[k]
            saved[k[:-1]] += saved[k]
    out = []
    for k, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c, e in members if e)))
        out.append((min(c for c, _ in members), len(k), min(c for c, _ in nodes[k[:-1]]) if k else None, len(members), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations():
    rng = random.Random(5)
    rows = []
    for c in range(160):
        for t in range(rng.choice([0, 1, 2, 5, 12])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "é" * 3])))
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(90) for t in range(10)]  # copies, a third of all rows
    rows += [(2000, t, "user", "long") for t in range(400)] + [(2001, t, "user", "long" if t < 390 else "other") for t in range(395)]
    rows += [(3000, t, "user", str(t % 3)) for t in range(50)]
    rows += [(5, None, None, None), (5, None, "user", None), (6, 3, "x", ""), (6, 3, "x", ""), (7, 2, "", "xy"), (8, 2, "x", "y"), (-7, 0, "user", "a"), (-5, 0, "user", "a"), (None, 1, "user", "a"), (4_000_000_000_000, 0, "user", "a")]
    rng.shuffle(rows)
    return [(*r, b"", 1, "", 2) for r in rows]


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_against_prefixes(spark, shards):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = prefix_trie.trie(prefix_trie.rebuilt(df), shards)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_report_and_twin(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA)
    got = prefix_trie.report(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    want = brute(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    c = duckdb.connect()
    c.register("conversations", df.select("conv_id", "turn", "role", "text").toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    assert sorted(c.execute(oracle_sql()["op12_prefix_trie"]).fetchall(), key=repr) == want


def test_turnless_conversation(spark):
    """A conversation shorter than what it would take over, with no base: it only belongs to the root."""
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(c, 0, "user", "a", b"", 1, "", 2)]
    got = prefix_trie.report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert list(map(tuple, got)) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_empty(spark):
    assert prefix_trie.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_levels_by_any_block_width():
    rng = np.random.default_rng(3)
    lens = rng.integers(0, 9, 300)
    ids = rng.integers(1, 3, (lens.sum(), 2)).astype(np.uint64)
    conv, sizes = rng.permutation(300), np.zeros(lens.sum(), np.int64)
    begin = np.concatenate([[0], np.cumsum(lens)])
    texts = [tuple(map(tuple, ids[begin[i] : begin[i + 1]].tolist())) for i in range(300)]
    for width in (1, 3, 16):
        order, found = prefix_trie.levels(conv, ids, lens, sizes, width)
        assert order.tolist() == sorted(range(300), key=lambda i: (texts[i], conv[i]))
        assert [len(f["start"]) for f in found] == [len({t[:d] for t in texts if len(t) >= d}) for d in range(len(found))]
