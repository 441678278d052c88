import hashlib
from collections import Counter

import pytest

from framewright.llm import repeats
from framewright.llm.repeats import Surroundings, anchors, merge_spans, repeat_groups, repeat_offsets, report

from .helpers import documents, frame


def brute(texts, length=200):
    """(n_bytes, n_removed, n_spans, kept_sha256) by counting every string."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return out


def cases():
    rng_docs = [r for r in documents() if r[1] is None or len(r[1]) < 20_000]
    passage = "".join(chr(97 + (i * i * 7 + i) % 26) for i in range(500))
    extra = [
        passage[:260] + "1" * 50, "2" * 30 + passage[:260], passage[40:239] + "no", passage[40:240] + "yes", passage[100:430] + passage[90:350],
        "ab" * 400, "é" * 130 + passage[:199] + "é" * 130, passage + "3" + passage[200:],
    ]
    return [*rng_docs, *[(1000 + i, t, "en", "s", 1, "", 1, "") for i, t in enumerate(extra)]]


@pytest.mark.parametrize("bound", [4096, 2])
def test_removal_matches_counting(spark, bound):
    rows = cases()
    got = Counter(tuple(r) for r in report(frame(spark, rows), bound=bound).collect())
    want = Counter((row[0], *b) for row, b in zip(rows, brute([r[1] for r in rows]), strict=True))
    assert got == want


def test_empty_table(spark):
    assert report(frame(spark, [])).count() == 0


def test_every_window_has_its_anchor():
    import numpy as np

    rng = np.random.default_rng(2)
    data = rng.integers(97, 101, 4000).astype(np.uint8)
    doc, pos, key, *_ = anchors(data, np.array([150, 1500, 4000]))
    assert set(doc.tolist()) == {1, 2}
    starts = np.array([0, 150, 1500])[doc] + pos
    for p in [*range(150, 1301), *range(1500, 3801)]:
        assert ((starts >= p) & (starts <= p + 150)).any()
    a, b = (anchors(np.concatenate([rng.integers(0, 9, n).astype(np.uint8), data[:300]]), np.array([n + 300])) for n in (30, 47))
    inner = lambda x, n: {(int(p) - n, int(k)) for p, k in zip(x[1], x[2], strict=True) if 0 <= p - n}
    assert len(inner(a, 30) & inner(b, 47)) >= 1


def test_interval_tree_against_pairs():
    import random

    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(2, 9)
        left = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 8))) for _ in range(n)]
        right = [b"key" + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 8))) for _ in range(n)]
        got = repeat_offsets(left, right, length=10, gram=3)
        for i in range(n):
            for o in range(8):
                own = None if o > len(left[i]) or 10 - o > len(right[i]) else left[i][:o][::-1] + right[i][: 10 - o]
                others = [left[j][:o][::-1] + right[j][: 10 - o] for j in range(n) if j != i and o <= len(left[j]) and 10 - o <= len(right[j])]
                assert got[i, o] == (own is not None and own in others)


def test_spans_merge():
    import numpy as np

    node, start, end = merge_spans(np.array([2, 1, 1, 1]), np.array([0, 5, 0, 9]), np.array([3, 9, 4, 12]))
    assert list(zip(node.tolist(), start.tolist(), end.tolist(), strict=True)) == [(1, 0, 4), (1, 5, 12), (2, 0, 3)]


def test_maximal_groups_against_all_strings():
    import random

    rng = random.Random(7)
    for _ in range(150):
        n = rng.randint(2, 9)
        left = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 3))) for _ in range(n)]
        right = [b"key" + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 3))) for _ in range(n)]
        got = {(before, after, tuple(sorted(own.tolist()))) for before, after, own in Surroundings(left, right, length=6, gram=3).groups()}
        want = set()
        for before in range(4):
            for after in range(3, 7):
                strings = {}
                for i in range(n):
                    if before <= len(left[i]) and after <= len(right[i]) and before + after >= 6:
                        strings.setdefault((left[i][:before], right[i][:after]), []).append(i)
                for own in strings.values():
                    more = lambda side, at: {side[i][at] if at < len(side[i]) else -i - 1 for i in own}  # noqa: B023, E731
                    # Maximal: neither side goes on alike for all; what the surroundings hold ends at 3 and 6 bytes.
                    if len(own) > 1 and (before == 3 or len(more(left, before)) > 1) and (after == 6 or len(more(right, after)) > 1):
                        want.add((before, after, tuple(own)))
        assert got == want


@pytest.mark.parametrize("bound", [4096, 2])
def test_groups_hold_equal_strings(spark, bound):
    from pyspark.sql import functions as F

    rows = cases()
    df = frame(spark, rows)
    text_of = {r["node"]: (r["text"] or "").encode() for r in df.select(F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")).alias("node"), "text").collect()}
    groups = {}
    for r in repeat_groups(df, bound=bound).collect():
        groups.setdefault((bytes(r["key"]), r["member"]), set()).add((r["node"], r["start"], r["length"]))
    assert groups
    for own in groups.values():
        assert len(own) > 1
        assert len({text_of[node][start : start + length] for node, start, length in own}) == 1
        assert all(length >= 200 and start + length <= len(text_of[node]) for node, start, length in own)


def test_copies_of_one_text_in_many_rows(spark):
    rows = cases()
    rows += [rows[3]] * 300 + [(5000 + i, rows[-1][1], "en", "s", 1, "", 1, "") for i in range(300)]
    got = Counter(tuple(r) for r in report(frame(spark, rows)).collect())
    assert got == Counter((row[0], *b) for row, b in zip(rows, brute([r[1] for r in rows]), strict=True))


def test_anchors_by_pieces():
    """Pieces of any size give the anchors of the whole, edges of documents and empty ones included."""
    import numpy as np

    rng = np.random.default_rng(8)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    data[3000:3400] = data[500:900]
    ends = np.array([0, 150, 700, 700, 2400, 2650, 5000])
    whole = repeats.anchors(data, ends)
    for piece in (1, 37, 300, 1024):
        assert all((a == b).all() for a, b in zip(repeats.anchors(data, ends, piece=piece), whole, strict=True))
    again = repeats.anchors(data[700:2400], np.array([1700]))
    own = whole[0] == 4
    assert all((a == b[own]).all() for a, b in zip(again[1:], whole[1:], strict=True))


def test_memory_of_anchors_does_not_follow_the_text():
    """40 MB take some three bytes a byte beside the text, not thirty-eight."""
    import subprocess
    import sys

    code = """
import resource, sys
import numpy as np
from framewright.llm import repeats
data = np.random.default_rng(1).integers(97, 122, int(sys.argv[1]) << 20, dtype=np.uint8)
repeats.anchors(data, np.array([len(data)]))
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    small, large = (int(subprocess.run([sys.executable, "-c", code, n], capture_output=True, text=True, check=True, cwd=str(__import__("pathlib").Path(__file__).parents[2])).stdout) for n in ("4", "40"))
    assert large - small < 36 * 5
