from collections import Counter, defaultdict

import numpy as np
import pytest

from framewright.llm import near_dedup as nd
from framewright.llm.graph import components

from .helpers import documents, frame, sentence


def test_signatures_are_unbiased():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(80):
        n = int(rng.integers(3, 300))
        a = Counter({int(x): int(rng.integers(1, 9)) if rng.random() < 0.4 else 1 for x in rng.integers(1, 2**63, n)})
        b = Counter({x: max(1, c + int(rng.integers(-3, 4))) for x, c in a.items() if rng.random() < 0.8})
        b.update({int(x): 1 for x in rng.integers(1, 2**63, max(1, n // 6))})
        pair = [(np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)])) for c in (a, b)]
        s = nd.signatures(pair)
        assert (nd.signatures(pair[:1])[0] == s[0]).all()
        errors.append((s[0] == s[1]).mean() - sum((a & b).values()) / sum((a | b).values()))
    assert abs(np.mean(errors)) < 0.015
    assert np.std(errors) < 0.06


def brute(rows):
    shingle = nd.Shingler()
    bags = {}
    for r in rows:
        h, c = shingle(r[1] or "")
        bags.setdefault(r[1] or "", Counter(dict(zip(h.tolist(), c.tolist(), strict=True))))
    texts = list(bags)
    parent = {t: t for t in texts}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            x, y = bags[a], bags[b]
            if x and y and sum((x & y).values()) >= 0.8 * sum((x | y).values()):
                parent[root(a)] = root(b)
    classes = defaultdict(list)
    for n, r in enumerate(rows):
        classes[root(r[1] or "") if bags[r[1] or ""] else n].append(r[0])
    want = Counter()
    for ids in classes.values():
        low = min((i for i in ids if i is not None), default=None)
        want.update((i, low, len(ids)) for i in ids)
    return want


def cases():
    import random

    rng = random.Random(11)
    rows = documents()
    for g in range(4):
        words = sentence(rng, 120).split()
        for m in range(14):
            own = list(words)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = f"edit{rng.randrange(9)}"
            rows.append((2000 + 20 * g + m, " ".join(own), "en", "s", 1, "", 1, ""))
    return rows + [(3000, "Five  words are enough here", "en", "s", 1, "", 1, ""), (3001, "five words\nare enough here", "en", "s", 1, "", 1, "")]


@pytest.mark.parametrize("bound", [4096, 4, 2])
def test_classes_match_all_pairs(spark, bound):
    rows = cases()
    got = Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in nd.report(frame(spark, rows), bound=bound).collect())
    assert got == brute(rows)


def test_one_row_of_each_class_stays(spark):
    rows = cases()
    kept = nd.deduplicate(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    classes = brute(rows)
    blank = [r[0] for r in rows if not (r[1] or "").strip()]
    want = Counter(c for i, c, _ in classes if i == c or (i is None and c is None))
    assert ids == want
    assert all(ids[i] == 1 for i in blank)


def test_empty_table(spark):
    assert nd.report(frame(spark, [])).count() == 0
    assert nd.deduplicate(frame(spark, [])).count() == 0


def test_components(spark):
    edges = [(i + 1, i) for i in range(30)] + [(100, 200), (200, 150), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 150: 100, 200: 100}


def test_blank_is_one_rule(spark):
    texts = ["\xa0", "\u3000\u3000", "\u2003 \n", "\x85", "\x1c\x1f", "\u200b", "a\xa0"]
    rows = [(10 * i + j, t, "en", "s", 1, "", 1, "") for i, t in enumerate(texts) for j in (0, 1)]
    got = {r["doc_id"] for r in nd.deduplicate(frame(spark, rows)).collect()}
    assert got == {10 * i + j for i, t in enumerate(texts) for j in (0, 1) if not t.split() or j == 0}
    assert set(nd._SPACES) == {chr(i) for i in range(0x110000) if not chr(i).split()}


def test_copies_of_one_text_in_many_rows(spark):
    rows = cases()
    rows += [rows[3]] * 500 + [(9000 + i, rows[-1][1], "en", "s", 1, "", 1, "") for i in range(500)]
    got = Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in nd.report(frame(spark, rows)).collect())
    assert got == brute(rows)
    kept = Counter(r["doc_id"] for r in nd.deduplicate(frame(spark, rows)).collect())
    assert kept == Counter(c for i, c, _ in set(got) if i == c)


def test_large_groups_take_work_in_step_with_their_size(spark, monkeypatch):
    """Chunks of near copies meet their group's smallest node, not each other."""
    import random

    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(200):
        own = list(words)
        own[rng.randrange(300)] = f"e{i}"
        texts.append((i, " ".join(own), "en", "s", 1, "", 1, ""))
    tasks = []
    own_dealt = nd._dealt
    monkeypatch.setattr(nd, "_dealt", lambda df, rest: tasks.append(df.count()) or own_dealt(df, rest))
    got = nd.report(frame(spark, texts), bound=20).collect()
    assert {r["class_id"] for r in got} == {0}
    assert all(r["class_size"] == 200 for r in got)
    # Verification: ten chunks, each with the smallest node, and nothing left for a second round.
    assert tasks[2] == 200 + 9
    assert tasks[3] == 0


@pytest.mark.parametrize("k", [0, 1, 2, 3, 4, 6])
def test_recall_by_similarity(k):
    """Texts with k of 200 words changed: what the bands and the signature test pass, of pairs at 0.8 or more."""
    rng = np.random.default_rng(k)
    shingle = nd.Shingler()
    hit = total = 0
    for n in range(150):
        words = [f"w{n}x{i}" for i in range(200)]
        other = list(words)
        for i in rng.choice(200, k, replace=False):
            other[i] = "changed"
        a, b = shingle(" ".join(words)), shingle(" ".join(other))
        both = len(set(a[0].tolist()) & set(b[0].tolist()))
        if both / (len(a[0]) + len(b[0]) - both) >= 0.8:
            s = nd.signatures([a, b])
            total += 1
            hit += bool((nd.band_keys(s[0]) == nd.band_keys(s[1])).any() and (s[0] == s[1]).mean() >= nd.LOOSE)
    assert total == 0 or hit / total >= 0.99
