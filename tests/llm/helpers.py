"""Documents that hold every awkward case, and table folders for whole queries."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, key long, size string"
WORDS = [a + b for a in ("tha", "ner", "ou", "pe", "sti", "mo") for b in ("re", "ling", "on", "as", "it")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + ("." if rng.random() < 0.1 else "") for _ in range(n))


def documents(seed=1, n=40):
    """(doc_id, text, lang, source, ...) with nulls, empties, copies, near copies, repeated rows and a very long text."""
    rng = random.Random(seed)
    texts = [sentence(rng, rng.choice([1, 3, 5, 30, 120])) for _ in range(n)]
    base = sentence(rng, 150)
    near = base.split()
    near[70] = "changed"
    texts += [None, "", " \n\t ", base, base, " ".join(near), "é漢字 " * 300, "x" * 3000, sentence(rng, 20_000), "a" * 199, "b" * 200, "<|endoftext|> it's \x1c 12 É"]
    rows = [(i, t, "en", rng.choice(["s1", "s2", None]), None if t is None else len(t), "n", 7, "z") for i, t in enumerate(texts)]
    return [*rows, rows[3], rows[3], (None, "no id at all " * 30, "en", "s1", 1, None, None, None)]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, DOCS).repartition(3)
