"""Brute-force versions and a small awkward table."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType()), StructField("fp", StringType()),
                   StructField("score", StringType())])  # the last two clash with names the operators use


def words(rng, n):
    parts = ["the", "of", "and", "ing", "ta", "re", "lo", "mi", "su", "né", "über", "ka"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def awkward_rows(seed=5):
    """Nulls, empty texts, ties, repeated rows, copies, a long text, shared passages."""
    rng = random.Random(seed)
    passage = " ".join(words(rng, 60))
    copy = " ".join(words(rng, 80))
    rows = [(i, " ".join(words(rng, rng.randint(1, 90)))) for i in range(40)]
    rows += [(40 + i, copy) for i in range(6)]
    rows += [(50 + i, " ".join(words(rng, 10)) + " " + passage + "\n" + " ".join(words(rng, 5))) for i in range(5)]
    rows += [(60, ""), (61, None), (62, "word"), (63, "Word"), (64, " ".join(words(rng, 5000))), (65, "ü" * 120), (66, "ü" * 90), (66, "ü" * 90),
             (None, passage), (None, None), (67, "  \t\n "), (68, "a b")]
    return [(i, t, "en", "s", None if t is None else len(t), "x", "y") for i, t in rows]


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
