"""Rows that every operator must take: nulls, empty and very long texts, ties, repeats, clashing names."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

LONG = "long text without end " * 4000
TEXTS = [None, "", " ", "\n", "one", "Same line of more than forty characters, five times over.\nx",
         LONG, "a" * 5000, "é 漢字 😀 \t\n\n  ünï", "token = \"abc123def456\"", "w1 w2 w3 w4 w5 w6 w7 w8 w9"]
# Names that operators use inside.
CLASHES = ("key", "id", "h1", "fp", "n", "keep", "rule", "words", "row", "score", "kept", "component", "carried", "less")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def odd_rows(spark, texts=TEXTS):
    """documents with odd texts, repeated rows, a null key and columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "src", None) for i, t in enumerate(texts)]
    rows += [(len(texts) + 1, TEXTS[5], "en", "a", 3), (len(texts) + 1, TEXTS[5], "en", "a", 3), (None, "no key", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *(F.lit("x").alias(c) for c in CLASHES))


def no_rows(spark):
    return odd_rows(spark).limit(0)


def shingles(text: str | None, width: int = 5) -> frozenset:
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def near_components(rows: list[tuple], percent: int = 85) -> dict:
    """Smallest reachable id of each id, by comparing all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders: dict = {}
    for d in sorted(sets):
        for s in sets[d]:
            holders.setdefault(s, []).append(d)
    pairs = {(a, b) for ids in holders.values() for i, a in enumerate(ids) for b in ids[i + 1:]}
    for a, b in pairs:
        shared = len(sets[a] & sets[b])
        if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {d: root(d) for d in sets}
