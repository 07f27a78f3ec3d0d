"""Periodic runs: brute force over all lags, odd rows, very long texts."""

import hashlib
import random
import zlib

import numpy as np
from cases import TEXTS, WORD, no_rows, odd_rows
from conftest_sf import SF_SMALL, table
from pyspark.sql import functions as F

from payerlake.llm.periodic_runs import LEAST, TIMES, periodic_runs, runs_of
from payerlake.llm.queries import QUERIES


def runs_by_hand(w):
    """Maximal stretches of every lag; of equal stretches the smallest lag is the period."""
    found = {}
    for q in range(1, len(w) // TIMES + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            if j - i + q >= max(LEAST, TIMES * q):
                found.setdefault((i - q, j - i + q), q)
            i = max(j, i) + (j == i)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed_by_hand(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic(rng, size):
    w = []
    while len(w) < size:
        base = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 32, 33, 60]))]
        if rng.random() < 0.3:
            base = base * rng.randrange(1, 4) + [rng.randrange(3)]
        w += (base * 6)[:rng.randrange(1, 5 * len(base) + 1)]
    return w


def test_runs_equal_brute_force():
    rng = random.Random(12)
    for _ in range(300):
        texts = [periodic(rng, rng.randrange(300)) for _ in range(rng.randrange(1, 5))] + [[]]
        got = runs_of(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts]))
        assert got == [runs_by_hand(t) for t in texts]


def test_limits_of_a_run():
    for words, expected in (([0] * 23, []), ([0] * 24, [(0, 24, 1)]), ([1, *[0] * 24, 2], [(1, 24, 1)]),
                            (list(range(9)) * 2 + list(range(8)), []), (list(range(9)) * 3, [(0, 27, 9)]),
                            (list(range(8)) * 3, [(0, 24, 8)]), ([5, *list(range(40)) * 3, 0, 1, 7], [(1, 122, 40)])):
        assert runs_of(np.array(words), np.array([len(words)])) == [expected] == [runs_by_hand(words)]


def test_one_word_a_million_times():
    n = 1_000_000
    assert runs_of(np.zeros(n, np.int64), np.array([n])) == [[(0, n, 1)]]
    two = np.tile(np.arange(1000), 1000)
    assert runs_of(two, np.array([n])) == [[(0, n, 1000)]]


def test_odd_rows(spark):
    long = " ".join(["a b c"] * 200_000)
    df = odd_rows(spark, [*TEXTS, long, "x " * 23, "x " * 24])
    by_id = {r.doc_id: r.text for r in df.collect()}
    got = periodic_runs(df).collect()
    assert len(got) == df.count() and len({tuple(map(str, r)) for r in got}) == len(got) - 1  # one row is repeated
    for r in got:
        w = WORD.findall(by_id[r.doc_id] or "")
        runs = [tuple(x) for x in r.runs]
        assert r.n_words == len(w)
        assert runs == ([(0, len(w), 3)] if by_id[r.doc_id] == long else
                        [(0, len(w), 4)] if by_id[r.doc_id] == TEXTS[6] else runs_by_hand(w))
        assert r.collapsed == collapsed_by_hand(w, runs)
    assert periodic_runs(no_rows(spark)).collect() == []
    words = spark.createDataFrame([(1, None), (2, []), (3, [None] * 24)], "id long, w array<string>")
    assert [len(r.runs) for r in periodic_runs(words, "id", F.col("w")).orderBy("id").collect()] == [0, 0, 1]


def test_query_equals_brute_force(spark):
    texts = dict(table("documents", "doc_id, text"))
    got = QUERIES["op12_periodic_runs"](spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    planted = 0
    for r in got:
        w, h = WORD.findall(texts[r.doc_id] or ""), zlib.crc32(str(r.doc_id).encode())
        if len(w) > 3000:
            continue
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        runs = runs_by_hand(w)
        planted += bool(runs)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        sha = [hashlib.sha256(t.encode()).hexdigest()
               for t in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), collapsed_by_hand(w, runs))]
        assert (r.n_runs, r.start, r.length, r.period, r.runs_sha256, r.collapsed_sha256) == (len(runs), *best, *sha)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
    assert planted > 10
