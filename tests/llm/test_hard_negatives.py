"""Hard negatives: all anchors against all rows by brute force, bounds of the pruning, odd rows."""

import math

import numpy as np
import pytest
from conftest_sf import SF_SMALL, table
from pyspark.sql import functions as F

from payerlake.llm import hard_negatives as HN
from payerlake.llm.queries import QUERIES


def by_hand(rows, is_anchor, k=5, low=80, high=100):
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, v, label in rows}
    out = set()

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))  # noqa: B905  shorter ones count as filled with zeros

    for a in filter(is_anchor, whole):
        score = {i: dot(whole[a][1], v) for i, (_, v) in whole.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if whole[i][0] == whole[a][0]][:k]:
            inside = [i for i in order if whole[i][0] != whole[a][0] and low * score[p] <= 100 * score[i] <= high * score[p]]
            out |= {(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(inside[:k])}
    return out


def test_query_equals_brute_force(spark):
    rows = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in table("embeddings", "vec_id, embedding, label")]
    got = [tuple(r) for r in QUERIES["op11_hard_negatives"](spark, SF_SMALL).collect()]
    assert len(got) == len(set(got)) and set(got) == by_hand(rows, lambda i: i % 100 == 0)
    assert got


@pytest.mark.parametrize("dims", [1, 2, 7])
def test_lengths_ties_and_blocks(spark, monkeypatch, dims):
    """Many lengths, equal vectors, zeros and negative scores, several buckets and blocks."""
    monkeypatch.setattr(HN, "BLOCK", 16)
    monkeypatch.setattr(HN, "VALUES", 64)
    rng = np.random.default_rng(dims)
    vectors = np.round(rng.normal(size=(600, dims)) * rng.choice([0.01, 0.1, 1, 3], (600, 1)), 2)
    vectors[:40] = vectors[0]
    vectors[40:60] = 0
    rows = [(i, v.tolist(), int(rng.integers(3))) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    got = [tuple(r) for r in HN.hard_negatives(df, F.col("vec_id") % 10 == 0).collect()]
    assert len(got) == len(set(got)) and set(got) == by_hand(rows, lambda i: i % 10 == 0)


def test_pruning_keeps_what_counts_and_drops_the_rest():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 16)) * 300
    vectors = np.floor(centres[rng.integers(8, size=1000)] + rng.normal(size=(1000, 16)) * 10).astype(np.int64)
    bucket = HN.Bucket.of(np.arange(1000), np.zeros(1000, np.int64), vectors)
    length = np.sqrt((vectors[:50].astype(float) ** 2).sum(axis=1))
    points = HN.scores(vectors, vectors[:50])
    beat = np.sort(points, axis=0)[-20].astype(float)
    found = dict(HN.feasible(bucket, vectors[:50] / length[:, None], length, beat))
    for a in range(50):
        assert set(np.flatnonzero(points[:, a] >= beat[a])) <= set(found[a].tolist())
    assert sum(map(len, found.values())) < 0.4 * points.size
    assert not dict(HN.feasible(bucket, vectors[:1] / length[:1, None], length[:1], np.array([1e12])))


def test_large_numbers_are_exact():
    a = np.array([[2**30, 1], [2**30, 3]], np.int64)
    assert HN.scores(a, a[0]).tolist() == [2**60 + 1, 2**60 + 3]


def test_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, label int, id long, score string, v int, place long, _label int"
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0], 1), (1, [1.0, 0.5], 1), (2, [0.9, 0.0], 2), (3, [0.9], 2), (4, [], 2), (5, [2.0, 0.0], 1)]
    bad = [(None, [1.0, 0.0], 2), (6, None, 2), (7, [1.0, None], 2), (8, [nan, 1.0], 2), (9, [1.0, -inf], 2), (10, [1.0, 0.0], None)]
    rows = [(*r, 0, "x", 1, None, 9) for r in [*good, good[1], good[2], *bad]]
    df = spark.createDataFrame(rows, schema)
    exact = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in good]
    got = [tuple(r) for r in HN.hard_negatives(df, F.col("vec_id") < 3).collect()]
    assert len(got) == len(set(got)) and set(got) == by_hand(exact, lambda i: i < 3)
    assert HN.hard_negatives(df.limit(0), F.col("vec_id") < 3).collect() == []
    assert HN.hard_negatives(df, F.lit(False)).collect() == []
