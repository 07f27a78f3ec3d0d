"""Families of similar texts: exact decisions within regions, linear work, crowds beyond a region."""

import random

import numpy as np
import pytest
from cases import near_components, shingles
from pyspark.sql import functions as F

from payerlake.llm import near_dedup as N
from payerlake.llm._util import narrow, store
from payerlake.llm.components import merged

DOCS = "doc_id long, text string"


def family(rng, size, edits, pairs, shared, words):
    """Texts on one template, each with own edits; the first ``pairs`` texts share edits with the next ones."""
    template = [f"t{i}" for i in range(words)]
    made = [{slot: f"e{k}x{slot}" for slot in rng.sample(range(2, words, 5), edits)} for k in range(size)]
    for k in range(pairs):
        made[pairs + k] = dict([*made[k].items()][:shared] + [*made[pairs + k].items()][shared:])
    return [" ".join(own.get(i, t) for i, t in enumerate(template)) for own in made]


def components_by_hand(texts, percent=85):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return dict(enumerate(root))


def test_groups_are_decided_exactly(monkeypatch):
    monkeypatch.setattr(N, "COLUMNS", 64)
    texts = family(random.Random(3), 60, 4, 12, 2, 300) + ["own words only here now", "x"]
    flat, sizes = N.shingle_sets([t.encode() for t in texts], 5)
    ids = np.arange(len(texts)) * 3
    a, b = N.linked(ids, sizes, flat.astype(np.int64), 85)
    got = {i: i for i in range(len(texts))} | dict(zip((a // 3).tolist(), (b // 3).tolist(), strict=True))
    assert got == components_by_hand(texts)
    again = N.linked(np.array([5, 5, 9]), np.array([2, 2, 2]), np.array([1, 2, 3, 4, 1, 2]), 85)
    assert [x.tolist() for x in again] == [[9], [5]]  # one key with two texts


def test_a_family_below_the_limit_costs_a_few_pairs_a_text(spark, monkeypatch):
    texts = family(random.Random(1), 400, 6, 0, 0, 400)  # pairs at about 0.75
    tested, shipped = [], []
    confirm, decide = N.confirm, N.decide_groups
    monkeypatch.setattr(N, "confirm", lambda pairs, *a: tested.append(pairs.count()) or confirm(pairs, *a))
    monkeypatch.setattr(N, "decide_groups", lambda groups, *a: shipped.append(groups.count()) or decide(groups, *a))
    got = N.near_duplicates(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()
    assert all(r.component_id == r.doc_id for r in got)
    assert sum(tested) <= 2 * N.PARTNERS * N.TREES * 400 / 4 and sum(shipped) <= 2 * N.TREES * 400


def test_crowds_beyond_a_region_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(N, "REGION", 48)
    texts = family(random.Random(2), 500, 10, 60, 3, 1000)
    rows = list(enumerate(texts))
    random.Random(4).shuffle(rows)
    want = near_components(rows)
    assert 300 < len(set(want.values())) < 480
    got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == want


def test_large_groups_are_dealt_out_by_pairs_of_parts(monkeypatch):
    monkeypatch.setattr(N, "VOLUME", 1000)
    rng = np.random.default_rng(1)
    low = np.repeat(rng.integers(0, 256, (1, N.HASHES), dtype=np.uint8), 20, axis=0)
    ids, n = rng.permutation(20) * 7, np.full(20, 200)
    groups = N._gather_region(ids, n, ids, low, 0.85)
    together = {frozenset((a, b)) for _, own in groups for a in own.tolist() for b in own.tolist()}
    assert len(together) == 20 * 21 // 2 and all(n[0] * len(own) <= 1000 + 2 * 200 for _, own in groups)
    assert len({g[0] for g, _ in groups}) == len(groups) > 1
    assert N._gather_region(ids, n, np.zeros(20, np.int64), low, 0.85) == []


@pytest.mark.parametrize("batch", [0, 1, 5])
def test_sequences_deal_out_all_minima(spark, batch):
    assert sorted(N.sequences(batch).ravel().tolist()) == list(range(N.HASHES))
    sig = np.random.default_rng(0).integers(0, 2**32, (50, N.HASHES), dtype=np.uint32)
    sig[:20, N.sequences(batch)[3][:N.MIN_DEPTH]] = 7  # alike in the leading minima of one tree
    df = spark.createDataFrame([(i, 9, bytearray(s.tobytes()), i) for i, s in enumerate(sig)],
                               "id long, n long, sig binary, component long")
    assert sorted(r.id for r in N.crowded(df, batch, 19).collect()) == list(range(20))
    assert N.crowded(df, batch, 20).count() == 0
    prefixes = N.forest(df, batch).filter("tree = 3").select(F.substring("key", 1, 8).alias("p")).distinct().count()
    assert prefixes == 31


def test_all_tables_of_a_family_of_exact_and_near_copies(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    texts = []
    for k in range(300):
        own = list(base)
        own[rng.randrange(300)] = f"edit{k % 150}"
        texts.append(" ".join(own))
    texts += texts[:100] + [" ".join(f"z{rng.randrange(5000)}" for _ in range(50)) for _ in range(40)]
    rows = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == near_components(rows)


def test_decided_groups_name_components_and_nothing_known(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words), " ".join([*words[1:], "x1"]), " ".join([*words[1:], "x2"]), "texts of their own five words"]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)

    def decided(components):
        rows = [(g, i, c) for g in (7, 8) for i, c in enumerate(components)]
        groups = spark.createDataFrame(rows, "group long, id long, component long")
        return sorted(map(tuple, N.decide_groups(groups, docs, "doc_id", "text", 5, 85).collect()))
    assert decided([0, 0, 0, 3]) == []
    assert decided([0, 0, 2, 3]) == [(2, 0)]
    assert decided([0, 1, 1, 3]) == [(1, 0)]


def test_components_found_linked_are_merged_into_the_stars(spark):
    links = spark.createDataFrame([(2, 1), (3, 1), (6, 5), (9, 8)], "a long, b long")
    found = spark.createDataFrame([(5, 1), (7, 5), (11, 10)], "a long, b long")
    got = sorted(map(tuple, merged(links, found).collect()))
    assert got == [(2, 1), (3, 1), (5, 1), (6, 1), (7, 1), (9, 8), (11, 10)]


def test_narrow_tables_go_into_a_few_files(spark):
    df = spark.range(2000).repartition(200)
    most = 4 * spark.sparkContext.defaultParallelism
    kept = store(narrow(df), "narrow")
    assert kept.count() == 2000 and len(kept.inputFiles()) <= most < len(store(df, "wide").inputFiles())
