"""Cosine top-k against a brute-force numpy computation on the small table."""

import numpy as np
import pandas as pd

from payerlake.operators import retrieval
from payerlake.operators.analytics import dedup_claims
from payerlake.sources.tables import read_table

from conftest import SF_SMALL


def test_cosine_topk_brute_force(spark):
    emb = read_table(spark, SF_SMALL, "embeddings", ["vec_id", "embedding", "label"])
    got = retrieval.cosine_topk(emb, retrieval.centroids(emb), 5).toPandas()
    pdf = emb.toPandas()
    X = np.stack(pdf.embedding.map(lambda v: np.asarray(v, dtype=np.float64)))
    for label, grp in pdf.groupby("label"):
        c = np.stack(grp.embedding.map(lambda v: np.asarray(v, dtype=np.float64))).mean(axis=0)
        s = X @ c / (np.linalg.norm(X, axis=1) * np.linalg.norm(c))
        order = sorted(range(len(s)), key=lambda i: (-s[i], pdf.vec_id[i]))[:5]
        want = [int(pdf.vec_id[i]) for i in order]
        have = got[got.query_id == label].sort_values("rank").item_id.tolist()
        assert have == want
        assert np.allclose(got[got.query_id == label].sort_values("rank").score, s[order], atol=1e-9)


def test_vectors_without_a_score_are_left_out(spark, monkeypatch):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0]), (5, [1.0, 1.0]), (6, [2.0, 0.0])]
    corpus = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 1.0]), (4, None)],
                                    "query_id long, query_vec array<double>")
    want = [(1, 1, 1, 1.0), (1, 6, 2, 1.0), (3, 5, 1, 0.5**0.5), (3, 1, 2, 0.0)]
    for values in (1_000_000, 1):  # one block of queries, and a block for each
        monkeypatch.setattr(retrieval, "BLOCK_VALUES", values)
        got = sorted((r.query_id, r["rank"], r.item_id, r.score) for r in retrieval.cosine_topk(corpus, queries, 2).collect())
        assert [(q, i, r) for q, r, i, _ in got] == [(q, i, r) for q, i, r, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])
    assert retrieval.cosine_topk(corpus, queries.limit(0)).count() == 0


def test_many_queries_are_scored_in_tiles(spark, monkeypatch):
    """No product of a task is larger than a tile, and a task passes on k rows a query, whatever its batches."""
    rng = np.random.default_rng(7)
    X = rng.normal(size=(600, 8))
    X[300:] = X[:300]  # every vector twice: ties go to the smaller id
    corpus = spark.createDataFrame([(int(i), x.tolist()) for i, x in enumerate(X)], "vec_id long, embedding array<double>").coalesce(1)
    queries = corpus.filter("vec_id % 2 = 0").selectExpr("vec_id AS query_id", "embedding AS query_vec")
    unit = X / np.linalg.norm(X, axis=1, keepdims=True)
    score = np.round(unit @ unit.T, 12)
    want = {(q, r + 1): int(i) for q in range(0, 600, 2) for r, i in enumerate(np.lexsort((np.arange(600), -score[q]))[:4])}
    monkeypatch.setattr(retrieval, "TILE_VALUES", 1000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = {(r.query_id, r["rank"]): r.item_id for r in retrieval.cosine_topk(corpus, queries, 4).collect()}
        rows = retrieval._score_block(corpus, queries.collect(), "vec_id", "embedding", 4).count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want and rows == 300 * 4


def test_terms_with_codes_of_any_length(spark):
    from payerlake.operators.analytics import claims_by_term
    claims = spark.createDataFrame([("E11.9", "a", "Approved", 1.0), ("E11", "a", "Denied", 1.0), ("J45.2", "a", "Approved", 1.0),
                                    (None, "a", "Approved", 1.0)],
                                   "diagnosis_code string, payer_name string, claim_status string, billed_amount double")
    terms = spark.createDataFrame([("diabetes", "E11"), ("type two", "E11.9"), ("asthma", "J45.2"), ("asthma", "J4")],
                                  "term string, icd10_category string")
    got = {(r.term, r.icd10_category): r.total_claims for r in claims_by_term(claims, terms).collect()}
    assert got == {("diabetes", "E11"): 2, ("type two", "E11.9"): 1, ("asthma", "J45.2"): 1, ("asthma", "J4"): 1}


def test_dedup_keeps_one_latest_per_key(spark):
    import datetime as dt
    rows = [("payer_a", "c1", dt.date(2001, 1, d), f"x{d}") for d in range(1, 28)] * 3 + \
           [("payer_b", "c1", dt.date(2001, 1, 1), "y")]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["payer_name", "claim_id", "processing_date", "v"]))
    out = sorted(tuple(r) for r in dedup_claims(df).collect())
    assert out == [("payer_a", "c1", dt.date(2001, 1, 27), "x27"), ("payer_b", "c1", dt.date(2001, 1, 1), "y")]
