"""Quality classifier: the sum-of-squares identity, gradients by learning, held-out rows, odd rows."""

import zlib

import numpy as np
from cases import TEXTS, no_rows, odd_rows
from conftest_sf import SF_CHECK, table
from pyspark.sql import functions as F

from payerlake.llm import quality_model as Q
from payerlake.llm.queries import QUERIES


def test_score_equals_all_pairs():
    rng = np.random.default_rng(1)
    rows = Q.featurise([b"one two two", b"", b"THREE ## 12 one"], np.array([11.0, np.nan, 15.0]))
    model = Q.Machine(0.3, rng.normal(size=Q.WIDTH), rng.normal(size=(Q.WIDTH, Q.FACTORS)))
    got = model.score(rows)
    for r in range(3):
        own = slice(rows.offsets[r], rows.offsets[r + 1])
        i, x = rows.index[own], rows.value[own]
        assert len(set(i.tolist())) == len(i)
        pairs = sum(x[a] * x[b] * (model.factors[i[a]] @ model.factors[i[b]]) for a in range(len(i)) for b in range(a))
        logit = model.bias + (model.weights[i] * x).sum() + pairs
        assert abs(got[r] - 1 / (1 + np.exp(-np.clip(logit, -30, 30)))) < 1e-9


def test_statistics_by_hand():
    text = "Ab ab ab ##x CD cd!\n12 é % "
    x, hashes, of = Q.statistics([b"", text.encode()], np.array([np.nan, 27.0]))
    got = dict(zip(Q.GROUPS, x[1].tolist(), strict=True))
    solid = sum(len(w.encode()) for w in text.split())
    assert got["upper"] == 3 / solid and got["digit"] == 2 / solid and got["sign"] == 3 / solid
    assert got["stop_sign"] == 1 / solid and got["non_ascii"] == 2 / solid
    assert got["capital_words"] == 2 / 9 and got["upper_words"] == 1 / 9 and got["sign_words"] == 2 / 9
    assert got["sign_ended_words"] == 1 / 9 and got["repeated_words"] == 2 / 9 and got["equal_neighbours"] == 2 / 9
    assert got["top_word"] == 3 / 9 and got["lines_a_word"] == 2 / 9
    assert len(hashes) == 9 and of.tolist() == [1] * 9 and np.isnan(x[0, -1]) and not np.isnan(x[:, :-1]).any()


def test_pairs_of_features_are_learned():
    """Neither word alone tells the label, only the two together."""
    rng = np.random.default_rng(4)
    bits = rng.integers(2, size=(2000, 2))
    texts = [f"{'left' if a else 'right'} {'up' if b else 'down'}".encode() for a, b in bits.tolist()]
    rows = Q.featurise(texts, np.full(len(texts), np.nan))
    good = (bits[:, 0] ^ bits[:, 1]).astype(float)
    model = Q.train(rows.take(np.arange(1500)), good[:1500])
    assert ((model.score(rows.take(np.arange(1500, 2000))) >= 0.5) == good[1500:]).mean() == 1
    linear = Q.Machine(model.bias, model.weights, np.zeros_like(model.factors))
    assert ((linear.score(rows) >= 0.5) == good).mean() < 0.8


def test_held_out_rows(spark):
    quality = dict(table("labels", "doc_id, quality", SF_CHECK))
    got = QUERIES["op13_quality_model"](spark, SF_CHECK).collect()
    assert len(got) == len(table("documents", "doc_id", SF_CHECK))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    judged = [(r.predicted, quality[r.doc_id]) for r in got if r.held_out and r.doc_id in quality]
    assert sum(p == q for p, q in judged) >= 0.97 * len(judged)
    assert sum(p for p, q in judged if q == 0) <= 0.15 * sum(q == 0 for _, q in judged)


def test_odd_rows(spark):
    df = odd_rows(spark)
    labels = df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    for model in (Q.fit(df, labels), Q.fit(df, labels.limit(0)), Q.fit(df, labels.filter("quality = 1"))):
        got = Q.score_quality(df, model).collect()
        assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
        by_text = {(r.text, r.n_chars): r.doc_id for r in df.collect()}
        score = {r.doc_id: r.score for r in got}
        assert score[by_text[None, None]] == score[0]
    assert Q.score_quality(no_rows(spark), model).collect() == []
    assert len(Q.score_quality(df, model, n_chars=None).collect()) == df.count()
    alone = Q.fit(df, labels, rows=3)
    assert alone.weights.shape == (Q.WIDTH,)


def test_batches_do_not_change_scores():
    texts = [t.encode() for t in TEXTS if t is not None]
    rng = np.random.default_rng(2)
    model = Q.Machine(0.1, rng.normal(size=Q.WIDTH), rng.normal(size=(Q.WIDTH, Q.FACTORS)))
    size = np.full(len(texts), 5.0)
    whole = model.score(Q.featurise(texts, size))
    assert np.allclose(whole, [model.score(Q.featurise([t], size[:1]))[0] for t in texts])
