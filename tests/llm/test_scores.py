"""Quality rules, language, toxicity: brute force, planted rows and held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import TEXTS, WORD, no_rows, odd_rows
from conftest_sf import SF_CHECK, SF_SMALL, table
from pyspark.sql import functions as F

from payerlake.llm import language_id, toxicity
from payerlake.llm.quality import CLASSES, judge, keep_good, word_distance
from payerlake.llm.queries import QUERIES

RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def rules_by_hand(t):
    w = WORD.findall(t or "")
    n = len(w)
    windows = [tuple(w[i:i + 8]) for i in range(n - 7)]
    seen = Counter(windows)
    covered = {j for i, x in enumerate(windows) if seen[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def test_rules_equal_brute_force(spark):
    rng = random.Random(2)
    texts = [*TEXTS, *(" ".join(rng.choice("abc") for _ in range(n)) for n in (7, 8, 9, 16, 60, 200)),
             " ".join(f"w{i % 50}" for i in range(130)), "x\nx\n \ny\nx y\n\n" * 5, "a b c d e f g h a b c d e f g h"]
    df = odd_rows(spark, texts)
    by_id = {r.doc_id: r.text for r in df.collect()}
    got = judge(df).collect()
    assert len(got) == df.count()
    for r in got:
        assert tuple(r[n] for n in RULES) == rules_by_hand(by_id[r.doc_id])
        assert not (r.base_failed and r.kept)
    assert judge(no_rows(spark)).count() == 0
    good = keep_good(df)
    assert good.columns == df.columns and good.count() == sum(r.kept for r in got)


def test_quality_query_keeps_good_documents(spark):
    texts, quality = dict(table("documents", "doc_id, text")), dict(table("labels", "doc_id, quality"))
    got = QUERIES["op9_quality_rules"](spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r[n] for n in RULES) == rules_by_hand(texts[r.doc_id])
        if quality.get(r.doc_id) == 1 and not r.base_failed and r.n_words >= 50:
            assert r.kept
    bad = [r for r in got if quality.get(r.doc_id) == 0 and not r.base_failed]
    assert not bad or any(not r.kept for r in bad)


def test_texts_unlike_every_reference_go(spark):
    plain = "The river was wide, and the boat went over it in the morning to the town that is on the other side. " * 6
    rows = [(i, plain + str(i), "en") for i in range(20)] + [(100, "@@## || 00 == ++ <> 99 " * 40, None),
                                                             (101, "THE @ OF @ " * 3, None)]
    rows = [(d, " ".join(f"{w}{k % 9 if d == 100 else ''}" for k, w in enumerate(t.split())), lang) for d, t, lang in rows]
    got = {r.doc_id: r for r in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[100].class_distance > 0.5 and not got[100].kept
    assert all(got[i].class_distance < 0.05 and got[i].word_distance < 0.05 for i in range(20))


def test_long_texts_without_function_words_go(spark):
    plain = "The river was wide, and the boat went over it in the morning to the town that is on the other side. "
    names = [a + b for a in ("Riv", "Bo", "Morn", "Tow", "Sid", "Wid") for b in ("er", "at", "ing", "el", "en", "ol", "us")]
    rng = random.Random(8)
    rows = [(i, plain + str(i), "en") for i in range(20)]
    rows += [(100 + i, " ".join(rng.choice(names).lower() + rng.choice(["", "", "", ",", "."]) for _ in range(n)), None)
             for i, n in enumerate((200, 1200))]
    rows += [(200, plain, None)]  # short, and plain
    got = {r.doc_id: r for r in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for i in (100, 101):
        assert not got[i].base_failed and got[i].class_distance < 0.3
        assert got[i].word_distance > 0.4 and not got[i].kept
    assert all(got[i].kept for i in (*range(20), 200))


def test_distances_equal_the_formula(spark):
    rng = np.random.default_rng(3)
    p, q = rng.random(3), rng.random(4)
    words = {w: float(x) for w, x in zip("abcd", q / q.sum(), strict=True)}
    counts = [int(x) for x in p * 100] + [7]
    df = spark.createDataFrame([((["a", "b", "c", "z"], counts),)], "common struct<words:array<string>,counts:array<long>>")
    got = df.select(word_distance(F.col("common"), words)).first()[0]
    a = np.array([*counts[:3], 0, counts[3]]) / sum(counts)
    b = np.array([*words.values(), 0])
    m = (a + b) / 2
    want = sum(x * math.log2(x / y) for v in (a, b) for x, y in zip(v, m, strict=True) if x > 0) / 2
    assert got == pytest.approx(math.sqrt(want))
    assert len(CLASSES) == 6


def test_language_of_held_out_rows(spark):
    lang = dict(table("documents", "doc_id, lang", SF_CHECK))
    got = QUERIES["op8_language_id"](spark, SF_CHECK).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_of_odd_rows(spark):
    df = odd_rows(spark)
    got = language_id.identify(df, language_id.fit(df, "doc_id", "text", "lang")).collect()
    assert len(got) == df.count()
    for r in got:
        unknown = r.doc_id in (0, 1, 2, 3)
        assert (r.lang_pred == "und") == unknown and (r.score == 0) == unknown
    assert language_id.fit(no_rows(spark), "doc_id", "text", "lang") is None
    assert {r.lang_pred for r in language_id.identify(df, None).collect()} == {"und"}


def test_network_gradients():
    rng = np.random.default_rng(4)
    net = language_id.ByteNet.new(["a", "b", "c"], rng)
    windows, labels = rng.integers(1, 255, (6, 40)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])
    for a in ("embed", "filters", "bias", "out", "out_bias"):
        setattr(net, a, getattr(net, a).astype(np.float64))

    def loss():
        p = net.patches(windows)
        h = np.maximum(net.maxima(p).reshape(*p.shape[:2], -1).max(axis=1) + net.bias, 0)
        return -language_id.log_softmax(h @ net.out + net.out_bias)[np.arange(6), labels].mean()
    grads = net.gradients(windows, labels, np.ones(6))
    for param, grad in zip((net.embed, net.filters, net.out), (grads[0], grads[1], grads[3]), strict=True):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        old, eps = param[at], 1e-5
        param[at] = old + eps
        up = loss()
        param[at] = old - eps
        down = loss()
        param[at] = old
        assert grad[at] == pytest.approx((up - down) / (2 * eps), rel=1e-2)
    assert np.allclose(np.exp(net.log_odds(windows)).sum(axis=1), 1, atol=1e-4)


def edits(a, b, stem=False):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distances():
    rng = random.Random(6)
    terms = ["idiot", "scum", "pathetic", "moron", "clown"]
    found = toxicity.Automaton([(t, False) for t in terms])
    words = [w for t in terms for w in (t, t[1:], t + "s", "x" + t, t[:2] + "0" + t[3:], t[:2] + t[3:], t + "ss", t[::-1])]
    words += ["".join(rng.choice("idotscumprnlwahe") for _ in range(rng.randrange(1, 9))) for _ in range(3000)] + [""]
    for w, got in zip(words, found.find(words), strict=True):
        near = [(edits(w, t), -len(t), i) for i, t in enumerate(terms) if edits(w, t) <= (len(t) >= toxicity.EDITS_FROM)]
        assert (got >= 0) == bool(near), w
        if near:
            assert got % 2 == min(near)[0] and edits(w, terms[got // 2]) == min(near)[0]


def test_stems_match_what_begins_with_them():
    found = toxicity.Automaton([("stem", True), ("whole", False)])
    assert [x // 2 if x >= 0 else -1 for x in found.find(["stem", "stemming", "ste", "wholesome", "whole", "a" * 90])] == [0, 0, -1, -1, 1, -1]


def test_quotation_and_address():
    words = 'He said "you are an idiot indeed" and left . I think that all of them saw an idiot'.split()
    assert toxicity.context(words, 5) == (True, True)
    assert toxicity.context(words, len(words) - 1) == (False, False)
    model = toxicity.Scorer(toxicity.Automaton([("idiot", False)]), np.array([3.0, 1.5]), toxicity.PRIOR, -3.0)
    own, quoted = "what an idiot this is", 'the report said "idiot" was used'
    score = [model.score(np.array([model.features(t.split(), toxicity.find_hits(model.automaton, [t.split()])[0])]))[0]
             for t in (own, quoted, "what a day")]
    assert score[0] > score[1] > score[2] or score[0] > score[1] >= score[2]


def test_toxicity_of_held_out_rows(spark):
    toxic = dict(table("labels", "doc_id, toxic", SF_CHECK))
    got = {r.doc_id: r for r in QUERIES["op10_toxicity"](spark, SF_CHECK).collect()}
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    held = [(r, toxic[d]) for d, r in got.items() if r.held_out and d in toxic]
    caught = [r.predicted for r, t in held if t]
    false = [r.predicted for r, t in held if not t]
    assert sum(caught) >= 0.7 * len(caught) and sum(false) <= 0.03 * len(false)


def test_toxicity_of_odd_rows(spark):
    df = odd_rows(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None), (77, 1)], "doc_id long, toxic int")
    for model in (toxicity.learn(df, labels), toxicity.learn(no_rows(spark), labels), toxicity.learn(df, labels.limit(0))):
        got = toxicity.score_texts(df, model).collect()
        assert len(got) == df.count() and all(r.predicted == 0 for r in got)
    assert toxicity.score_texts(no_rows(spark), model).count() == 0
