"""URL filter, byte-pair encoding, token counts: against brute force and the libraries."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from cases import CLASHES, TEXTS, no_rows, odd_rows
from conftest_sf import SF_SMALL, table
from pyspark.sql import functions as F

from payerlake.llm.bpe import LONG, WINDOW, BytePairs, encode_decode
from payerlake.llm.queries import QUERIES, SQL, URL_RULES
from payerlake.llm.token_counts import Lengths, count_tokens
from payerlake.llm.url_filter import RuleTrie, judge_urls

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def longest_rule(host, path, rules):
    fits = [(len(r), v, r) for v, r in rules for h, p in [r.split("/", 1)]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[2] if fits else None


URLS = ["http://Example.COM/en/x?q", "https://a.b.www.example.com/en/", "http://www.example.com/english", "http://x.net/es",
        "http://x.net/fr/1#/es/", "ftp://com", "http://com/", "no scheme example.com/en/", "://net/fr/", None, "",
        "http://notexample.com/en/", "http://example.com?x=/en/", "http://u@example.com:80/en/", "a://b://c.com/"]


def test_urls_match_the_longest_rule_that_fits(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").select("*", F.lit("x").alias("rule"))
    for r in judge_urls(df.unionAll(df), URL_RULES).collect():
        url = URLS[r.page_id] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        tail = rest[cut:]
        assert r.host == rest[:cut].translate({i: i + 32 for i in range(65, 91)})
        assert r.path == tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        assert r.rule == longest_rule(r.host, r.path, URL_RULES), url
        assert r.verdict == {x: v for v, x in URL_RULES}.get(r.rule, "allow")
    assert judge_urls(df.limit(0), URL_RULES).count() == 0


def test_more_rules_than_a_block(spark, monkeypatch):
    monkeypatch.setattr("payerlake.llm.url_filter.BLOCK", 2)
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    whole = RuleTrie(URL_RULES)
    for r in judge_urls(df, URL_RULES).collect():
        found = whole.match(r.host, r.path)
        assert r.rule == (found[3] if found else None)


def test_rules_without_path_and_ties():
    trie = RuleTrie([("allow", "a.b"), ("block", "a.b"), ("block", "b/x")])
    assert trie.match("a.b", "")[3:] == ("a.b", "block")
    assert trie.match("c.b", "/xyz")[3] == "b/x"
    assert trie.match("c.b", "") is None


def test_url_query_equals_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS FROM '{SF_SMALL}/pages.parquet'")
    want = con.sql(SQL["op1_url_filter"]).fetchall()
    got = QUERIES["op1_url_filter"](spark, SF_SMALL).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_bpe_equals_the_library(spark, library):
    runs = ["a" * 3001, "ab" * 300, "=" * (LONG + 1), " " * 77 + "x", "aaaaabaaaab" * 20, "<|endoftext|> \n\n x  ", "x1²½ 's I'll"]
    texts = TEXTS + runs
    rows = encode_decode(odd_rows(spark, texts), RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        t = "no key" if r.doc_id is None else TEXTS[5] if r.doc_id > len(texts) else texts[r.doc_id] or ""
        assert list(r.ids) == library.encode_ordinary(t)
        assert bytes(r.decoded) == t.encode()
    assert encode_decode(no_rows(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_long_words_in_windows_equal_the_library(library):
    """Random letters, periods of all phases, letters of several bytes; a word of 200,000 letters."""
    rng, pairs = random.Random(5), BytePairs(RANKS)
    words = ["".join(rng.choices(letters, k=k)) for letters, k in (
        ("abcdefghijklmnopqrstuvwxyz", 200_000), ("ACGT", 20_000), ("漢字仮名交文", 3_000), ("กขคงจ", 3_000), ("ab", 5_000))]
    words += [("abcdefg" * WINDOW)[:n] for n in (WINDOW, WINDOW + 1, 2 * WINDOW - 1, 5 * WINDOW + 3)]
    words += ["a" * 20_001, "aaaaabaaaab" * 1_000, "=" * 3_333, "the" * 100 + "q" * 300 + "interna" * 50]
    for word, ids in zip(words, pairs.windows([w.encode() for w in words]), strict=True):
        assert ids.tolist() == library.encode_ordinary(word)


def test_windows_without_a_common_token_become_one(library, monkeypatch):
    monkeypatch.setattr("payerlake.llm.bpe.WINDOW", 4)
    words = ["internationalization" * 5, "a" * 101, "=" * 77, "漢字" * 20]
    for word, ids in zip(words, BytePairs(RANKS).windows([w.encode() for w in words]), strict=True):
        assert ids.tolist() == library.encode_ordinary(word)


def test_bpe_query_round_trip(spark, library):
    texts = dict(table("documents", "doc_id, text"))
    got = QUERIES["op2_bpe"](spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_token_counts_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [*TEXTS, "▁a ▁▁ b▁", "a\n\nb c  d\n e</s> <s>x\x00", "  \n ", " \n", "x\r\ny\u00a0z\u2003", "<0x0A>"]
    rows = count_tokens(odd_rows(spark, texts), PIECES, limit=100).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        t = "no key" if r.doc_id is None else TEXTS[5] if r.doc_id > len(texts) else texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), len(library.encode(t)))
        assert r.over_limit == (r.n_tokens > 100)
    assert count_tokens(no_rows(spark), PIECES).count() == 0
    assert not set(CLASHES) & set(count_tokens(no_rows(spark), PIECES).columns)


def test_token_tables_only_save_work():
    texts = [t for _, t in table("documents", "doc_id, text")][:60]
    lengths = Lengths(PIECES)
    plain = lengths.counts(texts, {})
    words = sorted({w for t in texts for w in lengths.pretokens(t)})[::3]
    assert Lengths(PIECES).counts(texts, dict(zip(words, lengths.encode(words), strict=True))) == plain
