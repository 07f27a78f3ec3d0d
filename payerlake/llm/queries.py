"""Query keys of this subpackage: each applies one operator to its whole table.

``QUERIES`` maps a key to a builder ``(spark, sf_dir) -> DataFrame``; ``SQL`` holds DuckDB
equivalents where SQL can express the operator. The others are tested against brute force,
exact round trips or held-out rows in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(build):
        QUERIES[key] = build
        if sql:
            SQL[key] = sql
        return build
    return deco


# The rules op1 judges by.
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/"))

URL_SQL = """
WITH split AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split),
ruled AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@query("op1_url_filter", URL_SQL)
def op1_url_filter(spark, sf_dir):
    from .url_filter import judge_urls
    return judge_urls(read_table(spark, sf_dir, "pages", ["page_id", "url"]), URL_RULES)


def _hex_sha256(c):
    return F.sha2(c.cast("binary"), 256)


def digest_tokens(encoded: DataFrame) -> DataFrame:
    """The digest columns of op2 from the operator's ids and bytes."""
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          _hex_sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op2_bpe")
def op2_bpe(spark, sf_dir):
    import public_tokenizers

    from .bpe import encode_decode
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return digest_tokens(encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                       public_tokenizers.PATTERN))


@query("op4_token_counts")
def op4_token_counts(spark, sf_dir):
    import public_tokenizers

    from .token_counts import count_tokens
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query("op5_near_dedup")
def op5_near_dedup(spark, sf_dir):
    from .near_dedup import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


LINE_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
common AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT doc_id, line, pos, coalesce(doc_id <> last, false) AS dropped FROM keyed LEFT JOIN common USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op7_line_dedup", LINE_SQL)
def op7_line_dedup(spark, sf_dir):
    from .line_dedup import drop_lines
    kept = drop_lines(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return kept.select("doc_id", "n_lines", "n_dropped", _hex_sha256(F.col("text")).alias("kept_sha256"))


@query("op3_decontaminate")
def op3_decontaminate(spark, sf_dir):
    from .decontaminate import find_leaks
    return find_leaks(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                      read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def _remainder(key: str, by: int):
    """crc32 of the key as text, mod by; null keys have none."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(by))


@query("op8_language_id")
def op8_language_id(spark, sf_dir):
    from .language_id import fit, identify
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    held_out = F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False))
    net = fit(docs.filter(~held_out), "doc_id", "text", "lang")
    return (identify(docs, net, carry=held_out)
            .select("doc_id", F.col("carried").alias("held_out"), "lang_pred", "score"))


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    from .toxicity import learn, score_texts
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    held_out = F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False))
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]).filter(~held_out)
    return (score_texts(docs, learn(docs, labels), carry=held_out)
            .select("doc_id", F.col("carried").alias("held_out"), "score", "predicted"))


@query("op9_quality_rules")
def op9_quality_rules(spark, sf_dir):
    from .quality import judge
    return judge(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]))


@query("op6_secret_scan")
def op6_secret_scan(spark, sf_dir):
    from .secrets import KINDS, find_secrets, listed
    found = find_secrets(read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"]))
    base = F.filter("findings", lambda f: f["rank"] < len(KINDS))

    def count(kind: str):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), _hex_sha256(listed(base)).alias("base_sha256"),
                        listed(F.col("findings")).alias("spans"))


def planted_words(docs: DataFrame) -> DataFrame:
    """doc_id and the words op12 works on: in one text of ten those from place a on repeat with period p."""
    from .periodic_runs import words_of
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    parts = (docs.select("doc_id", words_of().alias("words"), h.alias("h"))
             .select("doc_id", "words", "h", F.expr("h div 10").alias("g"), F.size("words").alias("n"))
             .withColumn("a", F.expr("CAST(g % greatest(n, 1) AS INT)"))
             .withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)")))
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.flatten(F.array_repeat(period, F.expr("CAST((n - a + p - 1) div p AS INT)")))
    turned = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.col("n") - F.col("a")))
    return parts.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), turned)
                        .otherwise(F.col("words")).alias("words"))


# DuckDB has no crc32; the fold takes a byte, or a shift (-1) eight times after each.
RUNS_SQL = """
WITH hashed AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
           string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda c, t: CASE WHEN t >= 0 THEN xor(c, t) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) AS h
  FROM documents),
sized AS (SELECT doc_id, w, h, len(w) AS n, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a FROM hashed),
docs AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n),
           lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END)
         ELSE w END AS w
  FROM sized),
grams AS (
  SELECT doc_id, n, unnest(range(15, n)) AS i, unnest(list_transform(range(15, n), lambda i: hash(w[i - 14:i + 1]))) AS gram
  FROM docs WHERE n >= 24),
pairs AS (
  SELECT b.doc_id, b.i - a.i AS d, b.i AS i
  FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.gram = b.gram AND a.i < b.i AND 3 * (b.i - a.i) <= b.n),
diagonals AS (
  SELECT doc_id, d, min(i) - 15 - d AS s, max(i) AS e
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island FROM pairs)
  GROUP BY doc_id, d, island),
runs AS (
  SELECT doc_id, s, e - s + 1 AS l, min(d) AS q FROM diagonals
  WHERE e - s + 1 >= greatest(24, 3 * d) GROUP BY doc_id, s, e),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS text
  FROM runs GROUP BY doc_id),
best AS (
  SELECT a.doc_id, a.s, a.l, a.q,
         row_number() OVER (PARTITION BY a.doc_id ORDER BY (a.l * 1000000000) // a.q DESC, a.s, a.q) AS place
  FROM runs a),
dropped AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM docs),
collapsed AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS text
  FROM words LEFT JOIN dropped ON words.doc_id = dropped.doc_id AND words.i = dropped.i
  WHERE dropped.i IS NULL GROUP BY words.doc_id)
SELECT docs.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length,
       best.q::BIGINT AS period, (best.l * 1000 // best.q)::BIGINT AS exponent_milli,
       sha256(coalesce(listed.text, '')) AS runs_sha256, sha256(coalesce(collapsed.text, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (doc_id) LEFT JOIN (SELECT * FROM best WHERE place = 1) best USING (doc_id)
LEFT JOIN collapsed USING (doc_id)
"""


def digest_runs(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The digest columns of op12 from the operator's runs and collapsed text."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.reduce("runs", none, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    listed = F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n"))))
    return (found.select(key, F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                         _hex_sha256(listed).alias("runs_sha256"), _hex_sha256(F.col("collapsed")).alias("collapsed_sha256"))
            .select(key, "n_runs", "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"))


@query("op12_periodic_runs", RUNS_SQL)
def op12_periodic_runs(spark, sf_dir):
    from .periodic_runs import periodic_runs
    docs = planted_words(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return digest_runs(periodic_runs(docs, "doc_id", F.col("words")))


@query("op13_quality_model")
def op13_quality_model(spark, sf_dir):
    from .quality_model import fit, score_quality
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "n_chars"])
    held_out = F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False))
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"]).filter(~held_out)
    return (score_quality(docs, fit(docs, labels), carry=held_out)
            .select("doc_id", F.col("carried").alias("held_out"), "score", "predicted"))


NEGATIVES_SQL = """
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.id % 100 = 0 AND r.id <> a.id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
 AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 5
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11_hard_negatives(spark, sf_dir):
    from .hard_negatives import hard_negatives
    rows = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, label=moved)
