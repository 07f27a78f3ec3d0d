"""Keys for the operators of the design documents (§2.13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analytics as A
from ..operators import retrieval
from ..sources.claims_fixture import CLAIM_COLUMNS, claims_table
from ..sources.tables import read_table
from . import oracle as O
from .queries_core import CFG, with_gold
from .queries_reports import monthly, silver
from .registry import register

# ------------------------------------------------------------------ dedup

_KEYS = ["payer_name", "claim_id"]
_ORDER = ["processing_date"] + [c for c in CLAIM_COLUMNS if c not in _KEYS and c != "processing_date"]

register("dedup_claims", O.with_silver(
    f"SELECT {O.CLAIM_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY payer_name, claim_id ORDER BY "
    + ", ".join(f"{c} DESC NULLS LAST" for c in _ORDER) + ") AS rn FROM claims) WHERE rn = 1"))(
    lambda spark, sf: A.dedup_claims(claims_table(spark, sf)))

# ------------------------------------------------------------------ retrieval

K = CFG.retrieval_k
STEP_K = 3


def _emb(spark, sf):
    return read_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])


def vector_hits(spark, sf, k):
    emb = _emb(spark, sf)
    return retrieval.cosine_topk(emb, retrieval.centroids(emb), k)


_VEC_CTES = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
dims AS (SELECT label, unnest(generate_series(1, len(v))) AS i, unnest(v) AS x FROM e),
c AS (SELECT label AS query_id, list(m ORDER BY i) AS q FROM
      (SELECT label, i, avg(x) AS m FROM dims GROUP BY label, i) GROUP BY label),
s AS (SELECT query_id, vec_id AS item_id, list_cosine_similarity(e.v, c.q) AS score FROM e, c),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM s)
"""

register("vector_topk", _VEC_CTES + (
    f"SELECT CAST(query_id AS BIGINT) AS query_id, item_id, CAST(rank AS INTEGER) AS rank, "
    f"CAST(round(score, 6) AS DECIMAL(12,6)) AS score FROM r WHERE rank <= {K}"))(
    lambda spark, sf: vector_hits(spark, sf, K).select(
        F.col("query_id").cast("bigint").alias("query_id"), "item_id", "rank",
        F.round("score", 6).cast("decimal(12,6)").alias("score")))

register("topk_rerank", _VEC_CTES + (
    f"SELECT item_id, CAST(round(max(score), 6) AS DECIMAL(12,6)) AS score, count(*) AS hits "
    f"FROM r WHERE rank <= {STEP_K} GROUP BY item_id ORDER BY max(score) DESC, item_id LIMIT {K}"))(
    lambda spark, sf: retrieval.rerank(vector_hits(spark, sf, STEP_K), K).select(
        "item_id", F.round("score", 6).cast("decimal(12,6)").alias("score"), "hits"))

# Queries that grow with the table: every row whose id is divisible by QUERY_EVERY, against all rows.
QUERY_EVERY = 20


def _queries(emb):
    return emb.filter(F.col("vec_id") % QUERY_EVERY == 0).select(
        F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("query_vec"))


_BY_ID_CTES = f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, e.vec_id AS item_id, list_cosine_similarity(e.v, q.v) AS score
      FROM e, e AS q WHERE q.vec_id % {QUERY_EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM s)
"""

register("vector_topk_by_id", _BY_ID_CTES + (
    f"SELECT query_id, item_id, CAST(rank AS INTEGER) AS rank, CAST(round(score, 6) AS DECIMAL(12,6)) AS score "
    f"FROM r WHERE rank <= {K}"))(
    lambda spark, sf: retrieval.cosine_topk(_emb(spark, sf), _queries(_emb(spark, sf)), K).select(
        "query_id", "item_id", "rank", F.round("score", 6).cast("decimal(12,6)").alias("score")))

# ------------------------------------------------------------------ glossary, cost, quarter

_GLOSS = "(VALUES " + ", ".join(f"('{t}', '{c}')" for t, c in A.GLOSSARY) + ") g(term, icd10_category)"

register("claims_by_term", O.with_silver(
    "SELECT term, icd10_category, payer_name, count(*) AS total_claims, "
    "count_if(claim_status = 'Approved') AS claims_approved, "
    f"{O.rate(chr(39).join(['claim_status = ', 'Approved', '']))} AS approval_rate, "
    "CAST(sum(billed_amount) AS DECIMAL(18,2)) AS total_billed "
    f"FROM silver JOIN {_GLOSS} ON substr(diagnosis_code, 1, 3) = g.icd10_category GROUP BY ALL"))(
    lambda spark, sf: A.claims_by_term(silver(spark, sf), A.glossary_df(spark)))

register("high_cost_claims", O.with_silver(
    "SELECT claim_id, payer_name, provider_id, diagnosis_code, claim_status, billed_amount FROM silver "
    f"WHERE billed_amount > {A.HIGH_COST_THRESHOLD} ORDER BY billed_amount DESC, claim_id, payer_name, "
    "provider_id, diagnosis_code, claim_status LIMIT 20"))(
    lambda spark, sf: A.high_cost_top(silver(spark, sf)))

register("high_cost_by_payer", O.with_silver(
    "SELECT payer_name, count(*) AS high_cost_claims, CAST(sum(billed_amount) AS DECIMAL(18,2)) AS high_cost_billed, "
    f"{O.avg2('billed_amount')} AS avg_high_cost FROM silver WHERE billed_amount > {A.HIGH_COST_THRESHOLD} "
    "GROUP BY payer_name"))(
    lambda spark, sf: A.high_cost_by_payer(silver(spark, sf)))

register("avg_by_payer_quarter", O.with_silver(
    "SELECT payer_name, CAST(year(claim_date) AS INTEGER) AS year, CAST(quarter(claim_date) AS INTEGER) AS quarter, "
    f"count(*) AS total_claims, {O.avg2('billed_amount')} AS avg_claim_amount FROM silver GROUP BY ALL"))(
    lambda spark, sf: A.avg_by_payer_quarter(silver(spark, sf)))

# ------------------------------------------------------------------ monthly series

_D = "CAST((approval_rate - prev_approval_rate) * 100 AS HUGEINT)"
_P = "CAST(prev_approval_rate * 100 AS HUGEINT)"
register("approval_change", with_gold(
    "SELECT payer_name, year_month, approval_rate, prev_approval_rate, "
    "CAST(approval_rate - prev_approval_rate AS DECIMAL(6,2)) AS change_points, "
    f"CAST(CAST({O._half_up(f'{_D} * 10000', f'NULLIF({_P}, 0)')} AS DECIMAL(38,0)) * 0.01 AS DECIMAL(12,2)) "
    "AS change_pct FROM (SELECT payer_name, year_month, approval_rate, "
    "lag(approval_rate) OVER (PARTITION BY payer_name ORDER BY year_month) AS prev_approval_rate FROM monthly)"))(
    lambda spark, sf: A.approval_change(monthly(spark, sf)))

_W = f"OVER (PARTITION BY payer_name ORDER BY year_month ROWS BETWEEN {A.TRAILING_MONTHS} PRECEDING AND 1 PRECEDING)"
_LHS = "(n_prior * xi - s1) * (n_prior * xi - s1) * (n_prior - 1)"
_RHS = f"{A.OUTLIER_SIGMAS * A.OUTLIER_SIGMAS} * n_prior * (n_prior * s2 - s1 * s1)"
_OUT = f"coalesce(n_prior >= {A.MIN_HISTORY} AND {_LHS} > {_RHS}, false)"
_DROP = f"coalesce((prev - approval_rate) * 100 > prev * {A.SHARP_DROP_PCT}, false)"
register("approval_anomalies", with_gold(
    "SELECT payer_name, year_month, approval_rate, n_prior, "
    f"CAST(CAST({O._half_up('s1', 'NULLIF(n_prior, 0)')} AS DECIMAL(38,0)) * 0.01 AS DECIMAL(5,2)) AS trailing_mean, "
    f"{_OUT} AS is_outlier, {_DROP} AS is_sharp_drop, ({_OUT}) OR ({_DROP}) AS is_anomaly FROM ("
    "SELECT payer_name, year_month, approval_rate, CAST(approval_rate * 100 AS HUGEINT) AS xi, "
    f"count(approval_rate) {_W} AS n_prior, sum(CAST(approval_rate * 100 AS HUGEINT)) {_W} AS s1, "
    f"sum(CAST(approval_rate * 100 AS HUGEINT) * CAST(approval_rate * 100 AS HUGEINT)) {_W} AS s2, "
    "lag(approval_rate) OVER (PARTITION BY payer_name ORDER BY year_month) AS prev FROM monthly)"))(
    lambda spark, sf: A.approval_anomalies(monthly(spark, sf)))

register("payer_rank", with_gold(
    "SELECT *, CAST(dense_rank() OVER (ORDER BY approval_rate DESC) AS INTEGER) AS rank_top, "
    "CAST(dense_rank() OVER (ORDER BY approval_rate ASC) AS INTEGER) AS rank_bottom FROM ("
    "SELECT payer_name, CAST(sum(total_claims) AS BIGINT) AS total_claims, "
    "CAST(sum(claims_approved) AS BIGINT) AS claims_approved, "
    f"{O.pct_of('sum(claims_approved)', 'sum(total_claims)')} AS approval_rate FROM monthly "
    f"WHERE year_month >= strftime(CAST((SELECT max(year_month) FROM monthly) || '-01' AS DATE) "
    f"- INTERVAL {A.TRAILING_MONTHS - 1} MONTH, '%Y-%m') GROUP BY payer_name)"))(
    lambda spark, sf: A.payer_rank(monthly(spark, sf)))

# ------------------------------------------------------------------ masking, star

register("mask_patients", O.with_silver(
    f"SELECT claim_id, payer_name, sha256('{CFG.mask_salt}' || patient_id) AS patient_id, provider_id, "
    "claim_date, billed_amount FROM silver"))(
    lambda spark, sf: A.mask_patients(silver(spark, sf), CFG).select(
        "claim_id", "payer_name", "patient_id", "provider_id", "claim_date", "billed_amount"))

register("claims_star", O.with_silver(
    "SELECT r_name, n_name, count(*) AS providers, CAST(sum(claims) AS BIGINT) AS total_claims, "
    "CAST(sum(billed) AS DECIMAL(18,2)) AS total_billed, CAST(sum(approved) AS BIGINT) AS claims_approved, "
    f"{O.pct_of('sum(approved)', 'sum(claims)')} AS approval_rate FROM ("
    "SELECT provider_id, count(*) AS claims, sum(billed_amount) AS billed, "
    "count_if(claim_status = 'Approved') AS approved FROM silver GROUP BY provider_id) p "
    "JOIN supplier s ON CAST(s.s_suppkey AS VARCHAR) = p.provider_id "
    "JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey "
    "GROUP BY r_name, n_name"))(
    lambda spark, sf: A.claims_star(silver(spark, sf), read_table(spark, sf, "supplier"),
                                    read_table(spark, sf, "nation"), read_table(spark, sf, "region")))
