"""Independent DuckDB SQL for every comparable query key.

The Spark side is written with the DataFrame API; these strings restate
each query in plain SQL over the same parquet views, so a match is a real
cross-check.  DuckDB turns decimal division and ``avg`` into DOUBLE, so
every rounded ratio here is computed with exact integer half-up arithmetic
(``_half_up``); that equals Spark's decimal rounding.
"""

from __future__ import annotations

from ..config import FIXTURE, PipelineConfig
from ..functions import rules as R

# ---------------------------------------------------------------- helpers


def _half_up(num: str, den: str) -> str:
    """round-half-away-from-zero of num/den for integers, den > 0."""
    return (f"(CASE WHEN ({num}) < 0 THEN -((2 * (-({num})) + ({den})) // (2 * ({den}))) "
            f"ELSE (2 * ({num}) + ({den})) // (2 * ({den})) END)")


def _cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def avg2(x: str, t: str = "DECIMAL(10,2)") -> str:
    """round(avg(decimal(.,2) x), 2) exactly."""
    n = f"NULLIF(count({x}), 0)"
    return f"CAST(CAST({_half_up(f'sum({_cents(x)})', n)} AS DECIMAL(38,0)) * 0.01 AS {t})"


def rate(cond: str, t: str = "DECIMAL(5,2)") -> str:
    """round(count_if(cond) * 100.0 / count(*), 2) exactly."""
    k = f"CAST(count_if({cond}) AS HUGEINT)"
    return f"CAST(CAST({_half_up(f'10000 * {k}', 'CAST(count(*) AS HUGEINT)')} AS DECIMAL(38,0)) * 0.01 AS {t})"


def pct_of(part: str, whole: str, t: str = "DECIMAL(5,2)") -> str:
    """round(part * 100.0 / whole, 2) for integer part/whole; NULL when whole = 0."""
    return (f"CAST(CAST({_half_up(f'10000 * CAST({part} AS HUGEINT)', f'NULLIF(CAST({whole} AS HUGEINT), 0)')}"
            f" AS DECIMAL(38,0)) * 0.01 AS {t})")


def ratio_e13(paid: str, billed: str) -> str:
    """paid / billed * 100 at scale 13 (Spark's decimal(10,2)/decimal(10,2)) as an integer."""
    return f"({_half_up(f'{_cents(paid)} * 10000000000000', _cents(billed))} * 100)"


def avg_e13(x: str, t: str = "DECIMAL(5,2)") -> str:
    """round(avg(v * 1e-13), 2) for an integer column v."""
    den = f"(NULLIF(count({x}), 0) * CAST(100000000000 AS HUGEINT))"
    return f"CAST(CAST({_half_up(f'sum({x})', den)} AS DECIMAL(38,0)) * 0.01 AS {t})"


def avg1_int(x: str, t: str = "DECIMAL(7,1)") -> str:
    """round(avg(integer x), 1)."""
    return (f"CAST(CAST({_half_up(f'10 * sum(CAST({x} AS HUGEINT))', f'NULLIF(count({x}), 0)')}"
            f" AS DECIMAL(38,0)) * 0.1 AS {t})")


def months_between_int(mx: str, mn: str) -> str:
    """CAST(months_between(mx, mn) AS INT) for dates, Spark's definition."""
    whole = f"((year({mx}) - year({mn})) * 12 + month({mx}) - month({mn}))"
    frac = (f"(CASE WHEN day({mx}) = day({mn}) OR ({mx} = last_day({mx}) AND {mn} = last_day({mn})) "
            f"THEN 0 ELSE (day({mx}) - day({mn})) / 31.0 END)")
    return f"CAST(trunc({whole} + {frac}) AS INTEGER)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _date(d) -> str:
    return f"DATE '{d.isoformat()}'"


# ---------------------------------------------------------------- claims

CLAIMS_CTE = """
cl_base AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_extendedprice, l.l_discount, l.l_tax,
         l.l_returnflag, l.l_linestatus, o.o_custkey, c.c_mktsegment,
         CAST(o.o_orderdate AS DATE) AS od,
         CAST(l.l_partkey AS INTEGER) AS pk, CAST(l.l_quantity AS INTEGER) AS q
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
),
cl_s1 AS (
  SELECT *,
    CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'payer_a'
         WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'payer_b'
         ELSE 'payer_c' END AS payer_name,
    CASE WHEN l_returnflag = 'A' THEN 'Approved' WHEN l_returnflag = 'R' THEN 'Denied'
         WHEN l_linestatus = 'F' THEN 'Pending' ELSE 'Under Review' END AS claim_status,
    CASE WHEN l_linenumber = 7 THEN od + (pk % 120) ELSE od - (pk % 46) END AS sfrom,
    CASE WHEN pk % 83 = 0 THEN CAST(0 AS DECIMAL(10,2))
         ELSE CAST(l_extendedprice AS DECIMAL(10,2)) END AS billed
  FROM cl_base
),
cl_s2 AS (
  SELECT *,
    CASE WHEN claim_status <> 'Approved' THEN CAST(0 AS DECIMAL(10,2))
         WHEN pk % 79 = 0 THEN CAST(billed + 1 AS DECIMAL(10,2))
         ELSE CAST(billed * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(10,2)) END AS allowed
  FROM cl_s1
),
claims AS (
  SELECT
    payer_name || '-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS claim_id,
    CASE WHEN pk % 103 = 0 THEN NULL ELSE 'PAT' || CAST(o_custkey AS VARCHAR) END AS patient_id,
    CAST(l_suppkey AS VARCHAR) AS provider_id,
    od AS claim_date,
    sfrom AS service_from_date,
    sfrom + (q - 2) AS service_to_date,
    CASE WHEN l_linenumber = 1 THEN sfrom END AS admission_date,
    CASE WHEN l_linenumber = 1 THEN sfrom + (q % 11 - 1) END AS discharge_date,
    CASE WHEN pk % 101 = 0 THEN NULL
         WHEN pk % 97 = 0 THEN 'E1'
         ELSE substr('ACEFIJKMNZ', pk % 10 + 1, 1) || lpad(CAST(pk % 100 AS VARCHAR), 2, '0')
              || CASE WHEN pk % 3 = 0 THEN '' ELSE '.' || CAST(pk % 10 AS VARCHAR) END
    END AS diagnosis_code,
    CASE WHEN pk % 89 = 0 THEN '12' WHEN pk % 20 = 0 THEN 'G0438'
         ELSE CAST(90000 + pk % 25 AS VARCHAR) END AS procedure_code,
    billed AS billed_amount,
    allowed AS allowed_amount,
    CASE WHEN claim_status <> 'Approved' OR pk % 71 = 0 THEN CAST(0 AS DECIMAL(10,2))
         WHEN pk % 73 = 0 THEN CAST(allowed + 1 AS DECIMAL(10,2))
         ELSE CAST(allowed * (1 - CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(10,2)) END AS paid_amount,
    claim_status,
    CASE WHEN l_linenumber = 1 THEN 'Inpatient' ELSE 'Outpatient' END AS claim_type,
    payer_name,
    od + q AS processing_date,
    l_orderkey
  FROM cl_s2
)"""

CLAIM_COLS = ("claim_id, patient_id, provider_id, claim_date, service_from_date, service_to_date, "
              "admission_date, discharge_date, diagnosis_code, procedure_code, billed_amount, "
              "allowed_amount, paid_amount, claim_status, claim_type, payer_name, processing_date")


def _nonnull(items: list[str]) -> str:
    return f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"


def family_sql(family: str, cfg: PipelineConfig = FIXTURE) -> list[str]:
    if family == "required":
        missing = _nonnull([f"CASE WHEN {f} IS NULL THEN {_q(f)} END" for f in R.REQUIRED_FIELDS])
        return [f"CASE WHEN len({missing}) > 0 THEN {_q(R.REQUIRED_FIELD_NULL)} || "
                f"array_to_string({missing}, ', ') END"]
    if family == "amounts":
        return [
            f"CASE WHEN billed_amount < 0 OR (billed_amount = 0 AND claim_status <> 'Denied') "
            f"THEN {_q(R.INVALID_BILLED_AMOUNT)} END",
            f"CASE WHEN allowed_amount > billed_amount THEN {_q(R.ALLOWED_OVER_BILLED)} END",
            f"CASE WHEN paid_amount > allowed_amount THEN {_q(R.PAID_OVER_ALLOWED)} END",
        ]
    if family == "dates":
        return [
            f"CASE WHEN claim_date > {_date(cfg.as_of)} THEN {_q(R.FUTURE_CLAIM_DATE)} END",
            f"CASE WHEN claim_date < {_date(cfg.min_claim_date)} THEN {_q(R.CLAIM_DATE_TOO_OLD)} END",
            f"CASE WHEN datediff('day', service_from_date, claim_date) < -{cfg.late_days} "
            f"THEN {_q(R.SERVICE_TOO_FAR_AFTER_CLAIM)} END",
            f"CASE WHEN service_to_date < service_from_date THEN {_q(R.SERVICE_DATE_RANGE_INVALID)} END",
            f"CASE WHEN discharge_date < admission_date THEN {_q(R.DISCHARGE_BEFORE_ADMISSION)} END",
        ]
    if family == "codes":
        return [
            f"CASE WHEN NOT regexp_full_match(diagnosis_code, {_q(R.ICD10_PATTERN)}) "
            f"THEN {_q(R.INVALID_ICD10_FORMAT)} END",
            f"CASE WHEN NOT regexp_full_match(procedure_code, {_q(R.CPT_PATTERN)}) "
            f"THEN {_q(R.INVALID_CPT_FORMAT)} END",
        ]
    if family == "approved":
        return [f"CASE WHEN claim_status = 'Approved' AND (paid_amount IS NULL OR paid_amount = 0) "
                f"THEN {_q(R.APPROVED_WITH_ZERO_PAYMENT)} END"]
    raise KeyError(family)


def reasons_sql(families=R.REASON_FAMILIES, cfg: PipelineConfig = FIXTURE) -> str:
    items: list[str] = []
    for f in families:
        items.extend(family_sql(f, cfg))
    return _nonnull(items)


def silver_ctes(cfg: PipelineConfig = FIXTURE) -> str:
    return (CLAIMS_CTE + f""",
flagged AS (SELECT *, {reasons_sql(cfg=cfg)} AS rejection_reasons FROM claims),
silver AS (
  SELECT {CLAIM_COLS}, strftime(claim_date, '%Y-%m') AS year_month
  FROM flagged WHERE len(rejection_reasons) = 0
),
quarantine AS (SELECT * FROM flagged WHERE len(rejection_reasons) > 0)""")


def with_silver(body: str, cfg: PipelineConfig = FIXTURE) -> str:
    return "WITH " + silver_ctes(cfg) + "\n" + body


WIRE_CTE = """,
wire AS (
  SELECT claim_id, patient_id, provider_id, claim_date, service_from_date,
    CASE WHEN payer_name = 'payer_b' THEN service_from_date ELSE service_to_date END AS service_to_date,
    CASE WHEN payer_name = 'payer_b' THEN admission_date END AS admission_date,
    CASE WHEN payer_name = 'payer_b' THEN discharge_date END AS discharge_date,
    diagnosis_code, procedure_code, billed_amount, allowed_amount, paid_amount,
    claim_status, claim_type, payer_name, processing_date, l_orderkey
  FROM claims
)"""


def with_wire(body: str, cfg: PipelineConfig = FIXTURE) -> str:
    return "WITH " + silver_ctes(cfg) + WIRE_CTE + "\n" + body


def wire_silver_ctes(cfg: PipelineConfig = FIXTURE, load_date: str | None = None) -> str:
    """Silver built from the wire feeds: rules run on what the feeds carry."""
    pd = load_date or _date(cfg.as_of)
    return ("WITH " + silver_ctes(cfg) + WIRE_CTE + f""",
wflagged AS (SELECT * REPLACE ({pd} AS processing_date), {reasons_sql(cfg=cfg)} AS rejection_reasons FROM wire),
wsilver AS (SELECT * EXCLUDE (rejection_reasons) FROM wflagged WHERE len(rejection_reasons) = 0),
wquarantine AS (SELECT * FROM wflagged WHERE len(rejection_reasons) > 0)""")


def avg_dec(x: str, in_scale: int, out_scale: int, t: str) -> str:
    """round(avg(decimal x with in_scale), out_scale) exactly."""
    s = f"sum(CAST(({x}) * {10 ** in_scale} AS HUGEINT))"
    n = f"NULLIF(count({x}), 0)"
    if out_scale <= in_scale:
        hu = _half_up(s, f"({n} * {10 ** (in_scale - out_scale)})")
    else:
        hu = _half_up(f"{s} * {10 ** (out_scale - in_scale)}", n)
    return f"CAST(CAST({hu} AS DECIMAL(38,0)) * {1 / 10 ** out_scale if out_scale else 1} AS {t})"


# Integer-valued columns that oracle queries sum (DuckDB widens those sums to HUGEINT).
_INT_SUM_ARGS = ("total_claims", "claims_approved", "total_submitted", "approved_count", "denied_count",
                 "pending_count", "record_count", "accepted", "quarantined", "claims", "approved",
                 "records_read", "records_accepted", "records_quarantined")


def _wrap_calls(sql: str, fn: str, cast: str) -> str:
    """Wrap every ``fn(...)`` call in ``CAST(... AS cast)`` (balanced parentheses)."""
    out, i, token = [], 0, fn + "("
    while True:
        j = sql.find(token, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(token)])
            i = j + len(token)
            continue
        depth, k = 0, j + len(fn)
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _wrap_calls(sql[j + len(token):k], fn, cast)
        out.append(sql[i:j] + f"CAST({fn}({inner}) AS {cast})")
        i = k + 1


def normalize_types(sql: str) -> str:
    """Make DuckDB return BIGINT where Spark returns bigint (count_if, integer sums)."""
    sql = _wrap_calls(sql, "count_if", "BIGINT")
    for c in _INT_SUM_ARGS:
        sql = sql.replace(f"sum({c})", f"CAST(sum({c}) AS BIGINT)")
    return sql
