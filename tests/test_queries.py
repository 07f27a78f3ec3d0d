"""Registered queries against the DuckDB oracle (a representative subset on
the small tables; ``tools/oracle_check.py`` runs every key at sf0.01)."""

import datetime as dt
import decimal
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from payerlake.sources.tables import TABLES, table_path

from conftest import SF_SMALL

KEYS = ["claims_view", "rejection_reasons", "valid_rows", "quarantine_rows", "gold_monthly_summary",
        "gold_funnel", "gold_provider", "std_all", "rpt_status_share", "rpt_rejection_reasons",
        "rpt_quality_grade", "gate_quarantine_rate", "affected_months", "gold_monthly_incremental",
        "reconcile_monthly", "dedup_claims", "vector_topk", "claims_by_term", "approval_anomalies",
        "payer_rank", "claims_star", "mask_patients"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


def norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "approval_rate" in df.columns


def test_every_key_has_builder_and_sql_is_subset():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 80


@pytest.mark.parametrize("key", KEYS)
def test_against_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    a = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    b = Counter(tuple(norm(v) for v in (dict(zip(rel.columns, r))[c] for c in cols)) for r in rel.fetchall())
    assert a == b
