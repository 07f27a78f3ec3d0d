"""Gold merged from partial aggregates equals gold over the claims, and reads only what changed."""

import shutil

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_files import TS1, TS2, claim_row, write_file

from payerlake.config import FIXTURE as DEFAULT
from payerlake.operators import gold as G
from payerlake.operators import gold_state, standardize as S
from payerlake.plans import bronze, gold, silver
from payerlake.plans.queries_reports import silver as silver_claims
from payerlake.session import local_path
from payerlake.sources.lake import read_silver

COLS = S.wire_columns("payer_c")


def table(df):
    return sorted(str(r) for r in df.select(*sorted(df.columns)).collect())


def test_merged_state_equals_direct_aggregates(spark):
    claims = silver_claims(spark, SF_SMALL)
    odd = claims.limit(40).withColumn("claim_type", F.lit(None).cast("string")).withColumn("paid_amount", F.lit(None).cast("decimal(10,2)"))
    claims = claims.unionByName(odd)
    state = {name: build(claims) for name, build in gold_state.TABLES.items()}
    assert table(gold_state.monthly_summary(state["measures"], state["patients"])) == table(G.monthly_summary(claims))
    assert table(gold_state.approval_funnel(state["measures"])) == table(G.approval_funnel(claims))
    got = gold_state.provider_metrics(state["measures"], state["codes"], state["patients"], DEFAULT.top_codes)
    assert table(got) == table(G.provider_metrics(claims, DEFAULT))
    for mine, direct in ((gold_state.monthly_summary(state["measures"], state["patients"]), G.monthly_summary(claims)),
                         (gold_state.approval_funnel(state["measures"]), G.approval_funnel(claims)),
                         (got, G.provider_metrics(claims, DEFAULT))):
        assert dict(mine.dtypes) == dict(direct.dtypes)


def deliver(spark, lake, name, run, ts, **changes):
    write_file(lake, f"{name}.csv", COLS, [claim_row(CLAIM_ID=name, **changes)])
    bronze.register_new_files(spark, lake, ts)
    silver.run_silver(spark, lake, run, ts, DEFAULT)


def month(m):
    return dict(RECEIVED_DT=f"2001{m:02d}01", SVC_FROM_DT=f"2001{m:02d}01", SVC_TO_DT=f"2001{m:02d}01")


def check(spark, lake):
    claims = gold.silver_for_gold(spark, lake)
    stamp = "last_updated_timestamp"
    assert table(spark.read.parquet(lake.monthly).drop(stamp)) == table(G.monthly_summary(claims))
    assert table(spark.read.parquet(lake.funnel).drop(stamp)) == table(G.approval_funnel(claims))
    assert table(spark.read.parquet(lake.provider).drop(stamp, "provider_bucket")) == table(G.provider_metrics(claims, DEFAULT))


def test_refreshes_in_steps(spark, lake):
    deliver(spark, lake, "a", "run-1", TS1, RENDERING_PROVIDER_NPI="1", **month(1))
    deliver(spark, lake, "b", "run-2", TS1, RENDERING_PROVIDER_NPI="2", **month(2))
    gold.run_gold(spark, lake, TS1, DEFAULT)
    check(spark, lake)
    deliver(spark, lake, "c", "run-3", TS2, RENDERING_PROVIDER_NPI="1", SUBSCRIBER_ID="PAT2", **month(3))
    gold.run_gold(spark, lake, TS2, DEFAULT)
    check(spark, lake)
    # A run is withdrawn from a month that keeps other claims, another with its whole month.
    deliver(spark, lake, "d", "run-4", TS2, RENDERING_PROVIDER_NPI="3", **month(3))
    gold.run_gold(spark, lake, TS2, DEFAULT)
    for run in ("run-4", "run-1"):
        shutil.rmtree(f"{local_path(lake.log)}/run_id={run}")
    gold.run_gold(spark, lake, TS2, DEFAULT)
    check(spark, lake)
    assert {r.provider_id for r in spark.read.parquet(lake.provider).collect()} == {"1", "2"}


def test_only_touched_months_are_read_and_only_touched_providers_rewritten(spark, lake, monkeypatch):
    import dataclasses
    import datetime as dt
    old = dataclasses.replace(DEFAULT, as_of=dt.date(1999, 6, 30))
    write_file(lake, "old.csv", COLS, [claim_row(CLAIM_ID=f"o{m}", RENDERING_PROVIDER_NPI=str(m), RECEIVED_DT=f"1999{m:02d}01",
                                                 SVC_FROM_DT=f"1999{m:02d}01", SVC_TO_DT=f"1999{m:02d}01") for m in range(1, 6)])
    bronze.register_new_files(spark, lake, TS1)
    silver.run_silver(spark, lake, "run-old", TS1, old)
    gold.run_gold(spark, lake, TS1, old)
    deliver(spark, lake, "new", "run-new", TS2, RENDERING_PROVIDER_NPI="1", **month(3))
    seen, real = [], gold.refresh_state

    def watched(spark, lake, silver, months, gone):
        seen.append(({r.year_month for r in months.collect()}, gone))
        real(spark, lake, silver, months, gone)
    monkeypatch.setattr(gold, "refresh_state", watched)
    gold.run_gold(spark, lake, TS2, DEFAULT)
    assert seen == [({"2001-03"}, [])]
    check(spark, lake)
    stamp = F.date_format("last_updated_timestamp", "yyyy-MM-dd HH:mm:ss").alias("t")
    when = {r.provider_id: r.t for r in spark.read.parquet(lake.provider).select("provider_id", stamp).collect()}
    assert when["1"] == str(TS2) and {when[str(m)] for m in range(2, 6)} == {str(TS1)}


def test_a_refresh_that_died_is_made_up_for(spark, lake, monkeypatch):
    deliver(spark, lake, "a", "run-1", TS1, RENDERING_PROVIDER_NPI="1", **month(1))
    deliver(spark, lake, "b", "run-2", TS1, RENDERING_PROVIDER_NPI="2", **month(2))
    gold.run_gold(spark, lake, TS1, DEFAULT)
    shutil.rmtree(f"{local_path(lake.log)}/run_id=run-1")

    def boom(*a):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(gold, "refresh_providers", boom)
        with pytest.raises(RuntimeError):
            gold.run_gold(spark, lake, TS2, DEFAULT)
    assert {r.provider_id for r in spark.read.parquet(lake.provider).collect()} == {"1", "2"}
    gold.run_gold(spark, lake, TS2, DEFAULT)
    check(spark, lake)
    assert read_silver(spark, lake).count() == 1


def test_runs_are_not_gathered_by_their_id(spark, lake):
    """Claims meet the visible runs where they lie: dealt by run id, all of a run's would go through one task."""
    from payerlake.sources.lake import ensure_tables, read_quarantine, read_silver
    ensure_tables(spark, lake)
    for table in (read_silver(spark, lake), read_quarantine(spark, lake)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
