"""Payer feed keys: wire round trips and the two column normalisers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import standardize as S
from ..sources.claims_fixture import claims_table
from . import oracle as O
from .queries_core import CFG
from .registry import register

STD_COLS = [c for c in S.CANONICAL] + ["payer_name"]
_STD_SELECT = ", ".join(STD_COLS)


def round_trip(spark, sf, payers=S.PAYERS):
    claims = claims_table(spark, sf)
    return S.standardize_all({p: S.render_feed(claims, p) for p in payers}, CFG).select(*STD_COLS)


def _std_key(payer: str):
    register(f"std_{payer}", O.with_wire(
        f"SELECT {_STD_SELECT} FROM wire WHERE payer_name = '{payer}'"))(
        lambda spark, sf: round_trip(spark, sf, (payer,)))


for _p in S.PAYERS:
    _std_key(_p)


@register("std_all", O.with_wire(f"SELECT {_STD_SELECT} FROM wire"))
def q_std_all(spark, sf):
    return round_trip(spark, sf)


@register("parse_currency", O.with_wire(
    "SELECT claim_id, billed_amount, allowed_amount, paid_amount FROM wire WHERE payer_name = 'payer_b'"))
def q_parse_currency(spark, sf):
    """Feed B writes '$1,234.50' amounts; parse them back to decimal(10,2)."""
    feed = S.render_feed(claims_table(spark, sf), "payer_b")
    lay = S.layout("payer_b")
    from ..functions.parsing import parse_currency
    return feed.select(F.col(lay["claim_id"]).alias("claim_id"),
                       *[parse_currency(lay[c]).alias(c) for c in S.AMOUNT_COLS])


def _status_case() -> str:
    parts = []
    for payer, spell in S.STATUS_SPELLING.items():
        for canon, raw in spell.items():
            parts.append(f"WHEN payer_name = '{payer}' AND claim_status = '{canon}' THEN '{raw}'")
    return "CASE " + " ".join(parts) + " END"


@register("standardize_status", O.with_wire(
    f"SELECT payer_name, {_status_case()} AS raw_status, claim_status, count(*) AS n "
    "FROM wire GROUP BY ALL"))
def q_standardize_status(spark, sf):
    """Every raw status spelling seen in the feeds and what it maps to."""
    from ..functions.parsing import standardize_status
    claims = claims_table(spark, sf)
    parts = []
    for p in S.PAYERS:
        col = S.layout(p)["claim_status"]
        parts.append(S.render_feed(claims, p).select(
            F.lit(p).alias("payer_name"), F.col(col).alias("raw_status")))
    raw = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return (raw.withColumn("claim_status", standardize_status("raw_status"))
            .groupBy("payer_name", "raw_status", "claim_status").agg(F.count(F.lit(1)).alias("n")))
