"""Wire-boundary converters on malformed values (ANSI mode must not throw)."""

from decimal import Decimal
import datetime as dt

from pyspark.sql import functions as F

from payerlake.functions import parsing as P
from payerlake.operators import standardize as S


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("o")).first().o


def test_currency(spark):
    assert one(spark, P.parse_currency, "$1,234.50") == Decimal("1234.50")
    assert one(spark, P.parse_currency, "-5.00") == Decimal("-5.00")
    assert one(spark, P.parse_currency, "abc") is None
    assert one(spark, P.parse_currency, "") is None
    assert one(spark, P.parse_currency, "123456789012.5") is None  # overflow → NULL, not an error


def test_dates(spark):
    assert one(spark, lambda c: P.parse_date(c, "yyyyMMdd"), "20240131") == dt.date(2024, 1, 31)
    assert one(spark, lambda c: P.parse_date(c, "yyyyMMdd"), "20241301") is None
    assert one(spark, lambda c: P.parse_date(c, "MM/dd/yyyy"), "01/31/2024") == dt.date(2024, 1, 31)
    assert one(spark, lambda c: P.parse_date(c, "yyyy-MM-dd"), "2024-13-01") is None
    assert one(spark, lambda c: P.parse_date(c, "yyyy-MM-dd"), None) is None


def test_status(spark):
    st = P.standardize_status
    assert one(spark, st, "approved") == "Approved"
    assert one(spark, st, "PAID") == "Approved"
    assert one(spark, st, "processed") == "Approved"
    assert one(spark, st, "Rejected") == "Denied"
    assert one(spark, st, "processing") == "Pending"
    assert one(spark, st, "whatever") == "Under Review"
    assert one(spark, st, " approved") == "Under Review"  # no trimming, as the original
    assert one(spark, st, None) is None
    assert one(spark, lambda c: P.standardize_status(c, null_as_review=True), None) == "Under Review"


def test_codes(spark):
    assert one(spark, P.clean_diagnosis, "  e11.9 ") == "E11.9"
    assert one(spark, P.clean_procedure, " 99213 ") == "99213"


def test_unknown_payer_rejected():
    assert not S.known_payer("payer_x")
    assert S.wire_columns("payer_b")[0] == "claim_number"
