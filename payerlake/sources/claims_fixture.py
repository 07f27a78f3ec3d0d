"""Canonical claims derived from the order tables.

The test data carries no insurance claims, so a claim is derived from each
line item of ``lineitem ⋈ orders ⋈ customer`` by fixed rules (FIXTURES.md
§4).  The derivation deliberately plants rows that break every validation
rule, so the rule engine and the quarantine path get real work.

Plan shape at scale: two equi-joins on the foreign keys, ``orders ⋈ customer``
before ``lineitem``.  Both sides of the second are large, so they sort-merge (AQE
may switch to a broadcast only when the measured side is under the threshold).  Only the
seven customer / order columns needed are read (column pruning reaches the
parquet scan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, discard, exists, scratch_path, shuffles_dropped
from ..sources.tables import read_table

# Fixed values of the derivation (FIXTURES.md §4).
SEGMENT_TO_PAYER = {
    "FURNITURE": "payer_a", "MACHINERY": "payer_a",
    "BUILDING": "payer_b", "HOUSEHOLD": "payer_b",
}
OTHER_PAYER = "payer_c"
DIAGNOSIS_LETTERS = "ACEFIJKMNZ"

CLAIM_COLUMNS = [
    "claim_id", "patient_id", "provider_id", "claim_date", "service_from_date",
    "service_to_date", "admission_date", "discharge_date", "diagnosis_code",
    "procedure_code", "billed_amount", "allowed_amount", "paid_amount",
    "claim_status", "claim_type", "payer_name", "processing_date",
]

DEC = "decimal(10,2)"


def _payer(segment: Column) -> Column:
    expr = None
    for seg, payer in SEGMENT_TO_PAYER.items():
        cond = segment == F.lit(seg)
        expr = F.when(cond, payer) if expr is None else expr.when(cond, payer)
    return expr.otherwise(OTHER_PAYER)


def claims_from_orders(lineitem: DataFrame, orders: DataFrame,
                       customer: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                         "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                         "l_returnflag", "l_linestatus")
    od = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    cu = customer.select("c_custkey", "c_mktsegment")
    # Orders meet their customers first: the line items, several times as many, are shuffled once.
    base = li.join(od.join(cu, od.o_custkey == cu.c_custkey), F.col("l_orderkey") == F.col("o_orderkey"))

    pk = F.col("l_partkey").cast("int")
    q = F.col("l_quantity").cast("int")
    day = F.to_date("o_orderdate")
    ln = F.col("l_linenumber")

    status = (F.when(F.col("l_returnflag") == "A", "Approved")
               .when(F.col("l_returnflag") == "R", "Denied")
               .when(F.col("l_linestatus") == "F", "Pending")
               .otherwise("Under Review"))
    service_from = F.when(ln == 7, F.date_add(day, pk % 120)).otherwise(F.date_sub(day, pk % 46))
    diagnosis = (F.when(pk % 101 == 0, F.lit(None).cast("string"))
                  .when(pk % 97 == 0, F.lit("E1"))
                  .otherwise(F.concat(
                      F.substring(F.lit(DIAGNOSIS_LETTERS), (pk % 10) + 1, 1),
                      F.lpad((pk % 100).cast("string"), 2, "0"),
                      F.when(pk % 3 == 0, F.lit("")).otherwise(
                          F.concat(F.lit("."), (pk % 10).cast("string"))))))
    procedure = (F.when(pk % 89 == 0, F.lit("12"))
                  .when(pk % 20 == 0, F.lit("G0438"))
                  .otherwise((F.lit(90000) + pk % 25).cast("string")))

    staged = base.select(
        _payer(F.col("c_mktsegment")).alias("payer_name"),
        status.alias("claim_status"),
        F.col("l_orderkey"), ln.alias("l_linenumber"), pk.alias("pk"), q.alias("q"),
        day.alias("claim_date"),
        service_from.alias("service_from_date"),
        diagnosis.alias("diagnosis_code"),
        procedure.alias("procedure_code"),
        F.col("o_custkey"), F.col("l_suppkey"),
        F.when(pk % 83 == 0, F.lit(0).cast(DEC))
         .otherwise(F.col("l_extendedprice").cast(DEC)).alias("billed_amount"),
        F.col("l_discount").cast("decimal(4,2)").alias("disc"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"),
    )
    approved = F.col("claim_status") == "Approved"
    allowed = (F.when(~approved, F.lit(0).cast(DEC))
                .when(F.col("pk") % 79 == 0, (F.col("billed_amount") + 1).cast(DEC))
                .otherwise((F.col("billed_amount") * (1 - F.col("disc"))).cast(DEC)))
    staged = staged.withColumn("allowed_amount", allowed)
    paid = (F.when(~approved | (F.col("pk") % 71 == 0), F.lit(0).cast(DEC))
             .when(F.col("pk") % 73 == 0, (F.col("allowed_amount") + 1).cast(DEC))
             .otherwise((F.col("allowed_amount") * (1 - F.col("tax"))).cast(DEC)))
    first_line = F.col("l_linenumber") == 1
    sfrom = F.col("service_from_date")
    return staged.select(
        F.concat_ws("-", "payer_name", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("claim_id"),
        F.when(F.col("pk") % 103 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("PAT"), F.col("o_custkey").cast("string"))).alias("patient_id"),
        F.col("l_suppkey").cast("string").alias("provider_id"),
        "claim_date",
        sfrom.alias("service_from_date"),
        F.date_add(sfrom, F.col("q") - 2).alias("service_to_date"),
        F.when(first_line, sfrom).alias("admission_date"),
        F.when(first_line, F.date_add(sfrom, F.col("q") % 11 - 1)).alias("discharge_date"),
        "diagnosis_code", "procedure_code", "billed_amount", "allowed_amount",
        paid.alias("paid_amount"),
        "claim_status",
        F.when(first_line, "Inpatient").otherwise("Outpatient").alias("claim_type"),
        "payer_name",
        F.date_add(F.col("claim_date"), F.col("q")).alias("processing_date"),
    )


def claims_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical (pre-validation) claims for the tables under ``sf_dir``."""
    return claims_from_orders(read_table(spark, sf_dir, "lineitem"),
                              read_table(spark, sf_dir, "orders"),
                              read_table(spark, sf_dir, "customer"))


_STORED: dict[tuple, str] = {}


def _table_key(spark: SparkSession, sf_dir: str) -> tuple:
    return (spark.sparkContext.applicationId, checkpoint_root(spark), sf_dir.rstrip("/"))


def has_claims_table(spark: SparkSession, sf_dir: str) -> bool:
    path = _STORED.get(_table_key(spark, sf_dir))
    return path is not None and exists(spark, path)


def claims_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived claims as a stored parquet table (written once per session).

    Claims are a stored table in a lakehouse; keeping the derivation out of
    downstream plans also stops Catalyst from inlining the whole derivation
    into every validation filter (which it pushes down into the join).  The
    table lives below the shared checkpoint folder.
    """
    key = _table_key(spark, sf_dir)
    if not has_claims_table(spark, sf_dir):
        path = scratch_path(spark, "claims")
        with shuffles_dropped(spark):
            claims_view(spark, sf_dir).write.mode("overwrite").parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def drop_claims_table(spark: SparkSession, sf_dir: str) -> None:
    """Delete the stored claims; DataFrames over them can no longer be read, and the next use stores them anew."""
    path = _STORED.pop(_table_key(spark, sf_dir), None)
    if path is not None:
        discard(spark, path)
