"""Duplicate claims within a run and across runs.

A claim is known by (payer_name, claim_id).  Of the accepted rows of a run with
the same key one stays, the one of the newest file; a key that an earlier run
has published is a duplicate as a whole.  Duplicates are not dropped: they get
the reason ``DUPLICATE_CLAIM`` and go to quarantine like any rejected row.

*Across runs* the published keys are asked through a Bloom filter that is kept
beside silver, one part a run: a key sets ``PROBES`` bits of the bucket it
hashes to, a bucket is one bitmap (``bitmap_construct_agg``), and the parts of
several runs merge by ``bitmap_or_agg``.  A new key whose bits are not all set
has never been published.  The others – few, unless much is delivered again –
are looked up exactly in the published keys.  So a run reads about
``8 * 4096 * buckets / keys`` bits a published key instead of the keys, and
shuffles its own keys only.  The filter can be wrong in one direction only, and
that one is checked; ``buckets`` sets its size and cannot change results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ["payer_name", "claim_id"]
REASON = "DUPLICATE_CLAIM"
PROBES = 4
BITS = 32768  # of a bitmap; bitmap_bit_position counts within as many


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *(F.col(k) for k in KEYS))


def bucket(buckets: int) -> Column:
    return F.pmod(_hash(0), F.lit(buckets)).cast("int")


def positions() -> Column:
    return F.array(*(F.pmod(_hash(s), F.lit(BITS)).cast("int") for s in range(1, PROBES + 1)))


def key_filter(keys: DataFrame, buckets: int) -> DataFrame:
    """bucket, bits: the Bloom filter of the keys (payer_name, claim_id) of ``keys``."""
    bits = keys.select(bucket(buckets).alias("bucket"), F.explode(positions()).alias("position"))
    return bits.groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bits"))


def merged(parts: DataFrame) -> DataFrame:
    """One filter of several runs' filters."""
    return parts.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(position, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, position.bitwiseAND(F.lit(7))) == 1


def maybe_published(keys: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The distinct keys that the filter cannot rule out."""
    asked = keys.select(*KEYS).distinct().withColumn("bucket", bucket(buckets)).withColumn("positions", positions())
    hit = asked.join(filters, "bucket")
    every = None
    for i in range(PROBES):
        test = _is_set(F.col("bits"), F.col("positions")[i])
        every = test if every is None else every & test
    return hit.filter(every).select(*KEYS)


def duplicate_rows(accepted: DataFrame, published: DataFrame) -> DataFrame:
    """row_id of the rows of ``accepted`` that are not the one of their key that stays.

    ``accepted`` has the keys, row_id and newest: of a key's rows the one with the greatest
    (newest, row_id) stays, unless the key is in ``published``.  Rows without a key have no duplicates.
    """
    kept = accepted.groupBy(*KEYS).agg(F.max_by("row_id", F.struct("newest", "row_id")).alias("_kept"),
                                       F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    again = accepted.join(kept, KEYS).filter("row_id <> _kept").select("row_id")
    return again.unionByName(accepted.join(published, KEYS, "left_semi").select("row_id")).distinct()
