"""Corpus pipeline: the stages that turn ``documents`` into tokens, in order.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of documents. ``run`` writes every stage's rows to the shared scratch folder and reads
them back, so that a stage works on what its predecessor kept and a lost executor costs at most
the stage it was lost in.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from payerlake.llm._util import store
from payerlake.llm.bpe import encode_decode
from payerlake.llm.decontaminate import remove_leaks
from payerlake.llm.line_dedup import without_lines
from payerlake.llm.near_dedup import keep_one
from payerlake.llm.quality import keep_good
from payerlake.llm.queries import digest_tokens
from payerlake.sources.tables import read_table

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that another document keeps."""
    return without_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, at a similarity of 0.8 or more."""
    return keep_one(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return remove_leaks(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    return digest_tokens(encode_decode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("bpe", bpe)]
# Byte-pair merges are beyond SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
