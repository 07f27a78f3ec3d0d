"""Query registry: key -> (Spark builder, optional DuckDB oracle SQL).

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
given tables (or tables Spark derives from them).  Keys without SQL are
checked rows-only by the driver and by brute force in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    key: str
    build: Builder
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Entry] = {}


def register(key: str, sql: str | None = None, note: str = ""):
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        from .oracle import normalize_types
        REGISTRY[key] = Entry(key, fn, normalize_types(sql) if sql else None, note)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # Importing the modules fills the registry.
    from . import (queries_core, queries_design, queries_feeds, queries_files,  # noqa: F401
                   queries_gold, queries_reports)
    return REGISTRY
