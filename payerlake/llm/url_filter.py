"""URL filter: longest-match allow / block rules in a trie over host labels and path segments.

A rule is ``host/path``. Its host fits itself and every subdomain, its path every url path that
starts with it; a rule without a slash fits any path, also the empty one. Of all rules that fit,
the longest rule string wins; between equally long ones the one with more host labels, then block.

The trie walks the host's labels from the right and, at each node that ends a rule's host, the
path's segments from the left, so one url costs its own length and not the number of rules.
The rules are an argument of the call. They are shipped in blocks of ``BLOCK`` rules; more rules
than that take one pass per block, of which the longest match is kept, so no broadcast grows
beyond ``BLOCK`` rules.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import ascii_lower

BLOCK = 200_000
ALLOW, BLOCKED = "allow", "block"


class RuleTrie:
    """Rules ``(verdict, "host/path")`` as nested dictionaries."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root: dict = {"kids": {}}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            node = self.root
            labels = host.split(".")
            for label in reversed(labels):
                node = node["kids"].setdefault(label, {"kids": {}})
            found = (len(rule), len(labels), verdict == BLOCKED, rule, verdict)
            if not slash:
                node["any"] = max(node.get("any", found), found)
                continue
            *whole, last = path.split("/")
            at = node.setdefault("paths", {"kids": {}, "ends": {}})
            for segment in whole:
                at = at["kids"].setdefault(segment, {"kids": {}, "ends": {}})
            at["ends"][last] = max(at["ends"].get(last, found), found)

    @staticmethod
    def _path_hits(paths: dict, segments: Sequence[str]):
        for i, segment in enumerate(segments):
            for last, found in paths["ends"].items():
                if segment.startswith(last):
                    yield found
            paths = paths["kids"].get(segment) if i + 1 < len(segments) else None
            if paths is None:
                return

    def match(self, host: str, path: str) -> tuple | None:
        """The winning ``(length, labels, is_block, rule, verdict)``, or None."""
        best, node = None, self.root
        segments = path[1:].split("/") if path.startswith("/") else None
        for label in reversed(host.split(".")):
            node = node["kids"].get(label)
            if node is None:
                break
            hits = [node["any"]] if "any" in node else []
            if segments is not None and "paths" in node:
                hits += self._path_hits(node["paths"], segments)
            if hits:
                best = max(hits) if best is None else max(best, *hits)
        return best


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; '' without one."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], key: str = "page_id",
               url: str = "url", default: str = ALLOW) -> DataFrame:
    """One row per page: key, host, path, rule (null: none fits) and verdict.

    Null urls and urls without ``://`` have an empty host and path, fit no rule and get
    ``default``. Other columns of ``pages`` are not read, whatever their names; repeated rows
    stay repeated; an empty table gives an empty one.
    """
    spark = pages.sparkSession
    found = F.struct(F.lit(0).alias("size"), F.lit(0).alias("labels"), F.lit(False).alias("blocks"),
                     F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    out = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    for at in range(0, len(rules), BLOCK):
        found = F.greatest(found, _longest(spark, rules[at:at + BLOCK], default)("host", "path"))
    return (out.withColumn("found", found)
            .select(key, "host", "path", F.col("found.rule").alias("rule"),
                    F.col("found.verdict").alias("verdict")))


def _longest(spark, rules, default: str):
    trie = spark.sparkContext.broadcast(RuleTrie(rules))

    @F.pandas_udf("size int, labels int, blocks boolean, rule string, verdict string")
    def longest(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        none = (0, 0, False, None, default)
        match = trie.value.match
        return pd.DataFrame([match(h, p) or none for h, p in zip(host, path, strict=True)],
                            columns=["size", "labels", "blocks", "rule", "verdict"])
    return longest
