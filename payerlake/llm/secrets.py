"""Secret scans with corpus-wide ownership frequency, by DataFrame functions only.

Base findings are leftmost, non-overlapping matches of three patterns, with minimum lengths
applied afterwards. The method looks at candidates: every base finding's value, and every long
run of key characters with enough digits and letters that overlaps no base finding. Over the
whole corpus, a candidate's hash is counted by distinct repositories and distinct owners. A value
that ``EXAMPLE_OWNERS`` or more owners share, or that lies in ``EXAMPLE_REPOSITORIES`` or more
repositories of whatever owners, is a copied example; one below both limits looks live. Base findings stay either way, with that verdict; of the other candidates only the
live ones become findings, of kind ``owned``.

A text is read once: its findings (a few dozen bytes each) are stored, and only they are
exploded, counted and joined. Distinct counts are pre-aggregated by (hash, owner) and (hash,
repository) before any hash is brought together, and the join back meets one row per hash, so a
value that a third of all documents share is split like any skewed key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import store, text_or_empty

EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 10
MIN_DIGITS, MIN_LETTERS = 4, 4

# The base patterns. Of a run of hex digits or of capitals and digits, asking for the
# minimum length inside the pattern finds the same matches as filtering the maximal runs.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
MIN_VALUE = 6
OWNED = "owned"

_SPAN = "array<struct<start:int,rank:int,kind:string,end:int,hash:string>>"


def _spans(text: Column, pattern: str, group: int, kind: str, rank: int, fits) -> Column:
    """Matches as (start, rank, kind, end, hash of the group), in code points, where ``fits(value)``.

    The text between matches and the matches themselves alternate, so adding up their lengths
    gives the places.
    """
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                        end.alias("end"), F.md5(x["value"].cast("binary")).alias("hash"))
        return F.struct(end.alias("at"), F.when(fits(x["value"]), F.concat(state["out"], F.array(span)))
                        .otherwise(state["out"]).alias("out"))

    none = F.array().cast(_SPAN)
    hits = F.filter(pieces, lambda x: x["hit"].isNotNull())
    found = F.aggregate(hits, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda s: s["out"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def _looks_random(value: Column) -> Column:
    digits = F.length(value) - F.length(F.translate(value, "0123456789", ""))
    signs = F.length(value) - F.length(F.translate(value, "+/_=-", ""))
    return (digits >= MIN_DIGITS) & (F.length(value) - digits - signs >= MIN_LETTERS)


def candidates(docs: DataFrame, key: str, text: str, owner: str, repository: str) -> DataFrame:
    """Base findings and other candidates of each row; row tells rows apart whatever their keys."""
    t = F.col("text")
    always = lambda v: F.lit(True)
    base = F.array_sort(F.concat(
        _spans(t, ASSIGN, 1, "assign", 0, lambda v: F.length(v) >= MIN_VALUE),
        _spans(t, ACCESS, 0, "access", 1, always), _spans(t, HEX, 0, "hex", 2, always)))
    rows = docs.select(F.col(key).alias("key"), F.col(owner).cast("string").alias("owner"),
                       F.col(repository).cast("string").alias("repository"), text_or_empty(text).alias("text"))
    rows = rows.select("key", "owner", "repository", base.alias("base"),
                       _spans(t, RUN, 0, OWNED, len(KINDS), _looks_random).alias("runs"))
    apart = F.filter("runs", lambda r: ~F.exists("base", lambda b: (r["start"] < b["end"]) & (b["start"] < r["end"])))
    return rows.select(F.monotonically_increasing_id().alias("row"), "key", "owner", "repository", "base",
                       apart.alias("runs"))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source",
                 repository: str = "doc_id") -> DataFrame:
    """key and findings per row of ``docs``: an array, by start and kind, of structs with start, rank,
    kind, end (code points, end exclusive), hash (md5 of the value), owners, repositories and live.

    Null and empty texts have no findings. A null owner or repository counts as none; a value of rows
    without owners is judged by its repositories alone. Only the named columns are read; repeated
    rows stay repeated; an empty table gives an empty one.
    """
    found = store(candidates(docs, key, text, owner, repository), "secrets")
    each = found.select("row", "owner", "repository", F.explode(F.concat("base", "runs")).alias("span"))
    counts = (each.groupBy(F.col("span.hash").alias("hash"))
              .agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repository").alias("repositories")))
    judged = (each.select("row", "span", F.col("span.hash").alias("hash")).join(counts, "hash")
              .withColumn("live", (F.col("owners") < EXAMPLE_OWNERS)
                          & (F.col("repositories") < EXAMPLE_REPOSITORIES))
              .filter((F.col("span.rank") < len(KINDS)) | F.col("live"))
              .select("row", F.struct("span.start", "span.rank", "span.kind", "span.end", "span.hash", "owners",
                                      "repositories", "live").alias("finding")))
    lists = judged.groupBy("row").agg(F.array_sort(F.collect_list("finding")).alias("findings"))
    none = F.array().cast(lists.schema["findings"].dataType)
    return (found.select("row", "key").join(lists, "row", "left")
            .select(F.col("key").alias(key), F.coalesce("findings", none).alias("findings")))


def listed(findings: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"),
                                                                    f["end"].cast("string"))), ",")
