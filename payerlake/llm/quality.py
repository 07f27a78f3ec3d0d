"""Quality rules: repetition counts and Jensen-Shannon distance to language references.

Everything is DataFrame functions, and one pass over the texts: each row's counts and histograms
(a few hundred bytes) are stored, the references are sums over the stored rows, and the verdicts
are computed from them. The references are at most one histogram of character classes and one of
function words, with one bin for all other words, for each language of ``COMMON_WORDS``; they
reach the rows as literals.

A document fails the base rules with fewer than ``MIN_WORDS`` words, or with more than
``MAX_REPEAT`` percent of its words in 8-word windows that it has twice or more. It fails the
method if even the nearest language's reference is further than ``CLASS_LIMIT`` in character
classes, or further in words than the limit for its length: a text of n words is away from its
own language by chance, by about 1 / n in the square, so that the limit's square is
``WORD_LIMIT`` squared and ``WORD_NOISE`` / n. Both are set from clean text: over the rows of
sf0.1 and check_s labelled good, the square less ``WORD_NOISE`` / n reaches 0.303 squared at most.
Character classes of texts under ``MIN_CHARS`` characters say little, and do not count.

An expression that is named twice may be computed twice; ``_let`` binds it once, as a lambda's
variable.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import WHITE, store, text_or_empty

MIN_WORDS, MAX_REPEAT, WINDOW = 20, 30, 8
MIN_CHARS = 200
# Jensen-Shannon distances (base 2, 0 to 1).
CLASS_LIMIT, WORD_LIMIT, WORD_NOISE = 0.30, 0.31, 5.0
SPLIT = r"[\x20\x09-\x0D]+"

# Frequent function words by language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he are this have from or at an which you were",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le",
}
LISTED = sorted({w for words in COMMON_WORDS.values() for w in words.split()})
OTHERS = ""  # stands for all words that are not listed
SYMBOLS = "#*$%&|<>"
# Characters of one class after the other are taken out of the text; what stays is the last class.
CLASSES = (("lower", r"\p{Ll}+"), ("white", SPLIT), ("upper", r"\p{Lu}+"), ("stop", r"[.,;:!?'\"()-]+"),
           ("digit", r"\p{N}+"), ("symbol", r"[#*$%&|<>=+~^@\\/_]+"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """How many words lie in a WINDOW-word window that the text has twice or more."""
    def covered(starts: Column) -> Column:
        # Each start covers the words up to the next one, WINDOW at most; the last covers WINDOW.
        less = F.size(starts) - 1
        gaps = F.zip_with(F.slice(starts, F.lit(2), less), F.slice(starts, F.lit(1), less),
                          lambda b, a: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)

    def starts(ordered: Column) -> Column:
        again = F.filter(ordered, lambda w, i: F.get(ordered, i - 1)["h"].eqNullSafe(w["h"])
                         | F.get(ordered, i + 1)["h"].eqNullSafe(w["h"]))
        return F.array_sort(F.transform(again, lambda w: w["at"]))

    def count(hashes: Column) -> Column:
        # Most texts repeat nothing, and need no places.
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
                      _let(F.array_sort(placed), lambda ordered: _let(starts(ordered), covered))).otherwise(0)

    def doubled(size: int) -> Callable[[Column], Column]:
        """Hashes of windows of 2 * size words from those of size words."""
        def pair(h: Column) -> Column:
            n = F.size(h) - size
            return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(1 + size), n), lambda a, b: F.xxhash64(a, b))
        return pair

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    for size in (1, 2, 4):  # WINDOW / 2, / 4 and so on
        hashes = _let(hashes, doubled(size))
    return F.when(F.size(words) > WINDOW, _let(hashes, count)).otherwise(0)


def _histogram(words: Column) -> Column:
    """The listed words of a text, in order, and how often it has each."""
    def counts(ordered: Column) -> Column:
        def of(distinct: Column) -> Column:
            first = F.transform(distinct, lambda w: F.array_position(ordered, w))
            return _let(first, lambda at: F.struct(distinct.alias("words"), F.transform(
                at, lambda a, i: F.coalesce(F.get(at, i + 1), F.size(ordered) + F.lit(1)) - a).alias("counts")))
        return _let(F.array_distinct(ordered), of)

    plain = F.transform(words, lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))))
    return _let(F.array_sort(F.filter(plain, lambda w: w.isin(LISTED))), counts)


def _with_others(common: Column, n_words: Column) -> Column:
    """A histogram with one more bin, of the words that are not listed."""
    others = n_words - F.aggregate(common["counts"], F.lit(0).cast("long"), lambda total, n: total + n)
    return F.struct(F.concat(common["words"], F.array(F.lit(OTHERS))).alias("words"),
                    F.concat(common["counts"], F.array(others)).cast("array<long>").alias("counts"))


def measures(docs: DataFrame, key: str, text: str, language: str, whole: bool) -> DataFrame:
    """The base counts and both histograms of every row, and the row itself if ``whole``."""
    t = text_or_empty(text)
    row = F.struct(*(F.col(f"`{c}`") for c in (docs.columns if whole else [key])))
    rows = docs.select(F.col(key).alias("key"), F.col(language).alias("language"), row.alias("row"), t.alias("text"),
                       F.array_remove(F.split(t, SPLIT), "").alias("words"),
                       F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0).alias("lines"))
    rows = rows.select(
        "key", "language", "row", "text", F.size("words").cast("long").alias("n_words"),
        F.length("text").alias("n_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        _let(_histogram(F.col("words")), lambda c: _with_others(c, F.size("words"))).alias("common"))
    kept = [c for c in rows.columns if c != "text"]
    for name, pattern in CLASSES:
        rows = rows.withColumn("less", F.regexp_replace("text", pattern, ""))
        counts = [(F.length("text") - F.length("less")).alias(name)]
        if name == "symbol":  # what is left holds all of them
            counts.append((F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"))
        rows = rows.select(*kept, *counts, F.col("less").alias("text"))
        kept += [name, "n_symbols"] if name == "symbol" else [name]
    names = [n for n, _ in CLASSES]
    return rows.select(*(c for c in kept if c not in (*names, "n_chars")),
                       (F.col("n_chars") - F.col("white")).cast("long").alias("word_chars"),
                       F.array(*names, F.length("text")).cast("array<long>").alias("classes"))


def references(measured: DataFrame) -> dict[str, tuple[list[float], dict[str, float]]]:
    """Each known language's share of the character classes and of its function words, over all rows."""
    known = measured.filter(F.col("language").isin(list(COMMON_WORDS)))
    size = len(CLASSES) + 1
    sums = known.groupBy("language").agg(*(F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(size))).collect()
    pairs = known.select("language", F.explode(F.arrays_zip("common.words", "common.counts")).alias("x"))
    words: dict[str, dict[str, int]] = {}
    for lang, word, n in (pairs.groupBy("language", F.col("x.words").alias("w"))
                          .agg(F.sum("x.counts")).collect()):  # languages times listed words at most
        words.setdefault(lang, {})[word] = n
    out = {}
    for row in sums:
        total, listed = sum(row[1:]), words.get(row[0], {})
        if total and set(listed) - {OTHERS}:
            out[row[0]] = ([x / total for x in row[1:]],
                           {w: n / sum(listed.values()) for w, n in sorted(listed.items())})
    return out


def _term(p: Column, q: Column) -> Column:
    """One bin's part of twice the divergence, p from the text and q from the reference."""
    m = (p + q) / 2
    return (F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0))


def _distance(twice: Column) -> Column:
    return F.sqrt(F.greatest(twice, F.lit(0.0)) / 2)


def class_distance(classes: Column, share: list[float]) -> Column:
    total = F.aggregate(classes, F.lit(0).cast("long"), lambda s, x: s + x).cast("double")
    return F.when(total > 0, _distance(F.aggregate(
        F.zip_with(classes, F.array(*map(F.lit, share)), lambda n, q: _term(n / total, q)),
        F.lit(0.0), lambda s, x: s + x)))


def word_distance(common: Column, share: dict[str, float]) -> Column:
    table = F.create_map(*(F.lit(x) for pair in share.items() for x in pair))
    total = F.aggregate(common["counts"], F.lit(0).cast("long"), lambda s, x: s + x).cast("double")
    # A reference word that the text lacks adds its whole share; so all shares, less those it has.
    bins = F.zip_with(common["words"], common["counts"], lambda w, n: _let(
        F.coalesce(F.try_element_at(table, w), F.lit(0.0)), lambda q: _term(n / total, q) - q))
    return F.when(total > 0, _distance(F.aggregate(bins, F.lit(math.fsum(share.values())), lambda s, x: s + x)))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang",
          whole: bool = False) -> DataFrame:
    """key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance
    and word_distance (to the nearest language; null without a reference or a text), kept. With
    ``whole`` also row, a struct of all columns.

    Null and empty texts have no words and fail the base rules. Languages only serve to sum up the
    references; rows of other or null languages are judged like all. Other columns are not read,
    whatever their names; repeated rows stay repeated; an empty table gives an empty one.
    """
    measured = store(measures(docs, key, text, language, whole), "quality")
    known = references(measured)
    chars = F.aggregate("classes", F.lit(0).cast("long"), lambda s, x: s + x)

    def nearest(distances: list[Column]) -> Column:
        return F.least(*distances, F.lit(None).cast("double")) if distances else F.lit(None).cast("double")

    rows = measured.select(
        "*", nearest([class_distance(F.col("classes"), c) for c, _ in known.values()]).alias("class_distance"),
        nearest([word_distance(F.col("common"), w) for _, w in known.values()]).alias("word_distance"),
        ((F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT))
        .alias("base_failed"))
    far = (((chars >= MIN_CHARS) & (F.col("class_distance") > CLASS_LIMIT))
           | (F.col("word_distance") * F.col("word_distance") > WORD_LIMIT ** 2 + WORD_NOISE / F.col("n_words")))
    return rows.select(F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "class_distance", "word_distance",
                       (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"),
                       *(["row"] if whole else []))


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang") -> DataFrame:
    """The rows that the rules keep, with all their columns."""
    return judge(docs, key, text, language, whole=True).filter("kept").select("row.*")
