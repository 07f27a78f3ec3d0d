"""Periodic runs of words by an online sparse diagonal DP.

A run is a stretch of words with smallest period q (words q apart are equal) and at least
max(``LEAST``, ``TIMES`` * q) words that no neighbouring word extends. On the diagonal of lag q it
is a series of matches ``word[i] == word[i - q]``. Every word, met in order, looks up its earlier
occurrences, and the diagonals of their lags grow by one match; a diagonal that a word does not
extend has ended, and is emitted if it is long enough.

The DP is sparse because an earlier occurrence counts only with the words before it. At scale k
(16, 32, 64, ...) two places match if the k words that end there are equal, and a scale holds the
lags from k/2 (1 at scale 16) to k - 1. One active lag a word and scale is enough, that of the
*nearest* earlier occurrence:

* The last word of a run of q has its k words again q places before, as k + q words fit into
  max(24, 3q): k = 16 for q < 16, else k <= 2q.
* If the same k words stood nearer, d < q places before, the k + d words up to there would lie
  in the run and have the periods q and d. As k + d >= q + d, they would have the period
  gcd(q, d) (Fine and Wilf), and so would the run, whose smallest period is q.
* The other way round, a diagonal of nearest occurrences with lag d whose next words differ ends a
  stretch of period d; if it has 3d words, d is its smallest period, since a smaller one would
  divide d and give a nearer occurrence.

So n words cost O(n log n) at any repetition, where all earlier occurrences of a word would be
n * n / 2 pairs in a text of one word. Grams are compared exactly, by numbers that are made by
doubling (the number of k words stands for the two numbers of k/2 words); those that occur once
in their text are left out at once. Texts stay where they are: no shuffle, no broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import small_batches, text_or_empty

# A run's least length in words and in periods; the proof above is for these.
LEAST, TIMES = 24, 3
GRAM = 16
SPAN_WORDS = 300_000  # texts are worked on together up to so many words; a longer one alone, and whole
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def words_of(text: str = "text") -> Column:
    """A text's words: what lies between ASCII white space. Null and empty texts have none."""
    return F.array_remove(F.split(text_or_empty(text), r"[\x20\x09-\x0D]+"), "")


def _numbered(at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ascending places with keys, those whose key is there twice: place, the key's number, the place before (or -1)."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = sorted_keys[1:] != sorted_keys[:-1]
    twice = ~first
    twice[:-1] |= ~first[1:]
    before = np.full(len(keys), -1, np.int64)
    before[1:] = at[order[:-1]]
    before[first] = -1
    return at[order][twice], (np.cumsum(first) - 1)[twice], before[twice]


def _ends(codes: np.ndarray, stop: np.ndarray, at: np.ndarray, before: np.ndarray, least: int, most: int) \
        -> Iterator[tuple[int, int, int]]:
    """Diagonals of one scale that have ended: first place, last place, lag."""
    use = before >= 0
    at, lag = at[use], at[use] - before[use]
    use = (lag >= least) & (lag < most)
    at, lag = at[use], lag[use]
    order = np.argsort(at)
    at, lag = at[order], lag[order]
    if not len(at):
        return
    new = np.r_[True, (np.diff(at) != 1) | (np.diff(lag) != 0)]
    first, last, lag = at[new], at[np.r_[new[1:], True]], lag[new]
    # Where the next word matches too, the diagonal goes on and is emitted where it ends.
    follows = last + 1 < stop[last]
    follows[follows] = codes[last[follows] + 1] == codes[last[follows] + 1 - lag[follows]]
    yield from zip(first[~follows].tolist(), last[~follows].tolist(), lag[~follows].tolist(), strict=True)


def _first_match(codes: np.ndarray, at: int, lag: int, floor: int) -> int:
    """The first place from which all words up to ``at`` equal the words ``lag`` before them."""
    step = 64
    while at > floor:
        lo = max(floor, at - step)
        differ = np.flatnonzero(codes[lo:at] != codes[lo - lag:at - lag])
        if len(differ):
            return lo + int(differ[-1]) + 1
        at, step = lo, 2 * step
    return at


def runs_of(codes: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Each text's runs (start, length, period) by start, then period.

    ``codes`` are the texts' words as numbers, one text after the other; ``sizes`` their words.
    """
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    ends = np.cumsum(sizes)
    of = np.repeat(np.arange(len(sizes)), sizes)
    begin, stop = (ends - sizes)[of], ends[of]
    long = (sizes >= LEAST)[of]
    at = np.flatnonzero(long)
    if not len(at):
        return found
    at, number, before = _numbered(at, of[at] * (int(codes.max()) + 1) + codes[at])
    k, longest = 1, int(sizes.max())
    dense = np.full(len(codes), -1, np.int64)
    while len(at):
        if k >= GRAM:
            for first, last, lag in _ends(codes, stop, at, before, 1 if k == GRAM else k // 2, k):
                text = int(of[first])
                origin = int(begin[first])
                start = _first_match(codes, first - k + 1, lag, origin + lag) - lag
                length = last + 1 - start
                if length >= max(LEAST, TIMES * lag):
                    found[text].append((start - origin, length, lag))
            if TIMES * k > longest:  # lags of the next scale are k at least
                break
        dense[at] = number
        held = np.sort(at)
        at = held[held - k >= begin[held]]
        at = at[dense[at - k] >= 0]
        keys = dense[at - k] * (len(codes) + 1) + dense[at]
        dense[held] = -1
        at, number, before = _numbered(at, keys)
        k *= 2
    for own in found:
        own.sort(key=lambda r: (r[0], r[2]))
    return found


def kept_words(sizes: np.ndarray, runs: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """Which words stay when every run keeps its first period only."""
    edge = np.zeros(int(sizes.sum()) + 1, np.int64)
    for origin, own in zip((np.cumsum(sizes) - sizes).tolist(), runs, strict=True):
        for start, length, period in own:
            edge[origin + start + period] += 1
            edge[origin + start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def _spans(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    lo, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > lo and total + n > SPAN_WORDS:
            yield lo, i
            lo, total = i, 0
        total += n
    if len(sizes):
        yield lo, len(sizes)


def periodic_runs(docs: DataFrame, key: str = "doc_id", words: Column | None = None) -> DataFrame:
    """key, n_words, runs (start, length, period; by start, then period) and collapsed per row of ``docs``.

    ``words`` is an array of strings, by default the words of column ``text``; a null array, a null
    and an empty text have no words, no runs and an empty collapsed text. ``collapsed`` joins by one
    blank the words that no run holds after its first period. Repeated rows and null keys give a
    row each, an empty table none; other columns are not read, whatever their names. A null word
    counts as an empty one.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            sizes = np.diff(offsets)
            for lo, hi in _spans(sizes):
                own = flat[offsets[lo]:offsets[hi]]
                codes = own.dictionary_encode().indices.to_numpy().astype(np.int64)
                runs = runs_of(codes, sizes[lo:hi])
                keep = kept_words(sizes[lo:hi], runs)
                left = np.r_[0, np.cumsum(keep)][offsets[lo:hi + 1] - offsets[lo]].astype(np.int32)
                rest = pa.ListArray.from_arrays(left, own.filter(pa.array(keep)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(sizes[lo:hi].astype(np.int64)),
                     pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in runs], RUN_TYPE),
                     pc.binary_join(rest, " ")], ["key", "n_words", "runs", "collapsed"])

    given = words_of() if words is None else words
    whole = F.transform(F.coalesce(given, F.array().cast("array<string>")), lambda w: F.coalesce(w, F.lit(""))) \
        if words is not None else given
    return (docs.select(F.col(key).alias("key"), whole.alias("words"))
            .mapInArrow(run, f"key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                             "collapsed string").withColumnRenamed("key", key))
