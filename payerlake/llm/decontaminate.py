"""Benchmark decontamination: q-gram lemma filtering in diagonal bands, then banded alignment.

A passage of m characters with at most k edits shares at least ``m + 1 - Q * (k + 1)`` of its
q-grams with the text it was copied into, on diagonals (text position minus passage position)
no further apart than k. The filter looks every q-gram of a text up in the items' q-gram index,
counts the hits in overlapping bands of ``2 * (k + 1)`` diagonals, of which one must hold the
whole copy, and keeps the bands that reach the bound. Those are verified by an alignment of the
whole item against the band, which also yields the copy's place and edits. The filter loses no
copy within the budget; the alignment removes all chance hits.

Texts and items are compared by code points, lower-cased, any white space as a blank. The budget
is ``RATE`` of an item's length, or less for short items so that the bound stays positive. Items
of fewer than ``MIN_ITEM`` characters are sought verbatim, those of fewer than ``Q`` as whole texts.

Memory is bounded whatever recurs: hits are expanded ``EXPAND`` at a time in the order of the
text, and a band is settled once the text has passed it. Of a run of one character that is longer
than any copy, only both ends are searched, unless an item is within its budget of such a run.

The index is broadcast. Its size is bounded: items are dealt into blocks of about
``BLOCK_CHARS`` characters by a hash of their id, and each block is one more pass over the texts.
A pass is a map without shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import small_batches, text_or_empty

Q = 8
RATE = 0.10
# Shorter items have no edits to spare.
MIN_ITEM = 32
EXPAND = 2_000_000
BLOCK_CHARS = 2_000_000
SPAN_CHARS = 2_000_000
# More cells than this in one alignment table are split over several candidates' groups.
ALIGN_CELLS = 2_000_000

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BITS = np.uint64(64 - 22)
_LOWER = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(0x3000)], np.uint32)
for _c in range(0x3000):
    if chr(_c).isspace():
        _LOWER[_c] = 32


def code_points(text: str) -> np.ndarray:
    """Lower-cased code points, white space as blanks; as many as the text has."""
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).copy()
    low = c < len(_LOWER)
    c[low] = _LOWER[c[low]]
    return c


def grams(c: np.ndarray) -> np.ndarray:
    """A hash of the Q code points from each position on (by doubling: 2, 4, 8)."""
    h, size = c.astype(np.uint64) + np.uint64(1), 1
    while size < Q:
        h = h[:len(h) - size] * np.uint64(pow(int(_FACTOR), size, 2**64)) + h[size:]
        size *= 2
    return h


@dataclass
class Index:
    """The q-grams of one block of items, sorted by hash, and what the lemma asks of each item."""

    ids: np.ndarray
    items: list[np.ndarray]
    budget: np.ndarray
    need: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray
    # Items of fewer than Q characters, by their bytes; characters an item consists of, but for its
    # budget; the longest copy.
    tiny: dict[bytes, list[int]]
    constant: np.ndarray
    reach: int

    @classmethod
    def build(cls, rows: list[tuple[int, str]]) -> Index:
        rows = [(i, c) for i, c in ((i, code_points(t.strip())) for i, t in rows if t) if len(c)]
        sizes = np.array([len(c) for _, c in rows], np.int64)
        budget = np.minimum((sizes * RATE).astype(np.int64), sizes // Q - 1)
        budget[sizes < MIN_ITEM] = 0
        h = [grams(c) if len(c) >= Q else np.zeros(0, np.uint64) for _, c in rows]
        tiny: dict[bytes, list[int]] = {}
        constant = set()
        for j, (_, c) in enumerate(rows):
            if len(c) < Q:
                tiny.setdefault(c.tobytes(), []).append(j)
            else:
                chars, times = np.unique(c, return_counts=True)
                constant.update(chars[len(c) - times <= budget[j]].tolist())
        flat = np.concatenate([*h, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(rows)), [len(x) for x in h])
        place = np.concatenate([*(np.arange(len(x)) for x in h), np.zeros(0, np.int64)])
        order = np.argsort(flat, kind="stable")
        hashes, first = np.unique(flat[order], return_index=True)
        seen = np.zeros(1 << 22, bool)
        seen[hashes >> _BITS] = True
        return cls(np.array([i for i, _ in rows], np.int64), [c for _, c in rows], budget,
                   sizes + 1 - Q * (budget + 1), hashes, np.r_[first, len(flat)], item[order],
                   place[order].astype(np.int64), seen, tiny, np.array(sorted(constant), np.uint32),
                   int((sizes + budget).max(initial=0)))

    def shorten(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """A text without the middles of its long runs of one character, and the places that are left."""
        if len(c) <= 2 * self.reach:
            return c, None
        edge = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        size = np.diff(np.r_[edge, len(c)])
        long = (size > 2 * self.reach) & ~np.isin(c[edge], self.constant)
        if not long.any():
            return c, None
        keep = np.ones(len(c), bool)
        for lo, n in zip(edge[long], size[long], strict=True):
            keep[lo + self.reach:lo + n - self.reach] = False
        return c[keep], np.flatnonzero(keep)

    def bands(self, text: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rows (text, item, band, hits) of bands that reach the bound; texts begin at starts of ``text``."""
        if len(text) < Q or not len(self.hashes):
            return np.zeros((0, 4), np.int64)
        h = grams(text)
        at = np.flatnonzero(self.seen[h >> _BITS])
        slot = np.searchsorted(self.hashes, h[at])
        slot[slot == len(self.hashes)] = 0
        real = self.hashes[slot] == h[at]
        at, slot = at[real], slot[real]
        times = self.first[slot + 1] - self.first[slot]
        if not len(at):
            return np.zeros((0, 4), np.int64)
        sizes = np.array(list(map(len, self.items)))
        most, many = int(sizes.max()), len(sizes)
        bits = most.bit_length()
        width = (int(np.diff(np.r_[starts, len(text)]).max()) + most) // int(self.budget.min() + 1) + 2
        cuts = np.r_[0, np.flatnonzero(np.diff(np.cumsum(times) // EXPAND)) + 1, len(at)]
        out, rows = [], np.zeros(0, np.int64)
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            n = times[lo:hi]
            total = np.cumsum(n)
            entry = np.repeat(self.first[slot[lo:hi]] - (total - n), n) + np.arange(total[-1])
            item, place = self.item[entry], self.place[entry]
            of = np.searchsorted(starts, at[lo:hi], side="right") - 1
            band = (np.repeat(at[lo:hi] - starts[of], n) - place + most) // (self.budget + 1)[item]
            row = ((np.repeat(of * many, n) + item) * width + band << bits) + place
            # Band j holds diagonals j and j + 1 steps on; a hit counts in the two bands that hold it.
            # What recurs in a text counts once: distinct places of the item among a band's hits.
            rows = np.sort(np.concatenate([rows, row, row[band > 0] - (1 << bits)]))
            rows = rows[np.r_[True, rows[1:] != rows[:-1]]]
            code = rows >> bits
            begin = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            code, hits = code[begin], np.diff(np.r_[begin, len(rows)])
            of, item, band = code // width // many, code // width % many, code % width
            past = starts[of] + (band + 2) * (self.budget[item] + 1) - most + sizes[item]
            settled = np.ones(len(code), bool) if hi == len(at) else past <= at[hi]
            out.append(np.stack([of, item, band, hits], axis=1)[settled & (hits >= self.need[item])])
            rows = rows[~np.repeat(settled, hits)]
        found = np.concatenate(out)
        return found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]

    def verify(self, text: np.ndarray, starts: np.ndarray, found: np.ndarray) -> list[tuple]:
        """(text, item, start, end, edits, hits) of bands whose alignment is within the budget."""
        out = []
        ends, most = np.r_[starts[1:] - 1, len(text)], max(map(len, self.items), default=0)
        for item in np.unique(found[:, 1]):
            k, c = int(self.budget[item]), self.items[item]
            width = 2 * (k + 1) + 2 * k
            rows = []
            for row in found[found[:, 1] == item]:
                # A verbatim copy needs no table.
                b, e = starts[row[0]], ends[row[0]]
                lo = max(b, b + row[2] * (k + 1) - most)
                at = _find(text[lo:min(e, lo + 2 * (k + 1) + len(c))], c)
                if at >= 0:
                    s = int(lo - b) + at
                    out.append((int(row[0]), int(item), s, s + len(c), 0, int(row[3])))
                else:
                    rows.append(row)
            rows = np.array(rows, np.int64).reshape(-1, 4)
            for part in np.array_split(rows, len(rows) * width // ALIGN_CELLS + 1) if len(rows) else ():
                # Lowest start in the text of an alignment whose diagonals lie in the band, k around it.
                low = part[:, 2] * (k + 1) - most - k
                begin, size = starts[part[:, 0]], ends[part[:, 0]] - starts[part[:, 0]]
                cost, start, end = align(text, begin, size, low, c, width)
                out += [(int(t), int(item), int(s), int(e), int(n), int(h)) for t, s, e, n, h
                        in zip(part[:, 0], start, end, cost, part[:, 3], strict=True) if n <= k]
        return out


def _find(text: np.ndarray, item: np.ndarray) -> int:
    """The first place of the item in the text, or -1."""
    data, sought = text.tobytes(), item.tobytes()
    at = data.find(sought)
    while at >= 0 and at % 4:
        at = data.find(sought, at + 1)
    return at // 4 if at >= 0 else -1


def align(text, begin, size, low, item, width):
    """Fewest edits of the whole item against each text on diagonals low .. low + width - 1.

    One table row per item character for all candidates at once. A cell packs the edits and the
    start, so that the fewest edits win and then the earliest start.
    """
    diagonal = low[:, None] + np.arange(width)
    one, far = np.int64(1) << 40, np.int64(1) << 60
    cell = np.where((diagonal >= 0) & (diagonal <= size[:, None]), diagonal, far)
    shift = np.arange(width) * one
    for i, c in enumerate(item):
        pos = diagonal + i
        inside = (pos >= 0) & (pos < size[:, None])
        same = text[np.where(inside, begin[:, None] + pos, 0)] == c
        step = np.where(inside, cell + np.where(same, 0, one), far)
        step[:, :-1] = np.minimum(step[:, :-1], cell[:, 1:] + one)  # the item's character has no partner
        step = np.minimum.accumulate(step - shift, axis=1) + shift  # the text's character has none
        cell = np.where((pos + 1 >= 0) & (pos + 1 <= size[:, None]), step, far)
    best = cell.argmin(axis=1)
    value = cell[np.arange(len(cell)), best]
    return value // one, value % one, diagonal[np.arange(len(cell)), best] + len(item)


def matches(index: Index, texts: list[str]) -> list[tuple]:
    """(text, item, start, end, edits, hits), the best of overlapping copies of one item."""
    out, lo = [], 0
    while lo < len(texts):
        parts, places, hi, size = [], [], lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SPAN_CHARS):
            whole = code_points(texts[hi])
            if len(whole) and index.tiny:
                ends = np.flatnonzero(whole != 32)[[0, -1]] if (whole != 32).any() else np.zeros(2, int)
                start, end = int(ends[0]), int(ends[1]) + 1
                if end - start < Q:
                    out += [(hi, i, start, end, 0, 0) for i in index.tiny.get(whole[start:end].tobytes(), ())]
            part, place = index.shorten(whole)
            parts.append(part)
            places.append(place)
            size += len(parts[-1]) + 1
            hi += 1
        starts = np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])
        gap = np.array([0xFFFFFFFF], np.uint32)  # between texts; in no item
        text = np.concatenate([x for p in parts for x in (p, gap)])[:-1]
        found = index.verify(text, starts, index.bands(text, starts))
        taken: dict[tuple[int, int], list] = {}
        for t, item, start, end, edits, hits in sorted(found, key=lambda x: (x[4], x[2], -x[5])):
            spans = taken.setdefault((t, item), [])
            if all(end <= s or start >= e for s, e in spans):
                spans.append((start, end))
                if places[t] is not None:
                    start, end = int(places[t][start]), int(places[t][end - 1]) + 1
                out.append((lo + t, item, start, end, edits, hits))
        lo = hi
    return sorted(out)


def indexes(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[Index]:
    """One index after the other, each of a block of about BLOCK_CHARS characters of the items."""
    rows = benchmark.select(F.col(key).cast("long").alias("item"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_CHARS)
    for b in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b) if blocks > 1 else rows
        yield Index.build([tuple(r) for r in part.orderBy("item").toArrow().to_pandas()
                           .itertuples(index=False, name=None)])


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per copy of an item in a document: key, item_id, start, end (code points, end
    exclusive), edits and shared_qgrams (hits in its band). Documents without copies have none.

    Null and empty texts and items match nothing. Items of fewer than MIN_ITEM characters match
    verbatim, those of fewer than Q only a text that is nothing else. Repeated rows give repeated matches; other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    names = ["item_id", "start", "end", "edits", "shared_qgrams"]
    schema = f"key {kind}, " + ", ".join(f"`{n}` long" for n in names)
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))

    def search(table):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = table.value
            for batch in batches:
                found = matches(index, batch.column(1).to_pylist())
                t, *rest = zip(*((f[0], int(index.ids[f[1]]), *f[2:]) for f in found), strict=True) if found \
                    else [()] * 6
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(t, pa.int64())),
                                                  *(pa.array(x, pa.int64()) for x in rest)], ["key", *names])
        return run

    out = spark.createDataFrame([], schema)
    for index in indexes(benchmark):
        out = out.unionAll(rows.mapInArrow(search(spark.sparkContext.broadcast(index)), schema))
    return out.withColumnRenamed("key", key)


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs``, all columns, without the documents that hold a copy of an item; no shuffle."""
    spark = docs.sparkSession
    small_batches(spark)
    at = docs.columns.index(text)

    def clean(table):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [t or "" for t in batch.column(at).to_pylist()]
                keep = np.ones(len(texts), bool)
                keep[[f[0] for f in matches(table.value, texts)]] = False
                yield batch.filter(pa.array(keep))
        return run

    for index in indexes(benchmark):
        docs = docs.mapInArrow(clean(spark.sparkContext.broadcast(index)), docs.schema)
    return docs
