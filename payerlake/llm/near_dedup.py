"""Near-duplicate components by an LSH forest over MinHash signatures.

1. Every document's set of distinct word shingles gives a 128-bit set hash and ``HASHES`` minima.
   Documents with equal sets are one class, named by its smallest id; only one of them goes on.
2. The forest: ``TREES`` orders of all classes, each by its own sequence of ``DEPTH`` minima,
   range-partitioned over the whole sequence and the id, so that a group of copies spreads over
   as many tasks as it needs. In each order a task streams its range and finds the neighbours
   with the longest common prefixes: a region of classes that share ``MIN_DEPTH`` minima is taken
   as it is while it has at most ``REGION`` classes. One that has more is taken in windows of REGION
   that overlap by half, so that each class meets the 256 before it and the 256 after it in the
   order, and is deepened by one minimum at a time where a deeper region is larger than a window's
   overlap. The trees' sequences have no minimum in common and use all of them.
3. Inside a region whole signatures are compared, and each class proposes its ``PARTNERS`` most
   similar classes and says if it has further likely ones. Proposed pairs are confirmed on the full
   shingle sets, and confirmed links joined to components.
4. What is left is decided region by region: the classes that said so form the orders again, and
   each region sends the classes that have likely partners in other components to one group, with
   their full sets. There all pairs of the region's classes are decided at once (a product of the
   classes' shingle table with itself), and only links between components come out, which are merged
   into the stars found so far. A class is shipped once a region and never once a pair, so the work of
   a family of similar texts grows with its classes, also where no pair of them is a link.
5. Where more than ``REGION`` classes share ``MIN_DEPTH`` minima, two classes need not meet in one
   of ``TREES`` orders. Such crowds go through 4 again with ``TREES`` further orders, other sequences
   of the same minima; a crowd of REGION * CROWD ** r classes gets r + 1 further batches of orders.

All parameters are fixed numbers; nothing depends on the input's size.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import narrow, small_batches, store, text_or_empty
from .components import merged, stars

HASHES, TREES, DEPTH, MIN_DEPTH = 128, 8, 16, 2
REGION, PARTNERS, CROWD = 512, 3, 2
BLOCK, OVERLAP = 8192, 512
# Similarity is estimated from the minima's low bytes; a pair is proposed from this far below the limit.
MARGIN = 0.15
SPAN_BYTES = 4_000_000
# Shingles of the classes decided in one group; classes of more are dealt out by pairs of parts.
VOLUME, COLUMNS = 4_000_000, 4096

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 2**64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a finalizer of two multiplications)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(1, np.uint64)
    return (np.cumprod(np.r_[one, np.full(size, _ODD)]), np.cumprod(np.r_[one, np.full(size, _INVERSE)]))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (A-Z lower-cased) of all texts, and the words' text numbers."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
    edge = np.diff(np.r_[True, white].view(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(np.diff(np.r_[white, True].view(np.int8)) == 1) + 1
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _powers(1 << int(len(data)).bit_length())
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * up[:len(data)])]
    h = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    first = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    return h, np.searchsorted(first, start, side="right") - 1


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, sorted within each text, and each text's number of them.

    A text of fewer than ``width`` words has its whole sequence as one shingle; without words, none.
    """
    h, of = word_hashes(texts)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    words = np.bincount(of, minlength=len(texts))
    shingles, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(h) >= width:
        n = len(h) - width + 1
        whole = of[:n] == of[width - 1:]
        total = np.zeros(n, np.uint64)
        for j in range(width):
            total += h[j:n + j] * factors[j]
        shingles, owner = mix(total[whole]), of[:n][whole]
    short = (words < width)[of]
    if short.any():
        place = np.arange(len(of)) - np.searchsorted(of, of)
        part = np.zeros(len(texts), np.uint64)
        np.add.at(part, of[short], h[short] * factors[place[short]])
        few = np.flatnonzero((words > 0) & (words < width))
        shingles = np.r_[shingles, mix(part[few] + words[few].astype(np.uint64))]
        owner = np.r_[owner, few]
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    if len(owner):
        new = np.r_[True, (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])]
        shingles, owner = shingles[new], owner[new]
    return shingles, np.bincount(owner, minlength=len(texts))


def _spans(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Cut a batch where its texts add up to SPAN_BYTES; a longer text goes alone, and whole."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > SPAN_BYTES:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if texts:
        yield lo, len(texts)


@functools.lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    n = np.arange(1, HASHES + 1, dtype=np.uint64)
    return ((mix(n) >> np.uint64(32)).astype(np.uint32) | np.uint32(1),
            (mix(n + np.uint64(HASHES)) >> np.uint64(32)).astype(np.uint32))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The HASHES minima of one set."""
    a, b = _functions()
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for lo in range(0, len(x), 512):
        values = x[lo:lo + 512, None] * a
        values += b
        np.minimum(best, values.min(axis=0), out=best)
    return best


def signatures(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """id, n (set size), h1 and h2 (set hash) and sig (the minima, 32 bits each) per row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            n, h1, h2, sig = [], [], [], []
            for lo, hi in _spans(texts):
                flat, sizes = shingle_sets(texts[lo:hi], width)
                for part in np.split(flat, np.cumsum(sizes)[:-1]):
                    n.append(len(part))
                    h1.append(int(mix(part).sum().astype(np.int64)))
                    h2.append(int(mix(part + _ODD).sum().astype(np.int64)))
                    sig.append(minima(part).tobytes() if len(part) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 pa.array(sig, pa.binary())], ["id", "n", "h1", "h2", "sig"])

    return (docs.select(F.col(key).cast("long").alias("id"), text_or_empty(text).alias("text"))
            .mapInArrow(run, "id long, n long, h1 long, h2 long, sig binary"))


def full_sets(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """id and its whole shingle set as sorted longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            for lo, hi in _spans(texts):
                flat, sizes = shingle_sets(texts[lo:hi], width)
                offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int64)))],
                    ["id", "shingles"])

    return (docs.select(F.col(key).cast("long").alias("id"), text_or_empty(text).alias("text"))
            .mapInArrow(run, "id long, shingles array<long>"))


def sequences(batch: int) -> np.ndarray:
    """The minima of each tree's sequence, trees x DEPTH; all minima, in another deal each batch."""
    deal = np.random.default_rng(batch).permutation(HASHES) if batch else np.arange(HASHES)
    return deal.reshape(TREES, DEPTH)


def forest(classes: DataFrame, batch: int = 0) -> DataFrame:
    """One row per class and tree: the tree's minima as sortable bytes, and the signature's low bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            sig = np.frombuffer(b"".join(rows.column(2).to_pylist()), "<u4").reshape(-1, HASHES)
            low = pa.array([r.tobytes() for r in sig.astype(np.uint8)], pa.binary())
            for t, of in enumerate(sequences(batch)):
                keys = sig[:, of].astype(">u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sig), t, np.int32)), pa.array([k.tobytes() for k in keys], pa.binary()),
                     rows.column(0), rows.column(1), rows.column(3), low],
                    ["tree", "key", "id", "n", "component", "low"])

    return (classes.select("id", "n", "sig", "component")
            .mapInArrow(run, "tree int, key binary, id long, n long, component long, low binary"))


def _likely(n, component, low, limit: float) -> np.ndarray | None:
    """Estimated similarity of the classes of a region, 0 where it is far below the limit or of one component."""
    m = len(n)
    if (component == component[0]).all():
        return None
    same = np.empty((m, m), np.float32)
    for i in range(m):
        same[i] = (low == low[i]).sum(axis=1)
    likely = (same / HASHES - 1 / 256) * (256 / 255)
    ratio = np.minimum(n[:, None], n) / np.maximum(n[:, None], n)
    likely[(ratio < limit) | (component[:, None] == component)] = 0
    likely[likely < limit - MARGIN] = 0
    return likely


def _propose_region(ids, n, component, low, limit: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each class's best partners by estimated similarity; a class that has more is paired with itself."""
    likely = _likely(n, component, low, limit)
    if likely is None:
        return []
    m = len(ids)
    if m <= PARTNERS + 1:
        a, b = np.nonzero(np.triu(likely))
        return [(np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b]))]
    chosen = np.zeros((m, m), bool)
    chosen[np.arange(m)[:, None], np.argpartition(-likely, PARTNERS - 1, axis=1)[:, :PARTNERS]] = True
    chosen |= chosen.T
    a, b = np.nonzero(np.triu(chosen & (likely > 0)))
    left = ids[((likely > 0) & ~chosen).any(axis=1)]
    return [(np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])), (left, left)]


def _gather_region(ids, n, component, low, limit: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """(group, class) of the classes with likely partners in other components, as one group or,
    beyond VOLUME shingles, as a group of every two parts."""
    likely = _likely(n, component, low, limit)
    if likely is None:
        return []
    chosen = np.flatnonzero(likely.any(axis=1))
    if not len(chosen):
        return []
    chosen = chosen[np.argsort(ids[chosen])]
    part = (np.cumsum(n[chosen]) - n[chosen]) * 2 // VOLUME
    parts = [chosen[part == p] for p in np.unique(part)]
    groups = [chosen] if len(parts) <= 2 else [np.r_[x, y] for i, x in enumerate(parts) for y in parts[i + 1:]]
    # Regions of the same classes in other trees are the same group.
    return [(np.full(len(g), mix(ids[g].astype(np.uint64)).sum().astype(np.int64)), ids[g]) for g in groups]


def _regions(prefix: np.ndarray, lo: int, hi: int, depth: int, windows: bool = True) -> Iterator[tuple[int, int]]:
    """Cut rows lo..hi, which share depth minima, into regions; prefix[i]: minima i-1 and i share.

    ``windows``: no windows go over these rows yet.
    """
    step = REGION // 2
    if hi - lo < 2:
        return
    if hi - lo <= REGION:
        yield lo, hi
        return
    if windows:
        for at in range(lo, hi - step, step):
            yield at, min(at + REGION, hi)
    if depth < DEPTH:
        cuts = lo + 1 + np.flatnonzero(prefix[lo + 1:hi] <= depth)
        for a, b in zip([lo, *cuts], [*cuts, hi], strict=True):
            if b - a > step:  # else it lies in a window
                yield from _regions(prefix, a, b, depth + 1, False)


def over_regions(trees: DataFrame, decide, names: tuple[str, ...]) -> DataFrame:
    """The distinct rows of numbers that ``decide`` (ids, n, component, low) gives for each region of
    the forest's orders, streamed from sorted ranges."""
    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        ids, n, component = (table.column(c).to_numpy() for c in ("id", "n", "component"))
        keys = np.frombuffer(b"".join(table.column("key").to_pylist()), ">u4").reshape(-1, DEPTH)
        low = np.frombuffer(b"".join(table.column("low").to_pylist()), np.uint8).reshape(-1, HASHES)
        tree = table.column("tree").to_numpy()
        equal = (keys[1:] == keys[:-1]) & (tree[1:] == tree[:-1])[:, None]
        prefix = np.r_[0, np.cumprod(equal, axis=1).sum(axis=1)]
        cuts = [0, *np.flatnonzero(prefix[1:] < MIN_DEPTH) + 1, len(ids)]
        found = [(np.zeros(0, np.int64),) * len(names)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            for lo, hi in _regions(prefix, a, b, MIN_DEPTH):
                found += decide(ids[lo:hi], n[lo:hi], component[lo:hi], low[lo:hi])
        rows = np.unique(np.stack([np.concatenate(x) for x in zip(*found, strict=True)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BLOCK:
                yield block(held)
                # The next block starts with the last rows of this one.
                tail = pa.Table.from_batches(held).slice(rows - OVERLAP).combine_chunks()
                held, rows = tail.to_batches(), OVERLAP
        if rows:
            yield block(held)

    return (trees.repartitionByRange("tree", "key", "id").sortWithinPartitions("tree", "key", "id")
            .mapInArrow(run, ", ".join(f"{x} long" for x in names)).distinct())


def propose(trees: DataFrame, limit: float) -> DataFrame:
    """Candidate pairs a < b of classes; a = b has more likely partners than it was paired with."""
    return over_regions(trees, lambda *region: _propose_region(*region, limit), ("a", "b"))


def gather(trees: DataFrame, limit: float) -> DataFrame:
    """group, id, component: the classes to be decided together, of bounded number and size."""
    def gathered(ids, n, component, low) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        order = np.argsort(ids)
        return [(group, own, component[order[np.searchsorted(ids, own, sorter=order)]])
                for group, own in _gather_region(ids, n, component, low, limit)]

    return over_regions(trees, gathered, ("group", "id", "component"))


def crowded(classes: DataFrame, batch: int, most: int, groups: DataFrame | None = None) -> DataFrame:
    """id of the classes that share MIN_DEPTH leading minima of some tree with more than ``most`` - 1
    others, not all of them of one component, by ``groups`` (node, component) or the classes' own
    column. Only members of such crowds are joined to components; a crowd is named by a hash of its tree and minima, as a collision only adds a comparison."""
    starts = F.array(*(F.xxhash64(F.lit(t), *(F.substring("sig", 4 * int(i) + 1, 4) for i in of[:MIN_DEPTH]))
                       for t, of in enumerate(sequences(batch))))
    prefix = classes.select("id", F.explode(starts).alias("crowd"))
    crowds = store(narrow(prefix.groupBy("crowd").agg(F.count("*").alias("size")).filter(F.col("size") > most)
                          .select("crowd")), "crowds")
    if crowds.isEmpty():
        return classes.select("id").limit(0)
    members = store(prefix.join(crowds, "crowd", "left_semi"), "members")
    if groups is None:
        groups = classes.select(F.col("id").alias("node"), "component")
    mixed = (named_by(members, groups).groupBy("crowd")
             .agg(F.min("component").alias("least"), F.max("component").alias("greatest"))
             .filter(F.col("least") < F.col("greatest")).select("crowd"))
    return members.join(mixed, "crowd", "left_semi").select("id").distinct()


def of_links(links: DataFrame) -> DataFrame:
    """node and component of the stars' links; a component's smallest class has no row."""
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def named_by(classes: DataFrame, groups: DataFrame) -> DataFrame:
    """``classes`` with the component of each, its own id where it has no link."""
    return (classes.join(groups.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("component", F.coalesce("component", "id")))


def linked(ids: np.ndarray, sizes: np.ndarray, shingles: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of classes with their full sets, one after the other: each linked class with the smallest one it reaches."""
    m = len(ids)
    names, column = np.unique(shingles, return_inverse=True)
    row = np.repeat(np.arange(m), sizes)
    shared = np.bincount(column, minlength=len(names)) > 1  # the others add to no pair
    use = shared[column]
    row, column = row[use], (np.cumsum(shared) - 1)[column[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    overlap = np.zeros((m, m))
    for lo in range(0, int(shared.sum()), COLUMNS):
        begin, end = np.searchsorted(column, [lo, lo + COLUMNS])
        part = np.zeros((m, COLUMNS), np.float32)
        part[row[begin:end], column[begin:end] - lo] = 1
        overlap += part @ part.T
    overlap = overlap.astype(np.int64)
    near = 100 * overlap >= percent * (sizes[:, None] + sizes - overlap)
    near |= ids[:, None] == ids  # rows that share a key are one node
    root = ids.copy()
    while True:
        least = np.where(near, root, np.iinfo(np.int64).max).min(axis=1)
        if (least == root).all():
            break
        root = least
    far = root != ids
    return ids[far], root[far]


def decide_groups(groups: DataFrame, docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """Links a, b of the components that links within a group (group, id, component) join, by the classes' full sets."""
    sets = full_sets(docs.join(groups.select(F.col("id").alias(key)).distinct(), key, "left_semi"), key, text, width)

    def decide(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        own = table.column("shingles").chunk(0) if table.num_rows else None
        if own is None:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        ids = table.column("id").to_numpy()
        a, b = linked(ids, np.diff(own.offsets.to_numpy()), own.flatten().to_numpy(), percent)
        names, at = np.unique(ids, return_index=True)
        a, b = (table.column("component").to_numpy()[at[np.searchsorted(names, x)]] for x in (a, b))
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)])[:, a != b], axis=1)
        return pa.table({"a": pairs[0], "b": pairs[1]})

    return groups.join(sets, "id").groupBy("group").applyInArrow(decide, "a long, b long").distinct()


def confirm(pairs: DataFrame, docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the limit, in whole numbers."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias(key)).distinct()
    sets = full_sets(docs.join(wanted, key, "left_semi"), key, text, width)
    both = (pairs.join(sets.withColumnsRenamed({"id": "a", "shingles": "sa"}), "a")
            .join(sets.withColumnsRenamed({"id": "b", "shingles": "sb"}), "b"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return (both.select("a", "b", shared.alias("shared"), (F.size("sa") + F.size("sb") - shared).alias("all"))
            .filter(F.col("shared") * 100 >= F.col("all") * percent).select("a", "b"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5,
                    percent: int = 85) -> DataFrame:
    """key, n_shingles, component_id (smallest key reachable over links) and kept per row of ``docs``.

    Two documents are linked if 100 * shared shingles >= percent * all shingles of both. A null,
    empty or blank text has no shingles and no links. Rows that share a key are one node and are
    all kept or all not; a null key has no links, component null, and is kept. Other columns are
    not read, whatever their names; an empty table gives an empty one.
    """
    limit = percent / 100
    sig = store(signatures(docs, key, text, width), "signatures")
    named = sig.filter("n > 0 AND id IS NOT NULL")
    classes = store(named.groupBy("h1", "h2", "n").agg(F.min("id").alias("rep")), "classes")
    reps = store(named.join(classes.select(F.col("rep").alias("id")), "id", "left_semi").select("id", "n", "sig"),
                 "representatives")
    proposed = store(narrow(propose(forest(reps.withColumn("component", F.col("id"))), limit)), "proposed")
    links = stars(store(confirm(proposed.filter("a <> b"), docs, key, text, width, percent), "confirmed"))

    todo, batch = proposed.filter("a = b").select(F.col("a").alias("id")), 0
    while not batch or not todo.isEmpty():
        todo = store(named_by(reps.join(todo, "id", "left_semi"), of_links(links)), "left")
        regions = store(narrow(gather(forest(todo, batch), limit)), "regions")
        if not regions.isEmpty():
            found = store(narrow(decide_groups(regions, docs, key, text, width, percent)), "decided")
            if not found.isEmpty():
                links = merged(links, found)
        batch += 1
        todo = crowded(reps, batch, REGION * CROWD ** (batch - 1), of_links(links))
    of_class = (classes.join(of_links(links).withColumnRenamed("node", "rep"), "rep", "left")
                .select("h1", "h2", "n", F.coalesce("component", "rep").alias("component")))
    out = sig.drop("sig").join(of_class, ["h1", "h2", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5,
             percent: int = 85) -> DataFrame:
    """``docs``, all columns, with the smallest key's document of each component; null keys stay."""
    gone = near_duplicates(docs.select(key, text), key, text, width, percent).filter("NOT kept").select(key).distinct()
    return docs.join(gone, key, "left_anti").select(*(f"`{c}`" for c in docs.columns))
