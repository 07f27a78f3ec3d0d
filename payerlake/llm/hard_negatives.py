"""Hard-negative mining by coordinate pruning in length buckets (in the manner of LEMP).

1. Index: rows are range-partitioned and sorted by their vectors' length, longest first, and cut
   into buckets of similar length (``LENGTH_RATIO``) of at most ``VALUES`` numbers. A bucket holds
   ids, labels, vectors and, for every coordinate, the order of its rows by the value of that
   coordinate in the vectors scaled to length 1. The index is written once, a row a bucket.
2. Search: anchors go against all buckets in blocks of about ``BLOCK``, one broadcast and one pass
   each. An anchor q with a score to beat t needs rows p with cos(q, p) >= t / (|q| * longest of the
   bucket). If that is above 1, the bucket is left out. Otherwise the ``FOCUS`` largest coordinates
   of q bound the rows: with the angle phi = arccos of that bound, and b and a the angles of q and p
   to the axis of a coordinate, |a - b| <= phi, so p's value lies between cos(b + phi) and
   cos(b - phi). Binary searches in the sorted lists give the range of rows of each coordinate;
   the shortest range is taken, and cut down to the rows that the other coordinates' ranges hold.
3. What is left is verified by its whole-number score. The score to beat rises with what a task has
   found, and starts at what the anchors of a block are to one another; each task passes on its
   best rows of an anchor, and a window keeps the best of those.

This runs twice: for the positives (best rows of the anchor's label), and then for the negatives
of all positives of an anchor at once, within [low * s, high * s] percent of a positive's score s.
Pruning never drops a row that could count (ranges are widened by more than float error), so the
result is exact. Blocks keep each broadcast bounded; no pair of rows other than anchor and row is
ever compared, and no row leaves its task but the few best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ._util import small_batches, store

VALUES = 1 << 16  # numbers in a bucket's vectors
LENGTH_RATIO, LEAST_ROWS = 0.9, 64
FOCUS = 3
BLOCK = 2048
SLACK = 1e-6


@dataclass
class Bucket:
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray  # rows x dimensions, whole numbers
    order: np.ndarray  # dimensions x rows: rows by ascending value of the unit vectors
    lengths: np.ndarray
    unit: np.ndarray = field(init=False)
    lists: np.ndarray = field(init=False)

    def __post_init__(self):
        self.unit = self.vectors / np.maximum(self.lengths, 1e-300)[:, None]
        # One ascending array of all coordinates' sorted lists, 4 apart.
        in_order = np.take_along_axis(self.unit.T, self.order, axis=1)
        self.lists = (in_order + 4.0 * np.arange(len(in_order))[:, None]).ravel()

    @classmethod
    def of(cls, ids, labels, vectors) -> Bucket:
        lengths = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        unit = vectors / np.maximum(lengths, 1e-300)[:, None]
        return cls(ids, labels, vectors, np.argsort(unit.T, axis=1, kind="stable"), lengths)


def scores(rows: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Whole-number inner products: in floats where they are exact, else in 64-bit integers."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(by).max(initial=0)) * max(rows.shape[-1], 1)
    if most < 2.0**53:
        return (rows.astype(float) @ by.astype(float).T).astype(np.int64)
    return rows.astype(np.int64) @ by.astype(np.int64).T


def feasible(bucket: Bucket, unit: np.ndarray, length: np.ndarray, beat: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(anchor, rows of the bucket that may score ``beat``) for anchors that may have any.

    ``unit`` and ``length``: the anchors' unit vectors and lengths; ``beat``: least scores of interest.
    """
    rows, dims = bucket.vectors.shape
    if not rows:
        return
    reach = length * bucket.lengths.max()
    need = np.where(beat > 0, beat / np.maximum(reach, 1e-300), -1.0)
    alive = np.flatnonzero((need <= 1 + SLACK) & (beat < np.inf))
    if not dims:
        for a in alive[beat[alive] <= 0]:
            yield int(a), np.arange(rows)
        return
    phi = np.arccos(np.clip(need[alive] - SLACK, -1, 1))
    k = min(FOCUS, dims)
    focus = np.argpartition(-np.abs(unit[alive]), k - 1, axis=1)[:, :k]
    own = np.arccos(np.clip(np.take_along_axis(unit[alive], focus, axis=1), -1, 1))
    low = np.cos(np.minimum(np.pi, own + phi[:, None])) - SLACK
    high = np.cos(np.maximum(0.0, own - phi[:, None])) + SLACK
    begin = np.searchsorted(bucket.lists, low + 4.0 * focus, side="left") - focus * rows
    end = np.searchsorted(bucket.lists, high + 4.0 * focus, side="right") - focus * rows
    shortest = np.argsort(end - begin, axis=1)
    for i, a in enumerate(alive.tolist()):
        f, *others = shortest[i]
        if begin[i, f] >= end[i, f]:
            continue
        found = bucket.order[focus[i, f], begin[i, f]:end[i, f]]
        for g in others:
            if end[i, g] - begin[i, g] < rows:
                value = bucket.unit[found, focus[i, g]]
                found = found[(value >= low[i, g]) & (value <= high[i, g])]
        if len(found):
            yield a, found


def _best(ids: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties by smaller id."""
    if len(ids) > 4 * k:
        keep = points >= np.partition(points, len(points) - k)[len(points) - k]
        ids, points = ids[keep], points[keep]
    order = np.lexsort((ids, -points))[:k]
    return ids[order], points[order]


@dataclass
class Anchors:
    """A block of anchors; of every anchor a list of windows of scores, each with the best rows found."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    same: bool  # look for rows of the anchors' label, or of others
    low: list[np.ndarray]
    high: list[np.ndarray]
    k: int

    def search(self, buckets: Iterator[Bucket]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(anchor, window, ids, scores): the best k rows of all buckets for each window."""
        lengths = np.sqrt((self.vectors.astype(float) ** 2).sum(axis=1))
        unit = self.vectors / np.maximum(lengths, 1e-300)[:, None]
        low = [x.copy() for x in self.low]
        beat = np.array([x.min() if len(x) else np.inf for x in low])
        best = {}
        for bucket in buckets:
            for a, rows in feasible(bucket, unit, lengths, beat):
                rows = rows[(bucket.labels[rows] == self.labels[a]) == self.same]
                rows = rows[bucket.ids[rows] != self.ids[a]]
                points = scores(bucket.vectors[rows], self.vectors[a])
                hit = points >= beat[a]
                if not hit.any():
                    continue
                ids, points = bucket.ids[rows[hit]], points[hit]
                for w in range(len(low[a])):
                    inside = (points >= low[a][w]) & (points <= self.high[a][w])
                    if not inside.any():
                        continue
                    had = best.get((a, w), (np.zeros(0, np.int64),) * 2)
                    best[a, w] = _best(np.r_[had[0], ids[inside]], np.r_[had[1], points[inside]], self.k)
                    if len(best[a, w][0]) == self.k:
                        low[a][w] = max(low[a][w], best[a, w][1][-1])
                beat[a] = low[a].min()
        for (a, w), found in best.items():
            yield a, w, *found


def whole_numbers(rows: DataFrame, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """id, label and the vector as floor(scale * x), of the rows that take part, one a key."""
    x = F.col(vector)
    fit = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    taken = (rows.withColumn("_label", label)
             .filter(F.col(key).isNotNull() & F.col("_label").isNotNull() & x.isNotNull() & F.coalesce(fit, F.lit(False)))
             .select(F.col(key).cast("long").alias("id"), F.col("_label").cast("long").alias("label"),
                     F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("v")))
    return (taken.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"))
            .select("id", "row.label", "row.v"))


def length_buckets(rows: DataFrame, dims: int) -> DataFrame:
    """The index: a row a bucket, from ``rows`` (id, label, v)."""
    most = max(LEAST_ROWS, min(VALUES // max(dims, 1), 1 << 16))

    def packed(ids, labels, vectors) -> list[bytes | int]:
        b = Bucket.of(ids, labels, vectors)
        narrow = vectors.astype(np.int32) if np.abs(vectors).max(initial=0) < 2**31 else vectors
        return [len(ids), ids.tobytes(), labels.tobytes(), narrow.tobytes(), b.order.astype(np.uint16).tobytes()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = labels = np.zeros(0, np.int64)
        vectors = np.zeros((0, dims), np.int64)

        def cut(done: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, labels, vectors
            lengths = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
            at, out = 0, []
            while at < len(ids) and (done or len(ids) - at > most):
                similar = int(np.count_nonzero(lengths[at:at + most] >= LENGTH_RATIO * lengths[at]))
                end = at + min(most, max(similar, LEAST_ROWS))
                out.append(packed(ids[at:end], labels[at:end], vectors[at:end]))
                at = end
            ids, labels, vectors = ids[at:], labels[at:], vectors[at:]
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("n", "ids", "labels", "vectors", "orders"), o, strict=True))
                                                  for o in out])

        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            part = np.zeros((len(sizes), dims), np.int64)
            part[np.arange(dims) < sizes[:, None]] = lists.flatten().to_numpy()
            ids, labels = (np.r_[x, batch.column(i).to_numpy()] for i, x in enumerate((ids, labels)))
            vectors = np.concatenate([vectors, part])
            yield from cut(False)
        yield from cut(True)

    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return (rows.withColumn("length", length).repartitionByRange(F.desc("length"), "id")
            .sortWithinPartitions(F.desc("length"), "id").select("id", "label", "v")
            .mapInArrow(run, "n long, ids binary, labels binary, vectors binary, orders binary"))


def unpack(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[Bucket]:
    for batch in batches:
        for row in batch.to_pylist():
            n = row["n"]
            wide = np.int32 if len(row["vectors"]) == 4 * n * dims else np.int64
            yield Bucket(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64),
                         np.frombuffer(row["vectors"], wide).reshape(n, dims),
                         np.frombuffer(row["orders"], np.uint16).reshape(dims, n).astype(np.int64),
                         np.sqrt((np.frombuffer(row["vectors"], wide).reshape(n, dims).astype(float) ** 2).sum(axis=1)))


def _scan(index: DataFrame, block: Anchors, dims: int) -> DataFrame:
    """Every task's best rows: anchor, place (of the window), id, score."""
    given = index.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = given.value
        for a, w, ids, points in anchors.search(unpack(batches, dims)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), x, np.int64)) for x in (anchors.ids[a], w)] + [pa.array(ids), pa.array(points)],
                ["anchor", "place", "id", "score"])

    return index.mapInArrow(run, "anchor long, place long, id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _seeds(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, k: int) -> list[np.ndarray]:
    """The k-th best score of each anchor among the block's other anchors of its label: no row below counts."""
    out = []
    for a in range(len(ids)):
        own = scores(vectors[(labels == labels[a]) & (ids != ids[a])], vectors[a])
        out.append(np.array([np.partition(own, len(own) - k)[len(own) - k] if len(own) >= k else np.iinfo(np.int64).min]))
    return out


def hard_negatives(rows: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding",
                   label: Column | None = None, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    The rows for which ``anchors`` holds are searched against all rows, in blocks. A score is the inner
    product of vectors floor(scale * x); it has to fit into a long, and wraps if it doesn't. The
    positives of an anchor are its best ``positives`` other rows of its label, and for each of them
    the best ``negatives`` rows of other labels with low * p <= 100 * n <= high * p are returned,
    ranked from 1; ties go to the smaller id. A positive score below 0 has no such rows.

    Rows with a null key, label or vector or a null, NaN or infinite component take no part. Rows that
    share a key count once, as the one with the smallest label, then vector. A vector shorter than the
    longest counts as filled up with zeros; one of length 0 scores 0. Other columns are not read, except
    by ``label`` and ``anchors``; an empty table, or one without anchors, gives no rows.
    """
    spark = rows.sparkSession
    small_batches(spark)
    named = F.col("label") if label is None else label
    plain = store(whole_numbers(rows, key, vector, named, scale), "vectors")
    dims = plain.agg(F.max(F.size("v"))).first()[0] or 0
    index = store(length_buckets(plain, dims), "buckets")
    chosen = rows.filter(anchors).select(F.col(key).cast("long").alias("id")).distinct()
    asked = store(plain.join(chosen, "id", "left_semi"), "anchors")
    blocks = -(-asked.count() // BLOCK)
    out = scratch_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    for b in range(blocks):
        # About BLOCK anchors, by a hash of the id.
        block = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id").toArrow()
        ids, labels = (block.column(c).to_numpy() for c in ("id", "label"))
        vectors = np.zeros((len(ids), dims), np.int64)
        for i, v in enumerate(block.column("v").to_pylist()):
            vectors[i, :len(v)] = v
        whole = np.array([np.iinfo(np.int64).max])
        seeds = _seeds(ids, labels, vectors, positives)
        first = Anchors(ids, labels, vectors, True, seeds, [whole] * len(ids), positives)
        near = store(_top(_scan(index, first, dims), positives)
                     .select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                             (F.col("rank") - 1).cast("long").alias("place")), "positives")
        # At most ``positives`` rows an anchor of the block.
        held: dict[int, list[int]] = {}
        for r in near.orderBy("anchor", "place").toLocalIterator():
            held.setdefault(r.anchor, []).append(r.positive_score)
        tops = [np.array(held.get(i, []), np.int64) for i in ids.tolist()]
        # 100 n >= low p and 100 n <= high p, in whole numbers; below 0 the window is empty.
        lows = [-(-low * t // 100) for t in tops]
        highs = [np.where(t < 0, np.iinfo(np.int64).min, high * t // 100) for t in tops]
        second = Anchors(ids, labels, vectors, False, lows, highs, negatives)
        (_top(_scan(index, second, dims), negatives).join(near, ["anchor", "place"])
         .select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
                 F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
         .write.mode("append").parquet(out))
    return spark.read.schema(schema).parquet(out)
