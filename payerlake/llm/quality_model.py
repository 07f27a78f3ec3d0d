"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text is a sparse vector of three groups of features:

* its words (A-Z lower-cased) by a hash into ``BUCKETS`` places, weighted by 1 + log(count) and
  scaled to length 1, whatever the text's length;
* statistics of its structure (``STATS``), each a share or a clipped size that is spread over the
  two nearest ``KNOTS`` of its own, so that it acts as a piecewise linear curve;
* metadata: the row's ``n_chars`` on a log scale in the same way; a null has no such feature.

The machine's score is the logistic of

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

and every text is scored in time linear in its features by the sum-of-squares identity

    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

It is fitted by Adagrad with fixed seeds on a bounded sample of labelled rows (``TRAIN_ROWS``,
``TRAIN_CHARS``); scoring reads whole texts in one map, without a shuffle, and broadcasts
``BUCKETS`` x (``FACTORS`` + 1) numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import hash_sample, small_batches, text_or_empty
from .near_dedup import word_hashes

TRAIN_ROWS, TRAIN_CHARS = 5000, 20_000
BUCKETS, FACTORS = 1 << 14, 8
EPOCHS, ROWS_A_STEP, RATE, PULL = 12, 128, 0.1, 1e-4
SPAN_BYTES = 2_000_000

KNOTS = np.array([0.0, 0.01, 0.03, 0.06, 0.1, 0.15, 0.25, 0.4, 0.6, 0.8, 1.0])
# Shares of bytes, of words and of lines, and sizes (scaled to 0..1) of a text.
STATS = ("upper", "digit", "sign", "stop_sign", "non_ascii", "blank", "capital_words", "upper_words", "sign_words",
         "sign_ended_words", "repeated_words", "equal_neighbours", "top_word", "word_size", "log_words", "lines_a_word")
METADATA = ("log_n_chars",)
GROUPS = (*STATS, *METADATA)
WIDTH = BUCKETS + len(GROUPS) * len(KNOTS)

# Byte classes; bytes of characters beyond ASCII count as letters.
_OTHER, _UPPER, _LOWER, _DIGIT, _STOP, _SIGN, _WIDE, _WHITE = range(8)


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, _SIGN, np.uint8)
    kinds[:32] = _OTHER
    kinds[127] = _OTHER
    kinds[128:] = _WIDE
    for chars, kind in (("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), ("abcdefghijklmnopqrstuvwxyz", _LOWER),
                        ("0123456789", _DIGIT), (".,;:!?'\"()-", _STOP), (" \t\n\v\f\r", _WHITE)):
        kinds[list(chars.encode())] = kind
    return kinds


CLASSES = _byte_classes()


@dataclass
class Rows:
    """Sparse rows: features of row i are index/value[offsets[i]:offsets[i + 1]]."""

    index: np.ndarray
    value: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.offsets)[rows]
        offsets = np.r_[0, np.cumsum(sizes)]
        at = np.arange(offsets[-1]) + np.repeat(self.offsets[rows] - offsets[:-1], sizes)
        return Rows(self.index[at], self.value[at], offsets)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def statistics(texts: list[bytes], n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """STATS and METADATA of each text, 0 to 1 (nan: unknown); the words' hashes and text numbers."""
    m = len(texts)
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, m)
    kinds = CLASSES[data]
    of_byte = np.repeat(np.arange(m), sizes + 1)
    counts = np.bincount(of_byte * 8 + kinds, minlength=8 * m).reshape(m, 8).astype(float)
    counts[:, _WHITE] -= 1  # the one between texts
    lines = np.bincount(of_byte[data == 10], minlength=m)
    solid = np.maximum(sizes - counts[:, _WHITE], 0)
    hashes, of = word_hashes(texts)
    words = np.bincount(of, minlength=m)
    edge = np.diff(np.r_[True, kinds == _WHITE].view(np.int8))
    start = np.flatnonzero(edge == -1)
    end = np.flatnonzero(np.diff(np.r_[kinds == _WHITE, True].view(np.int8)) == 1) + 1

    def words_with(test: np.ndarray) -> np.ndarray:
        return _share(np.bincount(of, weights=test, minlength=m), words)

    ups, signs = (np.r_[0, np.cumsum(kinds == k)] for k in (_UPPER, _SIGN))
    letters = np.r_[0, np.cumsum((kinds == _LOWER) | (kinds == _WIDE))]
    capital = kinds[start] == _UPPER if len(start) else np.zeros(0, bool)
    all_upper = (ups[end] - ups[start] >= 2) & (letters[end] == letters[start])
    neighbour = np.r_[False, (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])]
    order = np.lexsort((hashes, of))
    new = np.r_[True, (np.diff(of[order]) != 0) | (hashes[order][1:] != hashes[order][:-1])][:len(of)]
    first = np.flatnonzero(new)
    times = np.diff(np.r_[first, len(of)])
    top = np.zeros(m)
    np.maximum.at(top, of[order][first], times)
    distinct = np.bincount(of[order][first], minlength=m)
    shares = [_share(counts[:, k], solid) for k in (_UPPER, _DIGIT, _SIGN, _STOP, _WIDE)]
    table = np.column_stack([
        *shares, _share(counts[:, _WHITE], sizes), words_with(capital), words_with(all_upper),
        words_with(signs[end] > signs[start]), words_with(kinds[end - 1] == _SIGN if len(end) else capital),
        _share(words - distinct, words), words_with(neighbour), _share(top, words),
        np.minimum(_share(solid, words) / 20, 1), np.minimum(np.log1p(words) / 12, 1),
        np.minimum(_share(lines, words), 1), np.minimum(np.log1p(np.maximum(n_chars, 0)) / 16, 1)])
    return table, hashes, of


def featurise(texts: list[bytes], n_chars: np.ndarray) -> Rows:
    """The sparse features of texts; ``n_chars`` is nan where it is not known."""
    m = len(texts)
    table, hashes, of = statistics(texts, n_chars)
    places, times = np.unique(of * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    value = 1 + np.log(times)
    owner = places // BUCKETS
    value /= np.sqrt(np.bincount(owner, weights=value * value, minlength=m))[owner]
    known = ~np.isnan(table)
    row, group = np.nonzero(known)
    x = np.clip(table[known], 0, 1)
    low = np.clip(np.searchsorted(KNOTS, x, side="right") - 1, 0, len(KNOTS) - 2)
    upper = (x - KNOTS[low]) / (KNOTS[low + 1] - KNOTS[low])
    base = BUCKETS + group * len(KNOTS) + low
    owners = np.r_[owner, row, row]
    index = np.r_[places % BUCKETS, base, base + 1]
    values = np.r_[value, 1 - upper, upper]
    order = np.argsort(owners, kind="stable")
    return Rows(index[order], values[order], np.r_[0, np.cumsum(np.bincount(owners, minlength=m))])


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # WIDTH
    factors: np.ndarray  # WIDTH x FACTORS

    def sums(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """The logits, and the factors' sums; every row has features, those of its structure."""
        start = rows.offsets[:-1]
        scaled = self.factors[rows.index] * rows.value[:, None]
        total = np.add.reduceat(scaled, start, axis=0)
        linear = np.add.reduceat(self.weights[rows.index] * rows.value, start)
        squares = np.add.reduceat((scaled * scaled).sum(axis=1), start)
        return self.bias + linear + 0.5 * ((total * total).sum(axis=1) - squares), total

    def score(self, rows: Rows) -> np.ndarray:
        if not len(rows):
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.sums(rows)[0], -30, 30)))


def train(rows: Rows, good: np.ndarray) -> Machine:
    """Adagrad on the logistic loss; without rows, or of one label only, every text scores alike."""
    rng = np.random.default_rng(13)
    model = Machine(0.0, np.zeros(WIDTH), rng.normal(0, 0.05, (WIDTH, FACTORS)))
    share = float(good.mean()) if len(good) else 0.5
    if share in (0.0, 1.0) or not len(good):
        return Machine(8.0 * share - 4.0 if len(good) else 0.0, model.weights, np.zeros_like(model.factors))
    model.bias = float(np.log(share / (1 - share)))
    seen_bias, seen_w, seen_v = 1e-6, np.full(WIDTH, 1e-6), np.full((WIDTH, FACTORS), 1e-6)
    for _ in range(EPOCHS):
        for chosen in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // ROWS_A_STEP)):
            part = rows.take(chosen)
            logit, total = model.sums(part)
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - good[chosen]) / len(chosen)
            of = np.repeat(np.arange(len(part)), np.diff(part.offsets))
            pulled = error[of] * part.value
            used = np.unique(part.index)
            place = np.searchsorted(used, part.index)
            grad = np.bincount(place, weights=pulled, minlength=len(used)) + PULL * model.weights[used]
            seen_w[used] += grad * grad
            inner = pulled[:, None] * (total[of] - model.factors[part.index] * part.value[:, None])
            model.weights[used] -= RATE * grad / np.sqrt(seen_w[used])
            grad = np.column_stack([np.bincount(place, weights=inner[:, f], minlength=len(used))
                                    for f in range(FACTORS)]) + PULL * model.factors[used]
            seen_v[used] += grad * grad
            model.factors[used] -= 0.3 * RATE * grad / np.sqrt(seen_v[used])
            seen_bias += error.sum() ** 2
            model.bias -= RATE * error.sum() / np.sqrt(seen_bias)
    return model


def _spans(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > SPAN_BYTES:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if texts:
        yield lo, len(texts)


def _joined(parts: list[Rows]) -> Rows:
    sizes = np.concatenate([np.zeros(0, np.int64), *(np.diff(p.offsets) for p in parts)])
    return Rows(np.concatenate([np.zeros(0, np.int64), *(p.index for p in parts)]),
                np.concatenate([np.zeros(0), *(p.value for p in parts)]), np.r_[0, np.cumsum(sizes)])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars",
        label: str = "quality", rows: int = TRAIN_ROWS) -> Machine:
    """A machine from at most ``rows`` labelled documents of at most ``TRAIN_CHARS`` characters.

    The sample is drawn from the labels by a hash of the key, so that only it meets the texts.
    Null keys, labels and texts are left out; of repeated labels the lowest counts.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    sample = (hash_sample(known, key, rows).groupBy(key).agg(F.min(label).cast("int").alias("label"))
              .orderBy(F.xxhash64(key), key).limit(rows))
    size = F.col(n_chars).cast("double") if n_chars else F.lit(None).cast("double")
    short = docs.filter(F.length(text) <= TRAIN_CHARS).select(key, F.col(text).alias("text"), size.alias("size"))
    # At most ``rows`` keys and labels.
    found = (short.join(F.broadcast(sample), key).orderBy(key, "text").limit(rows)
             .select("text", "size", "label").toArrow())
    texts = [t.encode() for t in found.column("text").to_pylist()]
    sizes = found.column("size").cast(pa.float64()).fill_null(float("nan")).to_numpy()
    parts = [featurise(texts[lo:hi], sizes[lo:hi]) for lo, hi in _spans(texts)]
    good = np.array(found.column("label").to_pylist(), np.int64)
    return train(_joined(parts), (good >= 1).astype(float))


def score_quality(docs: DataFrame, model: Machine, key: str = "doc_id", text: str = "text",
                  n_chars: str | None = "n_chars", carry: Column | None = None, threshold: float = 0.5) -> DataFrame:
    """key, score (0 to 1) and predicted (1 from the threshold on) per row of ``docs``, and a boolean
    column ``carried`` if given.

    Null texts count as empty ones, which have the features of a text of no words; a null ``n_chars``
    (or none named) leaves its features out. Only key, text and ``n_chars`` are read, whatever other
    columns are named; repeated rows and null keys give a row each, an empty table none.
    """
    spark = docs.sparkSession
    small_batches(spark)
    table = spark.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = table.value
        for batch in batches:
            texts = [t.encode() for t in batch.column(2).to_pylist()]
            sizes = batch.column(3).fill_null(float("nan")).to_numpy()
            parts = [machine.score(featurise(texts[lo:hi], sizes[lo:hi])) for lo, hi in _spans(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.concatenate([np.zeros(0), *parts]))],
                ["key", "carried", "score"])

    size = F.col(n_chars).cast("double") if n_chars else F.lit(None).cast("double")
    out = (docs.select(F.col(key).alias("key"), (F.lit(False) if carry is None else carry).alias("carried"),
                       text_or_empty(text).alias("text"), size.alias("size"))
           .mapInArrow(run, f"key {kind}, carried boolean, score double")
           .withColumnRenamed("key", key)
           .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
    return out if carry is not None else out.drop("carried")
