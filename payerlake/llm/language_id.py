"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths run over them, each filter's maximum over a
fixed-length window is kept, and a softmax over the maxima gives the window's language. The
network is trained in numpy, by Adam on the cross entropy, on windows of a bounded sample:
``TRAIN_ROWS`` labelled rows, of each one stretch of ``TRAIN_BYTES`` bytes at a place that follows
from its key. Prediction covers whole texts: every window of every text is classified, in
batches, and a text's language has the highest mean log probability over its windows, weighted
by their bytes. The weights (some 10 KB) are the only thing broadcast; there is no shuffle of texts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import hash_sample, small_batches

TRAIN_ROWS, TRAIN_BYTES = 4000, 512
WINDOW, EMBED, FILTERS, WIDTHS = 128, 6, 12, (2, 3, 4)  # the widest is even: bytes are looked up in pairs
EPOCHS, BATCH, RATE = 3, 128, 0.01
PER_CALL = 64  # windows convolved at a time, so that the tables stay in the processor's cache
UNKNOWN = "und"


@dataclass
class ByteNet:
    """Weights; ``filters`` has the widest filter's rows, narrower ones are zero beyond their width."""

    languages: list[str]
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def new(cls, languages: list[str], rng: np.random.Generator) -> ByteNet:
        embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        embed[0] = 0  # padding
        n = FILTERS * len(WIDTHS)
        filters = rng.normal(0, 0.3, (max(WIDTHS), EMBED, n)).astype(np.float32) * cls.reach()
        return cls(languages, embed, filters.reshape(-1, n), np.zeros(n, np.float32),
                   rng.normal(0, 0.3, (n, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))

    @staticmethod
    def reach() -> np.ndarray:
        """1 where a filter of its width has a weight."""
        return np.repeat(np.arange(max(WIDTHS))[:, None] < np.array(WIDTHS), FILTERS, axis=1)[:, None, :]

    def patches(self, windows: np.ndarray) -> np.ndarray:
        """Every position's bytes under the widest filter, embedded; positions over the end see padding."""
        x = self.embed[np.pad(windows, ((0, 0), (0, max(WIDTHS) - 1)))]
        view = np.lib.stride_tricks.sliding_window_view(x, max(WIDTHS), axis=1)  # n, place, embed, offset
        return view.transpose(0, 1, 3, 2).reshape(len(windows), windows.shape[1], -1)

    def maxima(self, patches: np.ndarray) -> np.ndarray:
        return patches.reshape(-1, patches.shape[2]) @ self.filters

    @functools.cached_property
    def pair_tables(self) -> list[np.ndarray]:
        """What each pair of bytes adds to every filter, by the pair's offset under the widest filter."""
        pairs = np.concatenate([np.repeat(self.embed, 256, axis=0), np.tile(self.embed, (256, 1))], axis=1)
        return [pairs @ self.filters[at * EMBED:(at + 2) * EMBED] for at in range(0, max(WIDTHS), 2)]

    def log_odds(self, windows: np.ndarray) -> np.ndarray:
        """Log probabilities of each language for each window (rows of bytes), from the trained weights."""
        result = np.empty((len(windows), len(self.languages)), np.float32)
        size = windows.shape[1]
        for lo in range(0, len(windows), PER_CALL):
            b = np.pad(windows[lo:lo + PER_CALL], ((0, 0), (0, max(WIDTHS) - 1))).T.astype(np.intp)
            pairs = b[:-1] * 256 + b[1:]  # place, window
            total = self.pair_tables[0][pairs[:size]]
            for i, table in enumerate(self.pair_tables[1:], 1):
                total += table[pairs[2 * i:2 * i + size]]
            h = np.maximum(total.max(axis=0) + self.bias, 0)
            result[lo:lo + PER_CALL] = log_softmax(h @ self.out + self.out_bias)
        return result

    def train(self, windows: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> None:
        """Minimise the cross entropy, languages weighted alike."""
        weight = (len(labels) / np.maximum(np.bincount(labels, minlength=len(self.languages)), 1))[labels]
        weight = (weight / weight.mean()).astype(np.float32)
        params = [self.embed, self.filters, self.bias, self.out, self.out_bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        reach = np.broadcast_to(self.reach(), (max(WIDTHS), EMBED, len(self.bias))).reshape(self.filters.shape)
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(labels))
            for lo in range(0, len(order), BATCH):
                at = order[lo:lo + BATCH]
                grads = self.gradients(windows[at], labels[at], weight[at])
                grads[1] *= reach
                step += 1
                for p, g, m, v in zip(params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                self.embed[0] = 0

    def gradients(self, windows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        n, f = len(windows), len(self.bias)
        patches = self.patches(windows)
        a = self.maxima(patches).reshape(n, -1, f)
        place = a.argmax(axis=1)  # only the maximum's position has a gradient
        raw = np.take_along_axis(a, place[:, None], axis=1)[:, 0] + self.bias
        h = np.maximum(raw, 0)
        d = np.exp(log_softmax(h @ self.out + self.out_bias))
        d[np.arange(n), labels] -= 1
        d *= (weight / n)[:, None]
        dh = (d @ self.out.T) * (raw > 0)
        best = patches[np.arange(n)[:, None], place]  # n, filter, offset * embed
        d_filters = np.einsum("nfk,nf->kf", best, dh)
        d_patch = (dh[:, :, None] * self.filters.T[None]).reshape(n, f, max(WIDTHS), EMBED)
        under = np.minimum(place[:, :, None] + np.arange(max(WIDTHS)), windows.shape[1] - 1)
        d_embed = np.zeros_like(self.embed)
        np.add.at(d_embed, windows[np.arange(n)[:, None, None], under], d_patch)
        return [d_embed, d_filters, dh.sum(axis=0), h.T @ d, d.sum(axis=0)]


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def cut_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts (the last of a text padded with zeros), their texts and their bytes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    n = -(-sizes // WINDOW)
    flat = np.frombuffer(b"".join(t + bytes(-len(t) % WINDOW) for t in texts), np.uint8)
    of = np.repeat(np.arange(len(texts)), n)
    inside = np.full(len(of), WINDOW)
    inside[(np.cumsum(n) - 1)[sizes > 0]] = ((sizes - 1) % WINDOW + 1)[sizes > 0]
    return flat.reshape(-1, WINDOW), of, inside


def fit(labelled: DataFrame, key: str, text: str, label: str, rows: int = TRAIN_ROWS) -> ByteNet | None:
    """A network from at most ``rows`` rows with a text and a label, or None without any."""
    place = F.xxhash64(F.col(key))
    size = F.greatest(F.length(text) - TRAIN_BYTES, F.lit(1))
    sample = (hash_sample(labelled.filter(F.col(label).isNotNull()), key, rows).filter(F.col(text).rlike(r"\p{L}"))
              .select(F.substr(text, (F.pmod(place, size) + 1).cast("int"), F.lit(TRAIN_BYTES)).alias("text"),
                      F.col(label).alias("label"), place.alias("place"))
              .orderBy("place", "text").limit(rows).select("text", "label").toArrow())
    texts = [t.encode() for t in sample.column("text").to_pylist()]
    labels = sample.column("label").to_pylist()
    if not texts:
        return None
    rng = np.random.default_rng(11)
    net = ByteNet.new(sorted(set(labels)), rng)
    windows, of, _ = cut_windows(texts)
    net.train(windows, np.array([net.languages.index(x) for x in labels])[of], rng)
    return net


def predict(net: ByteNet, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    """Language and mean probability of each text; empty texts are unknown."""
    windows, of, inside = cut_windows(texts)
    odds = net.log_odds(windows)
    weight = inside.astype(np.float64)
    total = np.bincount(of, weight, minlength=len(texts))
    mean, chance = (np.stack([np.bincount(of, weight * x[:, i], minlength=len(texts))
                              for i in range(len(net.languages))], axis=1) / np.maximum(total, 1)[:, None]
                    for x in (odds, np.exp(odds)))
    best = mean.argmax(axis=1)
    score = np.clip(chance[np.arange(len(texts)), best], 0, 1)
    return ([net.languages[b] if t else UNKNOWN for b, t in zip(best, total, strict=True)],
            np.where(total > 0, score, 0.0))


def identify(docs: DataFrame, net: ByteNet | None, key: str = "doc_id", text: str = "text",
             carry: Column | None = None) -> DataFrame:
    """key, lang_pred and score per row of ``docs``, and a boolean column ``carried`` if given.

    A text that is null, empty or without a letter is ``und`` with score 0, and so is every text
    where there was nothing to learn from. Only key and text are read, whatever other columns are
    named; repeated rows stay repeated.
    """
    spark = docs.sparkSession
    small_batches(spark)
    table = spark.sparkContext.broadcast(net)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column(2).to_pylist()]
            found, score = predict(table.value, texts) if table.value else \
                ([UNKNOWN] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()),
                                              pa.array(score)], ["key", "carried", "lang_pred", "score"])

    letters = F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).otherwise("")
    out = (docs.select(F.col(key).alias("key"), (F.lit(False) if carry is None else carry).alias("carried"),
                       letters.alias("text"))
           .mapInArrow(run, f"key {kind}, carried boolean, lang_pred string, score double")
           .withColumnRenamed("key", key))
    return out if carry is not None else out.drop("carried")
