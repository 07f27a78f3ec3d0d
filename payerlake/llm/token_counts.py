"""Token counts by a two-tier lookup on the map side.

Pre-tokens are runs of blanks with the text up to the next blank; a line break starts one as well
where no piece of the vocabulary contains it. No piece has a blank behind another character, so
pieces never reach over a pre-token's edge and a text's count is the sum of its pre-tokens' counts
(the constructor checks both facts on the model and refuses others).

Tier one is a table of the most frequent pre-tokens' lengths, learned from a bounded sample of
the texts (``SAMPLE`` rows) and broadcast: at most ``FREQUENT`` entries of at most ``ENTRY_BYTES``
bytes, whatever the input's size. Tier two is a cache in each Python worker; what both lack is
encoded by the library. The tables only save work: every count is the library's. No pre-token is
shuffled, counted globally or sent between executors.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import small_batches, text_or_empty

SAMPLE = 2_000
FREQUENT = 65_536
ENTRY_BYTES = 32
CACHE = 600_000
NORMAL = 1  # the type of ordinary pieces in a model file


class Lengths:
    """The library's token counts of pre-tokens, with a cache of those met so far."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(path, "rb") as f:
            model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        spec, pieces = model.normalizer_spec, [p.piece for p in model.pieces if p.type == NORMAL]
        if (spec.name != "identity" or spec.precompiled_charsmap or spec.remove_extra_whitespaces
                or not spec.add_dummy_prefix or any("▁" in p.lstrip("▁") for p in pieces)
                or any(p.type == 4 for p in model.pieces)):
            raise ValueError("this model's pieces do not end at blanks; its texts can't be counted by pre-token")
        breaks = not any("\n" in p for p in pieces)
        self.split = re.compile(r" +[^ \n]*|\n[^ \n]*" if breaks else r" +[^ ]*").findall
        self.library = SentencePieceProcessor(model_file=path)
        self.tiers = Tiers({})

    def pretokens(self, text: str) -> list[str]:
        """The library puts a blank in front of a text and reads U+2581 as one."""
        return self.split(" " + text.replace("▁", " ")) if text else []

    def encode(self, words: list[str]) -> list[int]:
        """A line break's pre-token is encoded behind the library's own blank, which is taken off."""
        ids = self.library.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        return [len(x) - (w[0] == "\n") if w != " " else 1 for w, x in zip(words, ids, strict=True)]

    def counts(self, texts: list[str], frequent: dict[str, int]) -> list[int]:
        if frequent is not self.tiers.first:
            self.tiers = Tiers(frequent)
        elif len(self.tiers.second) > CACHE:
            self.tiers.second = {}
        tiers, words = self.tiers, [self.pretokens(t) for t in texts]
        new = [w for w in set().union(*words) if w not in frequent and w not in tiers.second]
        tiers.second.update(zip(new, self.encode(new), strict=True))
        return [sum(map(tiers.__getitem__, ws)) for ws in words]


class Tiers(dict):
    """The broadcast table; a miss goes to the worker's cache."""

    def __init__(self, first: dict[str, int]):
        super().__init__(first)
        self.first, self.second = first, {}

    def __missing__(self, word: str) -> int:
        return self.second[word]


@functools.lru_cache(maxsize=2)
def worker(path: str) -> Lengths:
    return Lengths(path)


def frequent_lengths(docs: DataFrame, path: str, text: str = "text") -> dict[str, int]:
    """Lengths of the most frequent short pre-tokens in a sample of about ``SAMPLE`` texts."""
    rows = docs.count()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, found = worker(path), Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                found.update(w for w in lengths.pretokens(t) if len(w.encode()) <= ENTRY_BYTES)
        top = heapq.nlargest(FREQUENT, found.items(), key=lambda x: (x[1], x[0]))
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()),
                                          pa.array([n for _, n in top], pa.int64())], ["word", "n"])

    top = (docs.select(text_or_empty(text).alias("text"))
           .sample(fraction=min(1.0, SAMPLE / max(rows, 1)), seed=7)
           .mapInArrow(count, "word string, n long")
           .groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").toArrow())
    words = top.column("word").to_pylist()
    return dict(zip(words, worker(path).encode(words), strict=True)) if words else {}


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 limit: int = 4096) -> DataFrame:
    """key, n_bytes, n_tokens and over_limit per row of ``docs``.

    A null or empty text has no bytes and no tokens. Other columns are not read, whatever their
    names; repeated rows stay repeated; keys may be null; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, text))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = worker(path)
        for batch in batches:
            n = lengths.counts(batch.column(1).to_pylist(), table.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())],
                                             ["key", "n_bytes", "n_tokens"])

    text_column = text_or_empty(text)
    return (docs.select(F.col(key).alias("key"), text_column.alias("text"),
                        F.octet_length(text_column).cast("long").alias("n_bytes"))
            .mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
            .withColumnRenamed("key", key)
            .withColumn("over_limit", F.col("n_tokens") > limit))
