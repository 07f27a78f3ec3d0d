"""Line dedup: range-partitioned line hashes, streamed in order, answered by keep bitmaps.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at least
``min_chars`` code points that occur in at least ``min_docs`` documents lose all their lines
except in the largest id that holds them.

Only hashes travel: (128-bit key hash, id, text fingerprint, position), range-partitioned and
sorted by hash, id and position. A task streams its range; a run of one hash that lies inside a
range is decided on the spot. Ranges are cut by hash *and* id, so a hash held by a third of all
documents is spread over as many tasks as it needs; the first and last run of each range, which
may go on next door, are written out and decided from a table of at most two hashes a range.
What comes back is a compressed bitmap of the lines to keep for each document that loses any.

Rows that share an id are one document. Null texts are one empty line; null ids are one document,
smaller than all others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import WHITE, small_batches, store, text_or_empty

LINES = "h1 long, h2 long, id long, fp long, pos int, n_lines int"
FLAGS = "open boolean, h1 long, h2 long, id long, fp long, pos int, n_lines int, first long"
# Below every id; a null id can't be sorted among numpy integers.
NO_ID = -(2**63)


def line_hashes(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """One row per line whose key has at least ``min_chars`` code points."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            digests, of, at, sizes = [], [], [], []
            for i, t in enumerate(batch.column(2).to_pylist()):
                lines = t.split("\n")
                for pos, line in enumerate(lines):
                    k = line.strip(WHITE)
                    if len(k) >= min_chars:
                        digests.append(xxhash.xxh3_128_digest(k.encode().lower()))  # bytes: only A-Z
                        of.append(i)
                        at.append(pos)
                        sizes.append(len(lines))
            h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            of = np.array(of, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (h[:, 0], h[:, 1], ids[of], fps[of],
                                       np.array(at, np.int32), np.array(sizes, np.int32))],
                ["h1", "h2", "id", "fp", "pos", "n_lines"])

    return (docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"),
                        fingerprint(text).alias("fp"), text_or_empty(text).alias("text"))
            .mapInArrow(run, LINES))


def fingerprint(text: str):
    return F.xxhash64(text_or_empty(text))


def _decided(rows: dict[str, np.ndarray], min_docs: int, skip_first: bool):
    """Masks over sorted rows of whole runs: lines to drop, and rows of the first run if it is open."""
    new_run = np.r_[True, (rows["h1"][1:] != rows["h1"][:-1]) | (rows["h2"][1:] != rows["h2"][:-1])]
    run = np.cumsum(new_run) - 1
    new_doc = new_run | np.r_[True, rows["id"][1:] != rows["id"][:-1]]
    docs = np.bincount(run, new_doc)
    last = np.r_[np.flatnonzero(new_run)[1:], len(run)] - 1
    drop = (docs[run] >= min_docs) & (rows["id"] != rows["id"][last][run])
    is_open = (run == 0) & skip_first
    return drop & ~is_open, is_open, new_doc


def stream_runs(lines: DataFrame, min_docs: int) -> DataFrame:
    """Lines to drop (open false), and the rows of runs at the ends of a range (open true)."""
    names = ["h1", "h2", "id", "fp", "pos", "n_lines"]

    def out(rows, mask, is_open, first):
        arrays = [np.full(int(mask.sum()), is_open), *(rows[n][mask] for n in names), first[mask].astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["open", *names, "first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []  # the run at the end of what was read, by parts
        at_start = True
        for batch in batches:
            if not batch.num_rows:
                continue
            got = {n: batch.column(i).to_numpy() for i, n in enumerate(names)}
            same = (got["h1"] == got["h1"][-1]) & (got["h2"] == got["h2"][-1])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if held and (held[0]["h1"][0], held[0]["h2"][0]) == (got["h1"][-1], got["h2"][-1]):
                held.append(got)  # all of one run
                continue
            done = [*held, {n: v[:cut] for n, v in got.items()}]
            held = [{n: v[cut:] for n, v in got.items()}]
            rows = {n: np.concatenate([d[n] for d in done]) for n in names}
            if len(rows["h1"]):
                drop, is_open, first = _decided(rows, min_docs, at_start)
                yield out(rows, drop, False, first)
                yield out(rows, is_open, True, first)
                at_start = False
        if held:
            rows = {n: np.concatenate([d[n] for d in held]) for n in names}
            _, _, first = _decided(rows, min_docs, False)
            yield out(rows, np.ones(len(first), bool), True, first)

    return (lines.repartitionByRange("h1", "h2", "id")
            .sortWithinPartitions("h1", "h2", "id", "fp", "pos").mapInArrow(run, FLAGS))


def keep_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 40,
                 min_docs: int = 5) -> DataFrame:
    """id, fp, n_dropped and keep (zlib of packed bits, one bit a line) for documents that lose lines."""
    lines = store(line_hashes(docs, key, text, min_chars), "lines")  # read twice: bounds, then ranges
    found = store(stream_runs(lines, min_docs), "line-runs")
    still = found.filter("open")
    # At most two runs a range are open, whatever the number of their rows.
    verdict = (still.groupBy("h1", "h2").agg(F.sum("first").alias("docs"), F.max("id").alias("last"))
               .filter(F.col("docs") >= min_docs).drop("docs"))
    late = still.join(F.broadcast(verdict), ["h1", "h2"]).filter("id <> last")
    columns = ["id", "fp", "n_lines", "pos"]
    drops = found.filter("not open").select(*columns).unionByName(late.select(*columns))

    @F.pandas_udf("binary")
    def bitmap(dropped: pd.Series, n_lines: pd.Series) -> pd.Series:
        maps = []
        for pos, n in zip(dropped, n_lines, strict=True):
            keep = np.ones(n, bool)
            keep[pos] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        return pd.Series(maps)

    return (drops.groupBy("id", "fp", "n_lines").agg(F.collect_set("pos").alias("dropped"))
            .select("id", "fp", F.size("dropped").cast("long").alias("n_dropped"),
                    bitmap("dropped", "n_lines").alias("keep")))


def _cut_lines(docs: DataFrame, key: str, text: str, min_chars: int, min_docs: int) -> DataFrame:
    """row (a struct of all columns but the text), n_lines, n_dropped and text (null where it was)."""
    maps = keep_bitmaps(docs, key, text, min_chars, min_docs)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, keeps: pd.Series) -> pd.Series:
        out = []
        for t, k in zip(texts, keeps, strict=True):
            if t is None or k is None:
                out.append(None)
                continue
            lines = t.split("\n")
            keep = np.unpackbits(np.frombuffer(zlib.decompress(k), np.uint8), count=len(lines))
            out.append("\n".join(line for line, kept in zip(lines, keep, strict=True) if kept))
        return pd.Series(out)

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text))
    rows = docs.select(row.alias("row"), F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"),
                       fingerprint(text).alias("fp"), F.col(text).alias("text"))
    joined = rows.join(maps, ["id", "fp"], "left")
    touched = F.when(F.col("keep").isNotNull(), F.col("text"))  # other texts do not travel to Python
    return joined.select("row", F.size(F.split(text_or_empty("text"), "\n")).cast("long").alias("n_lines"),
                         F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                         F.coalesce(cut(touched, "keep"), "text").alias("text"))


def drop_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 40,
               min_docs: int = 5) -> DataFrame:
    """key, n_lines (before dropping), n_dropped and text (the lines kept, joined by line breaks).

    Null or empty texts have one empty line and give an empty text. Other columns are not read,
    whatever their names; repeated rows stay repeated and lose the same lines.
    """
    cut = _cut_lines(docs.select(key, text), key, text, min_chars, min_docs)
    return cut.select("row.*", "n_lines", "n_dropped", F.coalesce("text", F.lit("")).alias("text"))


def without_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", size: str = "n_chars",
                  min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs``, all columns, with the lines dropped and ``size``, if it is there, counted anew.

    A document that loses all its lines stays, with an empty text; a null text stays null.
    """
    cut = _cut_lines(docs, key, text, min_chars, min_docs)
    columns = {c: F.col("text") if c == text else F.col(f"row.`{c}`") for c in docs.columns}
    if size in columns:
        # Where nothing was dropped the given count stays.
        columns[size] = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(columns[size]) \
            .cast(docs.schema[size].dataType)
    return cut.select(*(c.alias(n) for n, c in columns.items()))
