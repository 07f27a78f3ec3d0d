"""Byte-level BPE: encoding and decoding with DuckDB queries inside each partition.

Every partition splits its texts with the tokenizer's pattern. Words its worker has not met yet
become token-position rows, one per byte, and one recursive query contracts all of them at once:
each step joins the positions with the merge table, finds each word's minimum rank and contracts
its leftmost pair, until no pair of any word is in the table. In words of more than ``LONG``
bytes, where no later merge can undercut a rank (``safe``, worked out from the table), the other
non-overlapping pairs of that rank go in the same step, since they would be the next minima
anyway; runs of one token then take a logarithmic number of steps. Words of more than ``WINDOW``
bytes are encoded in overlapping windows, joined at tokens that two windows share (``windows``
says why that is exact), so that the work grows with a word's length and not with its square.
Decoding joins token rows with the vocabulary and concatenates their bytes in the order of their
positions.

The merge table is a vocabulary file: about 100,000 pairs, loaded once per Python worker. The
workers' caches of encoded words only save work and are emptied at ``CACHE_WORDS`` entries.
There is no shuffle: a lost executor costs its own partitions.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import small_batches, text_or_empty

CACHE_WORDS = 800_000
# Token rows in one DuckDB query; a batch of texts is decoded in as many queries as it needs.
DECODE_ROWS = 1_000_000
ENCODE_BYTES = 500_000
# Words of more bytes go through RUNS, whose steps do not grow with the length of a run.
LONG = 64
# Words of more bytes are encoded in windows of this size that overlap by half.
WINDOW = 128
WINDOW_BYTES = 100_000

# One pair a word and step. A row is a token: fin is the byte where it ends, nxt the token after it.
# The smallest rank wins, then the leftmost; the pair's second row takes the merged token over.
STEPS = """
WITH RECURSIVE state AS (
  SELECT word, fin, len, tok, nxt, false AS done FROM init
  UNION ALL (
    WITH live AS MATERIALIZED (
      SELECT s.word, s.fin, s.len, s.tok, s.nxt, (m.id::BIGINT << 46) | (s.fin << 6) | s.len AS rank
      FROM state s LEFT JOIN merges m ON m.a = s.tok AND m.b = s.nxt WHERE NOT s.done),
    best AS (
      SELECT word, rank, (rank >> 46)::INTEGER AS id, (rank >> 6) & ((1::BIGINT << 40) - 1) AS fin,
             (rank & 63)::INTEGER AS len
      FROM (SELECT word, min(rank) AS rank FROM live GROUP BY word))
    SELECT l.word, l.fin, CASE WHEN l.fin - l.len = b.fin THEN l.len + b.len ELSE l.len END,
           CASE WHEN l.fin - l.len = b.fin THEN b.id ELSE l.tok END,
           CASE WHEN l.fin = b.fin - b.len THEN b.id ELSE l.nxt END, b.rank IS NULL
    FROM live l JOIN best b ON b.word = l.word WHERE b.rank IS NULL OR l.fin <> b.fin
  )
)
SELECT word, list(tok ORDER BY fin) AS ids FROM state WHERE done GROUP BY word ORDER BY word
"""

# All non-overlapping pairs of the minimum rank at once, where that rank is safe: in a run of one
# token, every second pair from the run's start.
RUNS = """
WITH RECURSIVE state AS (
  SELECT word, fin AS pos, tok, CASE WHEN nxt >= 0 THEN fin + 1 ELSE -1 END AS npos, nxt, false AS done FROM init
  UNION ALL (
    WITH live AS MATERIALIZED (
      SELECT s.word, s.pos, s.tok, s.npos, s.nxt, m.id AS mid, m.safe
      FROM state s LEFT JOIN merges m ON m.a = s.tok AND m.b = s.nxt WHERE NOT s.done),
    best AS MATERIALIZED (SELECT word, min(mid) AS mid, min((mid::BIGINT << 40) | pos) AS rank FROM live GROUP BY word),
    cand AS MATERIALIZED (
      SELECT l.word, l.pos, l.npos, l.tok, l.nxt, l.mid, l.safe, (l.mid::BIGINT << 40) | l.pos = b.rank AS leftmost
      FROM live l JOIN best b ON b.word = l.word AND b.mid = l.mid),
    runs AS (
      SELECT *, row_number() OVER w AS rn, lag(npos) OVER w IS DISTINCT FROM pos AS starts
      FROM cand WHERE safe AND tok = nxt WINDOW w AS (PARTITION BY word ORDER BY pos)),
    islands AS (
      SELECT *, max(CASE WHEN starts THEN rn END) OVER (PARTITION BY word ORDER BY pos) AS first FROM runs),
    pick AS MATERIALIZED (
      SELECT pos, npos, mid FROM cand WHERE (safe AND tok <> nxt) OR (NOT safe AND leftmost)
      UNION ALL SELECT pos, npos, mid FROM islands WHERE (rn - first) % 2 = 0)
    SELECT l.word, l.pos, coalesce(second.mid, l.tok), coalesce(after.npos, l.npos),
           coalesce(after.mid, l.nxt), b.mid IS NULL
    FROM live l JOIN best b ON b.word = l.word
    LEFT JOIN pick second ON second.npos = l.pos
    LEFT JOIN pick after ON after.pos = l.npos
    ANTI JOIN pick gone ON gone.pos = l.pos
  )
)
SELECT word, list(tok ORDER BY pos) AS ids FROM state WHERE done GROUP BY word ORDER BY word
"""

# bytes: one character for each byte (Latin-1).
DECODE = """
SELECT t.doc, string_agg(v.bytes, '' ORDER BY t.pos) AS bytes
FROM toks t JOIN vocab v ON v.id = t.id GROUP BY t.doc
"""


class BytePairs:
    """One worker's DuckDB connection with a vocabulary, its merge table and the words met so far."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks = ranks
        if max(map(len, ranks)) > 63:
            raise ValueError("tokens of more than 63 bytes do not fit the packed ranks")
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        self.length[list(ranks.values())] = list(map(len, ranks))
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        pairs = [(ranks[w[:i]], ranks[w[i:]], r) for w, r in ranks.items()
                 for i in range(1, len(w)) if w[:i] in ranks and w[i:] in ranks]
        a, b, m = (np.array(x, np.int32) for x in zip(*pairs, strict=True))
        # A merge is safe if its token is a part of no token of lower rank.
        lowest = np.full(max(ranks.values()) + 1, np.iinfo(np.int32).max, np.int32)
        np.minimum.at(lowest, a, m)
        np.minimum.at(lowest, b, m)
        merges = pa.table({"a": a, "b": b, "id": m, "safe": lowest[m] > m})
        vocab = pa.table({"id": pa.array(list(ranks.values()), pa.int32()),
                          "bytes": [w.decode("latin-1") for w in ranks]})
        for name, table in (("merges", merges), ("vocab", vocab)):
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)

    def _add(self, words: list[str], ids: list[np.ndarray]) -> None:
        n = len(self.index)
        self.index.update(zip(words, range(n, n + len(words)), strict=True))
        self.flat = np.concatenate([self.flat, *ids])
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, ids), np.int64, len(ids))])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def contract(self, words: list[bytes], steps: str) -> list[np.ndarray]:
        """The ids of each (non-empty) word, by the recursive query ``steps``."""
        data = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        tok = self.byte_id[data]
        nxt = np.append(tok[1:], -1)
        nxt[np.cumsum(sizes) - 1] = -1
        given = pa.table({"word": np.repeat(np.arange(len(words), dtype=np.int32), sizes), "tok": tok, "nxt": nxt,
                          "fin": np.arange(1, len(data) + 1), "len": np.ones(len(data), np.int32)})
        self.db.register("init", given)
        found = self.db.sql(steps).to_arrow_table().column("ids").combine_chunks()
        self.db.unregister("init")
        flat, offsets = found.values.to_numpy(), found.offsets.to_numpy()
        return [flat[offsets[i]:offsets[i + 1]] for i in range(len(words))]

    def contract_all(self, words: list[bytes], steps: str, size: int) -> list[np.ndarray]:
        """``contract``, some ``size`` bytes at a time."""
        ends = np.cumsum([len(w) for w in words])
        cuts = [0, *(np.flatnonzero(np.diff(ends // size)) + 1), len(words)]
        return [ids for lo, hi in zip(cuts, cuts[1:], strict=False) if hi > lo
                for ids in self.contract(words[lo:hi], steps)]

    def windows(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of long words, joined from those of overlapping windows.

        Tokens in a row are the encoding of their bytes if every two neighbours are the encoding of
        theirs: the first merge across a border would also come up in the two neighbours alone. So two
        windows that have a token in common, at one place, are joined at it. Neighbouring windows
        without a common token become one window, if need be up to the whole word.
        """
        half = WINDOW // 2
        parts = [(w, lo, min(lo + WINDOW, len(b))) for w, b in enumerate(words)
                 for lo in range(0, max(len(b) - half, 1), half)]
        known: dict[tuple[int, int, int], np.ndarray] = {}
        while True:
            new = [p for p in parts if p not in known]
            known.update(zip(new, self.contract_all([words[w][lo:hi] for w, lo, hi in new], RUNS, WINDOW_BYTES),
                             strict=True))
            joints = [self._joint(a, known[a], b, known[b]) for a, b in zip(parts, parts[1:], strict=False)]
            wider, i = [], 0
            while i < len(parts):
                alone = i < len(joints) and joints[i] is None and parts[i][0] == parts[i + 1][0]
                wider.append((*parts[i][:2], parts[i + alone][2]))
                i += 1 + alone
            if len(wider) == len(parts):
                break
            parts = wider
        out: list[list[np.ndarray]] = [[] for _ in words]
        first = 0
        for part, joint in zip(parts, [*joints, None], strict=True):
            out[part[0]].append(known[part][first:joint and joint[0]])
            first = joint[1] if joint else 0
        return [np.concatenate(x) for x in out]

    def _joint(self, a: tuple, ids_a: np.ndarray, b: tuple, ids_b: np.ndarray) -> tuple[int, int] | None:
        """How many tokens of windows a and b end with the first one they have in common."""
        if a[0] != b[0]:
            return None
        places = []
        for (_, lo, _), ids in ((a, ids_a), (b, ids_b)):
            size = self.length[ids]
            places.append((lo + np.cumsum(size)) * 64 + size)
        _, i, j = np.intersect1d(*places, assume_unique=True, return_indices=True)
        return (int(i[0]) + 1, int(j[0]) + 1) if len(i) else None

    def learn(self, words: list[str]) -> None:
        """Encode words the cache lacks, a bounded number of bytes at a time."""
        known = [w for w in words if w.encode() in self.ranks]
        self._add(known, [np.array([self.ranks[w.encode()]], np.int32) for w in known])
        rest = [(w, w.encode()) for w in words if w not in self.index]
        for least, most, encode in (
                (0, LONG, lambda x: self.contract_all(x, STEPS, ENCODE_BYTES)),
                (LONG, WINDOW, lambda x: self.contract_all(x, RUNS, WINDOW_BYTES)),
                (WINDOW, np.inf, self.windows)):
            part = [x for x in rest if least < len(x[1]) <= most]
            if part:
                self._add([w for w, _ in part], encode([b for _, b in part]))

    def encode(self, words: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in one array and the number of ids of each text; ``words`` holds the
        texts' words one after the other, ``counts`` the number of words of each text."""
        if len(self.index) > CACHE_WORDS:
            self.forget()
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.index]
        if new:
            self.learn(new)
        of = np.fromiter((self.index[w] for w in distinct), np.int64, len(distinct))
        of = of[coded.indices.to_numpy()] if distinct else of
        sizes = self.sizes[of]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.starts[of] - total[:-1], sizes) + np.arange(total[-1])]
        return ids, np.diff(total[np.concatenate([[0], np.cumsum(counts)])])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each text, by ordered aggregation over its token rows."""
        out: list[bytes] = []
        ends = np.cumsum(counts)
        lo = 0
        while lo < len(counts):
            base = ends[lo] - counts[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, base + DECODE_ROWS, side="right")))
            doc = np.repeat(np.arange(hi - lo), counts[lo:hi])
            part = ids[base:ends[hi - 1]]
            self.db.register("toks", pa.table({"doc": doc, "pos": np.arange(len(part)), "id": part}))
            got = self.db.sql(DECODE).to_arrow_table()
            self.db.unregister("toks")
            found = dict(zip(got.column("doc").to_pylist(), got.column("bytes").to_pylist(), strict=True))
            out += [found.get(i, "").encode("latin-1") for i in range(hi - lo)]
            lo = hi
        return out


@functools.lru_cache(maxsize=2)
def worker(path: str) -> BytePairs:
    return BytePairs(path)


def encode_decode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """key, ids (array of int) and decoded (binary, back from the ids) per row of ``docs``.

    The texts are split by ``pattern`` in the JVM, with Unicode's white space for ``\\s``.
    A null or empty text has no ids and decodes to no bytes. Other columns are not read, whatever
    their names; repeated rows stay repeated; keys may be null. Special strings of a tokenizer are
    ordinary text. ``path`` names a rank file that every executor can read.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker(path)
        for batch in batches:
            words = batch.column(1)
            ids, counts = bpe.encode(words.flatten(), np.diff(words.offsets.to_numpy()))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                 pa.array(bpe.decode(ids, counts), pa.binary())], ["key", "ids", "decoded"])

    words = F.regexp_extract_all(text_or_empty(text), F.lit("(?U)" + pattern), F.lit(0))
    return (docs.select(F.col(key).alias("key"), words.alias("words"))
            .mapInArrow(run, f"key {kind}, ids array<int>, decoded binary")
            .withColumnRenamed("key", key))
