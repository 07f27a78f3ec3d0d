"""Exact cosine top-k retrieval over an embedding table.

Every Arrow batch of corpus vectors is scored against the queries in matrix
products of at most ``TILE_VALUES`` scores.  A task holds the k best rows per
query of all its batches, which alone leave it; ``row_number() ≤ k`` over those
rows picks the final ones.  No corpus × query row is ever formed, and a task's
memory depends on neither the batch's nor the queries' number.  The query
matrix is a Spark broadcast of at most ``BLOCK_VALUES`` numbers; more queries
than that are scored in successive blocks, by the same plan, so their number
has no limit.

Query vectors themselves are derived from the table: the centroid of each
label, a vector mean in one aggregate (``pyspark.ml.stat.Summarizer``).

A vector that is NULL, has a zero norm or another length than the query has
no score and is not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_VALUES = 1_000_000  # numbers of one broadcast query block (8 MB of doubles)
TILE_VALUES = 1_000_000  # scores held at once by a task
OUT_ROWS = 10_000


def centroids(emb: DataFrame, key: str = "label", vec: str = "embedding") -> DataFrame:
    """One mean vector per key value, over its vectors that are not NULL or empty."""
    rows = emb.filter(F.size(vec) > 0).select(key, array_to_vector(F.col(vec).cast("array<double>")).alias("v"))
    return rows.groupBy(key).agg(Summarizer.mean(F.col("v")).alias("m")).select(
        F.col(key).alias("query_id"), vector_to_array("m").alias("query_vec"))


def _score_block(corpus: DataFrame, queries: list, id_col: str, vec: str, k: int) -> DataFrame:
    """The k best rows per query of every task."""
    by_size: dict[int, tuple[list, np.ndarray]] = {}
    for size in {len(q.query_vec) for q in queries}:
        own = [q for q in queries if len(q.query_vec) == size]
        matrix = np.array([q.query_vec for q in own], np.float64)
        norm = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
        use = norm[:, 0] > 0
        by_size[size] = ([q.query_id for q, u in zip(own, use, strict=True) if u], matrix[use] / norm[use])
    blocks = corpus.sparkSession.sparkContext.broadcast(by_size)
    tile, out_rows = TILE_VALUES, OUT_ROWS

    # Nested, so that workers get them with the task: they need not have this package.
    def best_of_tile(scores: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Query and row numbers of the k best of each query's scores, none below its floor (ties by row number)."""
        if scores.shape[1] > k and np.isneginf(floor).any():
            floor = np.maximum(floor, np.partition(scores, -k, axis=1)[:, -k])
        q, at = np.nonzero((scores >= floor[:, None]) & np.isfinite(scores))
        order = np.lexsort((at, -scores[q, at], q))
        q, at = q[order], at[order]
        first = np.arange(len(q)) - np.searchsorted(q, q) < k
        return q[first], at[first]

    def best_rows(rows: pa.Table) -> pa.Table:
        """The k best rows of each query, in order (ties by item id, as the final window has them)."""
        rows = rows.take(pc.sort_indices(rows, [("query", "ascending"), ("score", "descending"), ("item_id", "ascending")],
                                         null_placement="at_start"))
        query = rows.column("query").to_numpy()
        return rows.filter(pa.array(np.arange(len(query)) - np.searchsorted(query, query) < k))

    def of_batch(batch: pa.RecordBatch, size: int, matrix: np.ndarray, floor: np.ndarray) -> Iterator[pa.Table]:
        lengths = pc.fill_null(pc.list_value_length(batch.column("v")), 0).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(lengths == size)
        step = max(1, tile // size)
        for lo in range(0, len(at), step):
            part = batch.take(pa.array(at[lo:lo + step]))
            values = part.column("v").flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            x = values.reshape(-1, size)
            norm = np.sqrt((x * x).sum(axis=1))
            few = max(1, tile // len(x))
            for q in range(0, len(matrix), few):
                with np.errstate(invalid="ignore", divide="ignore"):
                    # Rounded, so that equal vectors tie wherever in a tile they are.
                    scores = np.round(np.where(norm > 0, (matrix[q:q + few] @ x.T) / norm, np.nan), 12)
                scores[~np.isfinite(scores)] = -np.inf
                query, row = best_of_tile(scores, floor[q:q + few])
                if len(query):
                    yield pa.table({"query": query + q, "item_id": part.column("item_id").take(pa.array(row)),
                                    "score": scores[query, row]})

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {size: [None, np.full(len(ids), -np.inf)] for size, (ids, _) in blocks.value.items() if ids}
        for batch in batches:
            # Rows of a batch in the order of their ids: the first of equal scores is the least id.
            batch = batch.take(pc.sort_indices(batch.column("item_id"), null_placement="at_start"))
            for size, state in held.items():
                parts = list(of_batch(batch, size, blocks.value[size][1], state[1]))
                if not parts:
                    continue
                state[0] = rows = best_rows(pa.concat_tables(parts if state[0] is None else [state[0], *parts]))
                query, n = np.unique(rows.column("query").to_numpy(), return_counts=True)
                full = np.cumsum(n)[n == k] - 1
                state[1][query[n == k]] = rows.column("score").to_numpy()[full]
        for size, (rows, _) in held.items():
            if rows is not None:
                ids = pa.array(blocks.value[size][0], query_type)
                yield from pa.table({"query_id": ids.take(rows.column("query")), "item_id": rows.column("item_id"),
                                     "score": rows.column("score")}).combine_chunks().to_batches(max_chunksize=out_rows)

    whole = all(isinstance(q.query_id, int) for q in queries)
    qkind, query_type = ("bigint", pa.int64()) if whole else ("string", pa.string())
    return corpus.select(F.col(id_col).alias("item_id"), F.col(vec).alias("v")).mapInArrow(
        best, f"query_id {qkind}, item_id {dict(corpus.dtypes)[id_col]}, score double")


def cosine_topk(corpus: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
                vec: str = "embedding") -> DataFrame:
    """Top-k corpus items per query by cosine similarity (ties by item id)."""
    out, block, values = None, [], 0
    for q in queries.select("query_id", "query_vec").filter(F.size("query_vec") > 0).toLocalIterator():
        block.append(q)
        values += max(len(q.query_vec), k)
        if values >= BLOCK_VALUES:
            part = _score_block(corpus, block, id_col, vec, k)
            out, block, values = part if out is None else out.unionByName(part), [], 0
    if block:
        part = _score_block(corpus, block, id_col, vec, k)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return corpus.sparkSession.createDataFrame([], "query_id bigint, item_id bigint, score double, rank int")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("item_id").asc())
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def rerank(hits: DataFrame, k: int = 5) -> DataFrame:
    """Merge hits of several queries: best score per item, then a global top-k."""
    best = hits.groupBy("item_id").agg(F.max("score").alias("score"),
                                       F.count(F.lit(1)).alias("hits"))
    return best.orderBy(F.col("score").desc(), F.col("item_id").asc()).limit(k)
