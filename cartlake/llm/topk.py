"""Exact top-k by inner product, MaxScore over shards of a dense collection.

Components are scaled to integers.  Every dimension is a term with a posting list of all
vectors of a shard.  For a query, a term's bound is the most it can add on the shard; the
terms with the largest bounds are essential, the rest non-essential, split where the rest
can add at most ``SLACK`` of the current k-th score.  The essential lists are traversed for
all candidates; the others are probed in order of their bounds for the candidates that can
still reach the k-th score, and those that cannot are left.  Shards' winners merge.

Queries and candidates meet as blocks of a grid (query block x shard), of bounded size on
both sides; rows are copied to their row or column of the grid, no join makes pairs.

Defined results: vectors that are NULL or hold a NULL or non-finite component, and rows
without an id, take no part; vectors of different lengths are compared over the dimensions
they share; equal scores go to the smaller id; a query's own id is never its candidate;
rows that repeat an id each stand in the result; a score beyond a long is an error; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 32_768
QUERY_ROWS = 2_048
SLACK = 0.5
WARM = 256


def _top(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if len(rows) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= cut
        rows, scores = rows[keep], scores[keep]
    return rows[np.lexsort((ids[rows], -scores))[:k]]


def shard_top(queries: np.ndarray, query_ids: np.ndarray, lists: np.ndarray, ids: np.ndarray, k: int):
    """For each query its k best rows of a shard: (query position, row, score).  ``lists`` is
    dimensions x rows: the posting lists."""
    high, low = lists.max(axis=1), lists.min(axis=1)
    n = lists.shape[1]
    warm = np.linspace(0, n - 1, min(n, WARM)).astype(np.int64)
    for q, (vector, own) in enumerate(zip(queries, query_ids)):
        bound = np.maximum(vector * high, vector * low)
        order = np.argsort(-bound, kind="stable")
        rest = np.concatenate((np.cumsum(bound[order][::-1])[::-1][1:], [0]))   # after each term
        seen = (vector @ lists[:, warm])[ids[warm] != own]
        least = np.partition(seen, len(seen) - k)[len(seen) - k] if len(seen) >= k else np.iinfo(np.int64).min // 2
        essential = int(np.argmax(rest <= SLACK * max(least, 0))) + 1
        partial = np.zeros(n, np.int64)
        for t in order[:essential]:
            if vector[t]:
                partial += vector[t] * lists[t]
        alive = np.flatnonzero((partial + rest[essential - 1] >= least) & (ids != own))
        partial = partial[alive]
        for j in range(essential, len(order)):
            t = order[j]
            partial = partial + vector[t] * lists[t, alive]
            if j % 8 == 7:
                able = partial + rest[j] >= least
                alive, partial = alive[able], partial[able]
        score = np.zeros(n, np.int64)
        score[alive] = partial
        for row in _top(alive, partial, ids, k):
            yield q, row, score[row]


def _dense(column: pa.Array, dims: int) -> np.ndarray:
    """Rows x dims, zeros past a vector's end."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for every query."""
    def scaled(df: DataFrame) -> DataFrame:
        v = F.col(vector_col).cast("array<double>")
        fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return (df.where(F.col(id_col).isNotNull() & v.isNotNull()).where(fine)
                .select(F.col(id_col).cast("long").alias("vec_id"),
                        F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("vector")))

    found, asked = scaled(candidates), scaled(queries)
    shards = max(1, -(-found.count() // shard_rows))
    blocks = max(1, -(-asked.count() // query_rows))
    shard = F.pmod(F.xxhash64("vec_id", F.lit("shard")), F.lit(shards))
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks))
    grid = found.select(shard.alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
                        F.lit(False).alias("asks"), "vec_id", "vector").unionByName(
        asked.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), block.alias("block"),
                     F.lit(True).alias("asks"), "vec_id", "vector"))

    def search(cell: pa.Table) -> pa.Table:
        asks = cell["asks"].to_numpy(zero_copy_only=False).astype(bool)
        ids = cell["vec_id"].to_numpy()
        dims = max(int(max(cell["vector"].combine_chunks().value_lengths().to_pylist(), default=0)), 1)
        rows = _dense(cell["vector"], dims)
        out = []
        if asks.any() and not asks.all():
            most = float(np.abs(rows[asks]).max()) * float(np.abs(rows[~asks]).max()) * dims
            if most >= 2.0 ** 62:
                raise OverflowError("inner products beyond a long")
            order = np.argsort(ids[asks], kind="stable")
            asking, ask_ids = rows[asks][order], ids[asks][order]
            own = ids[~asks]
            out = [(ask_ids[q], own[row], score) for q, row, score in
                   shard_top(asking, ask_ids, np.ascontiguousarray(rows[~asks].T), own, k)]
        return pa.table({"query_id": pa.array([x[0] for x in out], pa.int64()),
                         "vec_id": pa.array([x[1] for x in out], pa.int64()),
                         "score": pa.array([x[2] for x in out], pa.int64())})

    best = grid.groupBy("shard", "block").applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
