"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments; of each the mean and the norm of its deviation from the mean are kept. For two vectors
the sum over segments of (length x mean x mean + deviation x deviation) is never below their inner product, that is,
their distance is bounded from below. The bound tightens as segments are halved. A query's candidates are bounded coarse
to fine; those that stay above the k-th best exact score so far are computed exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

K = 10
SCALE = 1024
LEVELS = (1, 4, 16)  # segments
QUERY_BLOCK = 512  # queries and candidates that meet in one task
CANDIDATE_BLOCK = 16384
_SLACK = 1e-9  # relative error allowed to the floating-point bounds


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and integer components floor(scale * x). Rows without id or with null or non-finite parts are left out;
    rows that share a vec_id count as one vector, the least of theirs by its components."""
    fit = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    known = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fit, F.lit(False))
    return vectors.where(known).select("vec_id", whole.alias("parts")).groupBy("vec_id").agg(F.min("parts").alias("parts"))


def statistics(matrix: np.ndarray, segments: int) -> np.ndarray:
    """Rows of (sqrt(length) x mean, norm of the deviation) per segment: their dot products bound inner products."""
    columns = []
    for part in np.array_split(matrix, min(segments, matrix.shape[1]), axis=1):
        mean = part.mean(axis=1)
        columns += [mean * np.sqrt(part.shape[1]), np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))]
    return np.stack(columns, axis=1)


def best_of_block(queries: np.ndarray, query_ids: np.ndarray, matrix: np.ndarray, ids: np.ndarray, k: int):
    """Yields (query id, candidate ids, exact scores) with all of the k best, in no order; ties at the k-th are kept.

    Raises where the lengths of two vectors allow a score beyond 64 bits, which would wrap.
    """
    levels = [s for s in LEVELS if s <= matrix.shape[1]] or [1]
    floats, query_floats = matrix.astype(np.float64), queries.astype(np.float64)
    stats = [(statistics(query_floats, s), statistics(floats, s)) for s in levels]
    norms = np.sqrt((floats**2).sum(axis=1))
    if norms.max(initial=0) * np.sqrt((query_floats**2).sum(axis=1)).max(initial=0) >= 2.0**63:
        raise OverflowError("a score may exceed 64 bits: use a smaller scale")
    for at, query_id in enumerate(query_ids):
        slack = _SLACK * np.sqrt((query_floats[at] ** 2).sum()) * norms + 1e-6
        bounds = stats[0][1] @ stats[0][0][at] + slack
        bounds[ids == query_id] = -np.inf
        alive = np.flatnonzero(bounds > -np.inf)
        if not len(alive):
            continue
        floor = -np.inf
        if len(alive) > k:  # exact scores of the most promising give the first k-th best
            probe = alive[np.argpartition(-bounds[alive], k - 1)[:k]]
            floor = (matrix[probe] @ queries[at]).min()
            alive = alive[bounds[alive] >= floor]
        for query_stats, own in stats[1:]:
            if len(alive) <= k:
                break
            bounds = own[alive] @ query_stats[at] + slack[alive]
            if len(alive) > 4 * k:  # a sharper k-th best from the finer order
                probe = alive[np.argpartition(-bounds, k - 1)[:k]]
                floor = max(floor, (matrix[probe] @ queries[at]).min())
            alive = alive[bounds >= floor]
        scores = matrix[alive] @ queries[at]
        if len(alive) > k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            at_kth = np.flatnonzero(scores == kth)
            above = np.flatnonzero(scores > kth)
            ties = at_kth[np.argsort(ids[alive[at_kth]], kind="stable")[: k - len(above)]]
            best = np.concatenate([above, ties])
            alive, scores = alive[best], scores[best]
        yield query_id, ids[alive], scores


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, scale: int = SCALE) -> DataFrame:
    """Per query its k best candidates by integer inner product: query_id, rank, vec_id, score; ties to smaller ids.

    Blocks of queries meet blocks of candidates, so that a task holds ``QUERY_BLOCK`` by ``CANDIDATE_BLOCK`` vectors at
    most; each sends on k rows per query. A candidate with the query's own id takes no part, nor one of another length.
    Repeated rows count once, see ``scaled``. No rows on either side give no rows.
    """
    asked, stored = scaled(queries, scale), scaled(candidates, scale)
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    blocks = max(1, -(-stored.count() // CANDIDATE_BLOCK))
    row = F.monotonically_increasing_id()
    length = F.size("parts").alias("length")
    # the block is fixed before rows are repeated for the blocks that they meet
    left = asked.select("*", length, F.pmod(row, F.lit(query_blocks)).alias("query_block")).select(
        "*", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block")
    )
    right = stored.select("*", length, F.pmod(row, F.lit(blocks)).alias("block")).select(
        "*", F.explode(F.expr(f"sequence(0L, {query_blocks - 1}L)")).alias("query_block")
    )
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def matrix(table: pa.Table) -> np.ndarray:
        return table.column("parts").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)

    def search(asked: pa.Table, stored: pa.Table) -> pa.Table:
        out = []
        if asked.num_rows and stored.num_rows and len(asked.column("parts")[0]):
            ids = stored.column("vec_id").to_numpy()
            query_ids = asked.column("vec_id").to_numpy()
            for query_id, found, scores in best_of_block(matrix(asked), query_ids, matrix(stored), ids, k):
                out.append(pa.table([np.full(len(found), query_id), found, scores], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    keys = ["length", "query_block", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        search, "query_id long, vec_id long, score long"
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
