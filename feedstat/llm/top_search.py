"""Exact top-k search by inner product with MaxScore, shard by shard.

Vectors are sets of weighted terms, one term per dimension. Rows are dealt into shards and
queries into blocks; a task gets one shard and one block. For each query the shard's largest
possible contribution of each term is known. Terms whose contributions together can't lift
a row to the score of the k-th row found so far are not essential: only the others' postings
are traversed, and the rest is probed, largest bound first, for rows that are still
competitive. The best k of each shard are then merged.

Shards and blocks have a fixed size, so a task's memory has a bound however many rows and
queries there are; every query meets every shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from feedstat.llm.vectors import dense, finite_vectors
from feedstat.session import materialize

#: Rows of a shard and of a block of queries, on average.
SHARD_ROWS, BLOCK_ROWS = 8192, 8192
#: Rows scored in full to get a first threshold; queries handled at a time; terms probed at a time.
SEED_ROWS, TILE, PROBES = 512, 128, 8
#: Of the threshold, what terms may reach together that are not essential. At 1 most rows are probed one by one.
LESSER = 0.5
SCALE = 256


def number_kind(rows: np.ndarray, queries: np.ndarray) -> type:
    """The fastest kind of number in which all scores are exact."""
    # twice over: a partial score and the bound of the rest
    most = 2 * float((np.abs(rows).astype(float).max(0, initial=0) * np.abs(queries).astype(float).max(0, initial=0)).sum())
    if most < 2**24:
        return np.float32
    if most < 2**53:
        return np.float64
    if most < 2**62:
        return np.int64
    raise OverflowError("scores don't fit 64 bits")


def search_tile(
    terms: np.ndarray, row_ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and score of the best k rows of the shard for each query (all, if fewer).

    ``terms`` has a row of weights per term; columns go by rising id, so that of equal scores the smaller place wins.
    """
    count = len(queries)
    lowest = -np.inf if terms.dtype.kind == "f" else np.iinfo(np.int64).min // 2
    seed = terms[:, :SEED_ROWS]
    start = queries @ seed
    start[query_ids[:, None] == row_ids[None, : seed.shape[1]]] = lowest
    if start.shape[1] >= k:
        threshold = np.partition(start, start.shape[1] - k, axis=1)[:, start.shape[1] - k]
    else:
        threshold = np.full(count, lowest, terms.dtype)
    query, row = np.nonzero((start >= threshold[:, None]) & (start > lowest))
    found = [(query, row, start[query, row])]
    if terms.shape[1] > SEED_ROWS:
        high, low = terms.max(1).clip(0), terms.min(1).clip(None, 0)
        bounds = np.maximum(queries * high, queries * low)
        order = np.argsort(bounds, axis=1, kind="stable")
        reach = np.cumsum(np.take_along_axis(bounds, order, 1), axis=1)
        reach = np.hstack([np.zeros((count, 1), reach.dtype), reach])
        # the first `lesser` terms of the order are not essential
        lesser = ((reach[:, 1:] < threshold[:, None]) & (reach[:, 1:] <= LESSER * threshold[:, None])).sum(1)
        essential = queries.copy()
        np.put_along_axis(
            essential, order, np.where(np.arange(order.shape[1]) < lesser[:, None], 0, np.take_along_axis(queries, order, 1)), 1
        )
        partial = essential @ terms[:, SEED_ROWS:]
        rest = np.take_along_axis(reach, lesser[:, None], 1)[:, 0]
        query, row = np.nonzero(partial + rest[:, None] >= threshold[:, None])
        score, row = partial[query, row], row + SEED_ROWS
        left = lesser[query]
        while len(left) and (most := left.max()) > 0:
            for back in range(1, min(PROBES, most) + 1):
                place = left - back
                on = place >= 0
                term = order[query, np.maximum(place, 0)]
                score = score + np.where(on, queries[query, term] * terms[term, row], 0).astype(score.dtype)
            left = np.maximum(left - PROBES, 0)
            on = score + reach[query, left] >= threshold[query]
            query, row, score, left = query[on], row[on], score[on], left[on]
        on = query_ids[query] != row_ids[row]
        found.append((query[on], row[on], score[on]))
    query, row, score = (np.concatenate(parts) for parts in zip(*found))
    order = np.lexsort((row, -score, query))
    query, row, score = query[order], row[order], score[order]
    first = np.searchsorted(query, query)
    best = np.arange(len(query)) - first < k
    return query[best], row[best], score[best]


def search(
    rows: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k rows of highest inner product for each query.

    Both tables have ``id`` (long) and ``vector`` (array of longs). Every row of ``queries`` is
    a query; its own rows, those with its id, are no candidates. Of equal scores the smaller
    id comes first. Entries that one of two vectors lacks add nothing. Repeated rows are
    candidates and queries of their own; rows without an id take no part. No rows or no
    queries give an empty result. Scores that 64 bits can't hold raise an error.
    """
    index = materialize(rows.where("id IS NOT NULL").withColumn("row", F.monotonically_increasing_id()), "search-rows")
    asked = materialize(queries.where("id IS NOT NULL").withColumn("row", F.monotonically_increasing_id()), "search-queries")
    shards, blocks = max(1, -(-index.count() // shard_rows)), max(1, -(-asked.count() // block_rows))

    def cells(table: DataFrame, own: str, number: int, other: str, others: int) -> DataFrame:
        """The rows dealt to ``number`` parts by a hash of their place, so that no id or vector makes a part large."""
        part = F.pmod(F.xxhash64("row"), F.lit(number)).cast("int").alias(own)
        return table.select(part, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other), "row", "id", "vector")

    def cell(own: pa.Table, asked: pa.Table) -> pa.Table:
        parts = []
        if own.num_rows and asked.num_rows:
            own = own.sort_by("id")
            width = max(pc.max(pc.list_value_length(table["vector"])).as_py() for table in (own, asked))
            matrix, wanted = dense(own["vector"], width), dense(asked["vector"], width)
            kind = number_kind(matrix, wanted)
            terms, wanted = np.ascontiguousarray(matrix.T.astype(kind)), wanted.astype(kind)
            row_ids, query_ids = own["id"].to_numpy(), asked["id"].to_numpy()
            for start in range(0, len(wanted), TILE):
                query, row, score = search_tile(
                    terms, row_ids, wanted[start : start + TILE], query_ids[start : start + TILE], k
                )
                parts.append(pa.table({
                    "asked": asked["row"].take(pa.array(query + start)), "query_id": query_ids[query + start],
                    "vec_id": row_ids[row], "score": score.astype(np.int64),
                }))
        if parts:
            return pa.concat_tables(parts)
        return pa.table({name: pa.array([], pa.int64()) for name in ("asked", "query_id", "vec_id", "score")})

    docs = cells(index, "shard", shards, "block", blocks).groupBy("shard", "block")
    wanted = cells(asked, "block", blocks, "shard", shards).select("shard", "block", "row", "id", "vector")
    best = docs.cogroup(wanted.groupBy("shard", "block")).applyInArrow(
        cell, "asked long, query_id long, vec_id long, score long"
    )
    rank = F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def scaled_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id`` and ``vector`` with each entry x as ``floor(scale * x)``; vectors null or not all finite take no part."""
    return finite_vectors(rows, id_col, vec_col).select(
        F.col("id").cast("long").alias("id"), F.transform("vector", lambda x: F.floor(x * scale).cast("long")).alias("vector")
    )


def op12_topk(spark, sf_dir: str) -> DataFrame:
    """The 5 nearest rows of ``embeddings`` for every row whose id is divisible by 50."""
    rows = scaled_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return search(rows, rows.where("id % 50 = 0"), 5)


QUERIES = {"op12_topk": op12_topk}

ORACLES = {
    "op12_topk": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), terms AS (
            SELECT vec_id, unnest(v) AS w, unnest(range(len(v))) AS term FROM whole
        ), scores AS (
            SELECT q.vec_id AS query_id, c.vec_id, sum(q.w * c.w)::BIGINT AS score
            FROM terms q JOIN terms c ON q.term = c.term AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0 GROUP BY ALL
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
                   vec_id, score FROM scores
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
