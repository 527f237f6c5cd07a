"""Nearest neighbours by a block matrix join over int8 tiles.

Vectors are quantised to int8 with a scale of their own. Queries and candidates are
dealt into blocks of bounded size, and every pair of blocks is a tile, whose int8
product gives all its inner products at once, each within a known bound:

    x = s * x8 + e,  |e| <= s / 2 in each component, so
    |x.y - s t (x8.y8)| <= s/2 * |y^|_1 + t/2 * |x^|_1 + d * s * t / 4

with x^ = s * x8. A candidate whose upper bound lies below the k-th lower bound
of its query in the tile can't be among the k nearest. The others are computed
again in double precision, a heap keeps the k best of a tile, and heaps are merged by query.

A bound that overflows says nothing, so its candidate is computed again. The result is
exact for any finite components. The products are taken as float32 matrices, which hold
integers up to 2 ** 24 exactly, so up to 1024 components.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.llm.common import Scratch, table

NEIGHBOURS = 20
QUERY_EVERY = 20
QUERY_BLOCK = 2_048
CANDIDATE_BLOCK = 16_384
_EXACT_COMPONENTS = 1_024


def _quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    scale = np.abs(vectors).max(axis=1) / 127
    scale[scale == 0] = 1  # of subnormal numbers
    return np.rint(vectors / scale[:, None]).astype(np.int8), scale


def usable_vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, size, vector): the vectors that take part, as bytes of doubles.

    Left out are NULL and empty vectors, zero vectors, those with a NULL or
    non-finite component, and rows without an id.
    """
    picked = rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, out = [], [], []
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v"), strict=True):
                if i is None or not v.is_valid or not len(v.values) or v.values.null_count:
                    continue
                vector = v.values.to_numpy()
                if np.isfinite(vector).all() and vector.any():
                    ids.append(i)
                    sizes.append(len(vector))
                    out.append(vector.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(out, pa.binary())], ["id", "size", "vector"]
            )

    return picked.mapInArrow(of_batches, "id long, size int, vector binary")


def _matrix(column: pd.Series, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(-1, size)


def _inner_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """In double precision and one order of adding, so that a pair's score is the same in any tile."""
    total = np.zeros(len(vectors))
    for component, q in zip(vectors.T, query, strict=True):
        total += component * q
    # A sum that overflows to both sides counts as the least.
    return np.where(np.isnan(total), -np.inf, total)


def tile_nearest(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, id, score): the k nearest of a tile for each query, ties to the smaller id, its own id left out."""
    with np.errstate(over="ignore", invalid="ignore"):
        return _tile_nearest(query_ids, queries, ids, vectors, k)


def _tile_nearest(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = queries.shape[1]
    q8, q_scale = _quantised(queries)
    x8, x_scale = _quantised(vectors)
    kind = np.float32 if size <= _EXACT_COMPONENTS else np.float64
    q, x = q8.astype(kind), x8.astype(kind)
    q_norm, x_norm = q_scale * np.abs(q).sum(axis=1), x_scale * np.abs(x).sum(axis=1)
    out: tuple[list, list, list] = ([], [], [])
    step = max(1, 4_000_000 // len(ids))
    for at in range(0, len(query_ids), step):
        part = slice(at, at + step)
        near = (q[part] @ x.T).astype(np.float64) * q_scale[part, None] * x_scale
        off = (
            q_scale[part, None] / 2 * x_norm + x_scale / 2 * q_norm[part, None] + size / 4 * q_scale[part, None] * x_scale
        ) * (1 + 1e-9) + 1e-300
        own = query_ids[part, None] == ids
        upper, lower = near + off, near - off
        lower = np.where(own | ~np.isfinite(lower), -np.inf, lower)
        kept = min(k, len(ids))
        floor = np.partition(lower, len(ids) - kept, axis=1)[:, len(ids) - kept]
        survivors = ((upper >= floor[:, None]) | ~np.isfinite(upper)) & ~own
        for row in range(len(floor)):
            found = np.nonzero(survivors[row])[0]
            scores = _inner_products(vectors[found], queries[at + row])
            heap: list[tuple[float, int]] = []
            for score, i in zip(scores.tolist(), (-ids[found]).tolist(), strict=True):
                if len(heap) < k:
                    heapq.heappush(heap, (score, i))
                elif (score, i) > heap[0]:
                    heapq.heapreplace(heap, (score, i))
            out[0].extend([int(query_ids[at + row])] * len(heap))
            out[1].extend(-i for _, i in heap)
            out[2].extend(score for score, _ in heap)
    return np.array(out[0], np.int64), np.array(out[1], np.int64), np.array(out[2], np.float64)


def _merger(k: int):
    """Merge the tiles' results of each query; a partition holds whole queries, sorted."""

    def of_frames(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        query, heap = None, []

        def ranked() -> pd.DataFrame:
            best = heapq.nsmallest(k, heap)
            return pd.DataFrame(
                {"query_id": query, "rank": np.arange(1, len(best) + 1, dtype=np.int32), "vec_id": [i for _, i in best],
                 "score": [-s for s, _ in best]}
            )

        for frame in frames:
            done = []
            for q, rows in frame.groupby("query_id", sort=False):
                if q != query:
                    if heap:
                        done.append(ranked())
                    query, heap = q, []
                heap = heapq.nsmallest(k, [*heap, *zip((-rows["score"]).tolist(), rows["id"].tolist(), strict=True)])
            if done:
                yield pd.concat(done)
        if heap:
            yield ranked()

    return of_frames


def nearest(
    queries: DataFrame, candidates: DataFrame, scratch: Scratch, k: int = NEIGHBOURS, id_column: str = "vec_id",
    vector_column: str = "embedding", query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k candidates of the largest inner product.

    Nearest first, ties to the smaller id; all candidates if there are fewer than
    k. A candidate with the query's id is the query's own and left out. Vectors of
    different length are not compared. An inner product beyond the range of doubles is an infinity,
    and the least of all if its parts overflow to both sides. Repeated rows of a candidate take a rank
    each; a query id that repeats counts once (with its first vector by bytes).
    """
    asked = scratch.stage(
        usable_vectors(queries, id_column, vector_column).groupBy("id").agg(
            F.min(F.struct("vector", "size")).alias("m")
        ).select("id", "m.size", "m.vector"), "queries",
    )
    held = scratch.stage(usable_vectors(candidates, id_column, vector_column), "candidates")
    n_query = max(1, -(-asked.count() // query_block))
    n_held = max(1, -(-held.count() // candidate_block))

    def dealt(df: DataFrame, blocks: int, salt: str) -> DataFrame:
        return df.withColumn("_own", F.pmod(F.xxhash64("id", "vector", F.lit(salt)), F.lit(blocks)).cast("int"))

    # Every block of queries meets every block of candidates, so each row goes to the other side's number of tiles.
    left = dealt(asked, n_query, "q").withColumnRenamed("_own", "_q").withColumn("_x", F.explode(F.sequence(F.lit(0), F.lit(n_held - 1))))
    right = dealt(held, n_held, "x").withColumnRenamed("_own", "_x").withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))))
    tile = ["size", "_q", "_x"]

    def of_tile(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if q.empty or x.empty:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        size = int(q["size"].iloc[0])
        found = tile_nearest(
            q["id"].to_numpy(), _matrix(q["vector"], size), x["id"].to_numpy(), _matrix(x["vector"], size), k
        )
        return pd.DataFrame(dict(zip(("query_id", "id", "score"), found, strict=True)))

    tiles = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(of_tile, "query_id long, id long, score double")
    by_query = tiles.repartition("query_id").sortWithinPartitions("query_id")
    return by_query.mapInPandas(_merger(k), "query_id long, rank int, vec_id long, score double")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows.filter(F.col("vec_id") % QUERY_EVERY == 0), rows, Scratch(spark))


def op3_sql(k: int = NEIGHBOURS) -> str:
    usable = (
        "vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 "
        "AND len(list_filter(embedding, lambda x: x <> 0)) > 0"
    )
    product = (
        "list_reduce(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2]), lambda a, b: a + b, 0.0::DOUBLE)"
    )
    return (
        f"WITH usable AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE {usable}), "
        f"pairs AS (SELECT q.vec_id AS query_id, x.vec_id, {product} AS score FROM usable q JOIN usable x "
        f"ON q.vec_id % {QUERY_EVERY} = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v)), "
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs) "
        f"SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}"
    )
