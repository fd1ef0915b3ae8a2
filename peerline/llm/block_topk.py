"""Exact top-k by inner product, block at a time.

Candidates are cut into blocks along an order that puts like vectors together; each block keeps the largest and the
smallest value of every component. For a query these give an upper bound of any score in the block. Blocks
are read in falling order of bound, through the block's own rows, until the bound falls
below the k-th score found: nothing left can enter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerline.session import materialise

BLOCK = 64  # candidates in a block
SHARD = 8192  # candidates that one task holds
QUERIES = 1024  # queries that meet a shard at once
EXACT = float(2**53)


def quantise(vector: Column, levels: int = 256) -> Column:
    """floor(levels * x) of each component, x as double; null for a vector that is null or holds null or a non-finite one."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(finite, F.transform(numbers, lambda x: F.floor(x * levels).cast("long")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of int64, short vectors filled up with 0."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def like_order(matrix: np.ndarray) -> np.ndarray:
    """Rows in an order that keeps like ones together: halved again and again at the median of the widest direction."""
    order, parts = np.arange(len(matrix)), [np.arange(len(matrix))]
    rng = np.random.default_rng(5)
    while parts and max(map(len, parts)) > BLOCK:
        halves = []
        for rows in parts:
            if len(rows) <= BLOCK:
                halves.append(rows)
                continue
            x = matrix[rows].astype(np.float64)
            x -= x.mean(0)
            axis = rng.standard_normal(x.shape[1])
            for _ in range(3):
                axis = x.T @ (x @ axis)
                norm = np.linalg.norm(axis)
                if not norm or not np.isfinite(norm):
                    axis = np.ones(x.shape[1])
                    break
                axis /= norm
            ranked = rows[np.argsort(x @ axis, kind="stable")]
            cut = BLOCK * max(1, round(len(rows) / BLOCK / 2))
            halves += [ranked[:cut], ranked[cut:]]
        parts = halves
        order = np.concatenate(parts)
    return order


class Blocks:
    """The blocks of one shard: rows, ids, and the bounds of every component."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        order = like_order(matrix)
        self.ids, self.matrix = ids[order], matrix[order]
        starts = np.arange(0, len(ids), BLOCK)
        self.starts, self.stops = starts, np.append(starts[1:], len(ids))
        self.high = np.maximum.reduceat(self.matrix, starts).astype(np.float64)
        self.low = np.minimum.reduceat(self.matrix, starts).astype(np.float64)
        reach = np.abs(self.matrix).max(initial=0)
        self.reach = float(reach)
        self.real = self.matrix.astype(np.float64)

    def top(self, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query place, ids, scores) of the k best rows for each query, its own id left out."""
        real = queries.astype(np.float64)
        exact = self.reach * np.abs(real).max(initial=0) * real.shape[1] < EXACT
        rows = self.real if exact else self.matrix.astype(object)
        bounds = np.maximum(real, 0) @ self.high.T + np.minimum(real, 0) @ self.low.T
        bounds += 0 if exact else np.abs(bounds) * 1e-12 + 1
        for place, bound in enumerate(bounds):
            query = real[place] if exact else queries[place].astype(object)
            ids, scores = np.zeros(0, np.int64), np.zeros(0, np.float64 if exact else object)
            least = None
            for block in np.argsort(-bound, kind="stable"):
                if least is not None and bound[block] < least:
                    break
                span = slice(self.starts[block], self.stops[block])
                found = rows[span] @ query
                keep = self.ids[span] != own[place]
                if least is not None:
                    keep &= np.asarray(found >= least, bool)
                ids, scores = np.concatenate([ids, self.ids[span][keep]]), np.concatenate([scores, found[keep]])
                if len(ids) > k:
                    best = np.lexsort([ids, (-scores).astype(np.float64)])[:k] if exact else sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
                    ids, scores = ids[best], scores[best]
                if len(ids) == k:
                    least = scores.min()
            yield place, ids, scores


def _shard_top(k: int):
    def run(key: tuple, candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        width = max([len(v) for side in (candidates, queries) for v in side["vector"]], default=0)
        if not len(candidates) or not len(queries) or not width:
            found = [
                (q, c, 0) for q, own in zip(queries.get("row", []), queries.get("id", [])) for c in sorted(x for x in candidates["id"] if x != own)[:k]
            ]
            return pd.DataFrame(found, columns=["row", "vec_id", "score"])
        blocks = Blocks(candidates["id"].to_numpy(np.int64), _matrix(candidates["vector"], width))
        asked = _matrix(queries["vector"], width)
        rows, ids, scores = [], [], []
        for place, found, values in blocks.top(asked, queries["id"].to_numpy(np.int64), k):
            rows += [queries["row"].iloc[place]] * len(found)
            ids += found.tolist()
            scores += [int(v) for v in values]
        return pd.DataFrame({"row": rows, "vec_id": ids, "score": scores})

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard: int = SHARD, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest integer inner products of each query with all other rows.

    `vectors` is (vec_id, vector of whole numbers). Ties go to the smaller id; with fewer candidates all are returned.
    Candidates are cut by range of id into shards of a bounded number of rows and queries into groups of a bounded
    number; every shard meets every group once, and keeps k rows for each query, so
    nothing is sent to all executors and no task grows with the input. Rows without a vec_id or a vector take no
    part. Rows with the query's id count as the query's own. A repeated candidate counts as often as it is
    there, a repeated query is answered once for each row. Missing components of shorter vectors are 0.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), "vector", is_query.alias("asks")).filter(
        F.col("id").isNotNull() & F.col("vector").isNotNull()
    )
    counted = rows.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
    shards, groups = max(1, -(-counted[0] // shard)), max(1, -(-counted[1] // queries))
    held = materialise(
        rows.repartitionByRange(shards, "id", F.xxhash64("vector")).withColumn("shard", F.pmod(F.spark_partition_id(), F.lit(shards))).withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    candidates = held.select("id", "vector", "shard", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    asking = held.filter("asks").select(
        "id", "vector", "row", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )
    best = (
        candidates.groupBy("shard", "part")
        .cogroup(asking.groupBy("shard", "part"))
        .applyInPandas(_shard_top(k), "row long, vec_id long, score long")
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = held.filter("asks").select(F.col("row"), F.col("id").alias("query_id"))
    return ranked.join(names, "row").select("query_id", "rank", "vec_id", "score")
