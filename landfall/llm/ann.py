"""Approximate nearest neighbours by collision counting over sorted projections."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import importable
from landfall.llm.vectors import matrix


class Projections:
    """Sorted arrays of single projections of a block of vectors."""

    def __init__(self, vectors: np.ndarray, count: int, seed: int):
        self.lines = np.random.default_rng(seed).standard_normal((vectors.shape[1], count))
        values = vectors @ self.lines
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.sorted = np.sort(values, axis=0).T.copy()


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances. Where squares leave the range of doubles, they are taken of differences scaled by the largest."""
    off = rows - query
    found = np.sqrt((off * off).sum(axis=1))
    if 1e-150 <= found.min() and found.max() < np.inf:
        return found
    odd = np.flatnonzero(~np.isfinite(found) | (found < 1e-150))
    half = rows[odd] / 2 - query / 2
    most = np.abs(half).max(axis=1, initial=0)
    part = half / np.where(most > 0, most, 1)[:, None]
    scaled = most * np.sqrt((part * part).sum(axis=1)) * 2
    found[odd] = np.where(most > 0, np.where(np.isnan(scaled), np.inf, scaled), found[odd])
    return found


def nearest(
    index: Projections, vectors: np.ndarray, query: np.ndarray, allowed: np.ndarray, k: int, start: float, growth: float, share: float
) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of verified vectors around ``query``.

    A vector at distance r projects within r of the query on a line with odds 0.68. At radius R each sorted array's
    window reaches R to both sides of the query's own projection; widening R only counts what the windows newly
    cover (virtual rehashing). Vectors that collide on ``share`` of the lines are verified. The search ends when k
    verified vectors lie within R, or when the windows hold everything (or R passes all doubles) and all is verified: no cap on
    candidates. A verified vector farther away than a double can tell has an infinite distance.
    """
    lines, n = index.order.shape
    at = query @ index.lines
    place = [int(np.searchsorted(row, v)) for row, v in zip(index.sorted, at)]
    left, right = np.array(place), np.array(place)
    hits, distance = np.zeros(n, np.int64), np.full(n, np.inf)
    seen = ~allowed
    radius, need = start, share * lines
    while True:
        low = [int(np.searchsorted(row, v - radius)) for row, v in zip(index.sorted, at)]
        high = [int(np.searchsorted(row, v + radius, side="right")) for row, v in zip(index.sorted, at)]
        new = [index.order[j, low[j] : left[j]] for j in range(lines)] + [index.order[j, right[j] : high[j]] for j in range(lines)]
        hits += np.bincount(np.concatenate(new), minlength=n)
        left, right = np.minimum(left, low), np.maximum(right, high)
        all_in = bool((left == 0).all() and (right == n).all()) or not np.isfinite(radius)
        fresh = np.flatnonzero(~seen & ((hits >= need) | all_in))
        if len(fresh):
            distance[fresh] = distances(vectors[fresh], query)
            seen[fresh] = True
        if all_in or (distance <= radius).sum() >= k:
            found = np.flatnonzero(seen & allowed)
            return found, distance[found]
        radius *= growth


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    lines: int = 96,
    share: float = 0.58,
    growth: float = 1.15,
    block_rows: int = 8192,
    query_rows: int = 8192,
    seed: int = 5,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` nearest vectors by Euclidean distance, ties to the smaller id.

    Both inputs are ``(vec_id, embedding)`` of usable vectors, one row per id (see ``vectors.usable``); a query is not its own
    candidate, and only vectors of its dimension are. Every vector is indexed, in blocks of about ``block_rows`` by a hash of the
    id; a task searches one block for up to about ``query_rows`` queries, so its memory is bounded and no key is hot. Blocks' best
    ``k`` are merged, at most k rows a block and query. A block's search stops by itself, so each block verifies at
    least k vectors. Fewer candidates than k give fewer rows; empty inputs give none.
    """
    importable(vectors.sparkSession)
    sizes = vectors.agg(F.count("*")).first()[0], queries.agg(F.count("*")).first()[0]
    blocks, groups = (max(1, -(-n // rows)) for n, rows in zip(sizes, (block_rows, query_rows)))
    spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dim = F.size("embedding").alias("dim")
    indexed = vectors.select("vec_id", "embedding", dim, spread(blocks).alias("block"), every(groups).alias("part"))
    asked = queries.select("vec_id", "embedding", dim, spread(groups).alias("part"), every(blocks).alias("block"))

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        np.seterr(over="ignore", invalid="ignore")  # such distances are found in another way
        found = []
        if len(rows) and len(asked):
            ids, points = rows["vec_id"].to_numpy(), matrix(rows["embedding"])
            index = Projections(points, lines, seed)
            # A radius that holds a small part of the block on a line: a start from which few widenings are wasted.
            start = float(np.median(index.sorted[:, -1] - index.sorted[:, 0])) / 16
            start = start if 0 < start < np.inf else 1.0
            for query, point in zip(asked["vec_id"].to_numpy(), matrix(asked["embedding"])):
                at, distance = nearest(index, points, point, ids != query, k, start, growth, share)
                best = np.lexsort((ids[at], distance))[:k]
                found.append(pd.DataFrame({"query_id": query, "vec_id": ids[at[best]], "score": distance[best]}))
        empty = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        return pd.concat([empty, *found])

    pairs = indexed.groupBy("block", "part", "dim").cogroup(asked.groupBy("block", "part", "dim"))
    near = pairs.applyInPandas(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
