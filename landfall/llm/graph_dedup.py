"""Embedding near-dedup over a robust-pruned flat graph."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import Work, components, share
from landfall.llm.vectors import matrix, unit


def centroids(sample: np.ndarray, count: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Unit centroids of unit vectors by spherical k-means."""
    count = min(count, len(sample))
    centers = sample[np.random.default_rng(seed).choice(len(sample), count, replace=False)]
    for _ in range(rounds):
        of = np.concatenate([(sample[i : i + 4096] @ centers.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        sums = np.zeros_like(centers)
        np.add.at(sums, of, sample)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centers = np.where(length > 0, sums / np.where(length > 0, length, 1), centers)
    return centers


def robust_pruned(vectors: np.ndarray, degree: int, pool: int, alpha: float) -> list[np.ndarray]:
    """Neighbours per vector: nearest first, skipping what a kept neighbour is ``alpha`` times closer to.

    Candidates are a vector's ``pool`` nearest of the block. Edges are then made mutual, and what the medoid cannot reach is
    tied to its most similar reachable vector.
    """
    n = len(vectors)
    kept: list[set[int]] = [set() for _ in range(n)]
    pool = min(pool, n - 1)
    for start in range(0, n, 1024):
        near = vectors[start : start + 1024] @ vectors.T
        near[np.arange(len(near)), np.arange(start, start + len(near))] = -2.0
        best = np.argpartition(-near, pool - 1, axis=1)[:, :pool] if pool else np.empty((len(near), 0), np.int64)
        for row, candidates in enumerate(best):
            likeness = near[row, candidates]
            order = np.argsort(-likeness, kind="stable")
            candidates, away = candidates[order], 1 - likeness[order]
            between = 1 - vectors[candidates] @ vectors[candidates].T
            alive = np.ones(len(candidates), bool)
            for i in range(len(candidates)):
                if alive[i]:
                    kept[start + row].add(int(candidates[i]))
                    if len(kept[start + row]) == degree:
                        break
                    # Distances are squared chords, so the factor is squared too.
                    alive &= alpha * alpha * between[i] > away
    for v, own in enumerate([list(k) for k in kept]):
        for u in own:
            kept[u].add(v)
    edges = [np.fromiter(k, np.int64, len(k)) for k in kept]
    reached = np.zeros(n, bool)
    frontier = np.array([medoid(vectors)]) if n else np.empty(0, np.int64)
    while True:
        while len(frontier):
            reached[frontier] = True
            beyond = np.unique(np.concatenate([edges[v] for v in frontier]))
            frontier = beyond[~reached[beyond]]
        lost = np.flatnonzero(~reached)
        if not len(lost):
            return edges
        inside = np.flatnonzero(reached)
        to = inside[(vectors[inside] @ vectors[lost[0]]).argmax()]
        edges[to], edges[lost[0]] = np.append(edges[to], lost[0]), np.append(edges[lost[0]], to)
        frontier = lost[:1]


def medoid(vectors: np.ndarray) -> int:
    return int((vectors @ vectors.mean(axis=0)).argmax())


def within(
    vectors: np.ndarray, edges: list[np.ndarray], entry: int, query: np.ndarray, least: float, slack: float, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Vectors with cosine >= ``least`` and their cosines: greedy search from ``entry``, then expansion of the range.

    The greedy part keeps the ``beam`` best vectors met and expands the best unexpanded ones until none is left. From then on every
    vector met with cosine >= ``least`` - ``slack`` is expanded, a whole front at a time, until no new one turns up.
    """
    met = np.zeros(len(vectors), bool)
    expanded = np.zeros(len(vectors), bool)
    pool, likeness = np.array([entry]), vectors[[entry]] @ query
    met[entry] = True
    all_met, all_like = [pool], [likeness]
    while True:
        wide = likeness >= least - slack
        if len(pool) > beam:
            wide |= likeness >= np.partition(likeness, -beam)[-beam]
        else:
            wide[:] = True
        todo = pool[wide & ~expanded[pool]]
        if not len(todo):
            break
        inside = likeness[wide & ~expanded[pool]]
        if len(todo) > 8 and inside.min() < least - slack:
            # While still on the way, only the best few are expanded at a time.
            todo = todo[(inside >= least - slack) | (inside >= np.partition(inside, -8)[-8])]
        expanded[todo] = True
        beyond = np.concatenate([edges[v] for v in todo])
        beyond = np.unique(beyond[~met[beyond]])
        met[beyond] = True
        fresh = vectors[beyond] @ query
        pool, likeness = np.append(pool, beyond), np.append(likeness, fresh)
        all_met.append(beyond)
        all_like.append(fresh)
    found, cosine = np.concatenate(all_met), np.concatenate(all_like)
    hit = cosine >= least
    return found[hit], cosine[hit]


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number linked with each number."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


def classes(vectors: DataFrame) -> DataFrame:
    """``(vec_id, mark)``: vectors that are equal share a 128-bit mark."""
    mark = F.struct(F.xxhash64("embedding").alias("x"), F.xxhash64(F.lit(1), F.reverse("embedding")).alias("y"))
    return vectors.select("vec_id", mark.alias("mark"), "embedding")


def sharded(reps: DataFrame, centers: np.ndarray, overlap: int) -> DataFrame:
    """``(id, copies, embedding, shards)``: unit vectors and their ``overlap`` nearest shards, nearest first."""
    shared = share(reps.sparkSession, centers)

    def run(batches):
        for rows in batches:
            if len(rows):
                centers = shared.value
                points = unit(matrix(rows["embedding"]))
                near = np.argsort(-(points @ centers.T), axis=1, kind="stable")[:, :overlap]
                yield rows.assign(embedding=list(points), shards=list(near.astype(np.int32)))

    return reps.mapInPandas(run, "id long, copies long, embedding array<double>, shards array<int>")


def linked(work: Work, points: DataFrame, least: float, block_rows: int, degree: int, pool: int, alpha: float, slack: float, beam: int) -> DataFrame:
    """``(id, links, root)``: per vector and task the links found there, and the smallest id they reach there."""
    placed = points.withColumn("shard", F.explode("shards"))
    blocks = placed.groupBy("shard").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    blocks = F.broadcast(blocks)  # one row per centroid, whose number is bounded
    spread = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = placed.join(blocks, "shard").withColumn("block", spread)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        ids = rows["id"].to_numpy()
        edges = robust_pruned(matrix(rows["embedding"]), degree, pool, alpha)
        return pd.DataFrame({"id": ids, "near": [ids[e] for e in edges]})

    lists = placed.select("shard", "block", "id", "embedding").groupBy("shard", "block").applyInPandas(build, "id long, near array<long>")
    union = lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    graph = placed.join(union, "id").select("shard", "block", every.alias("part"), "id", "copies", "embedding", "shards", "near")
    fresh = lambda name: F.col(name).alias(name)  # noqa: E731  columns of their own, as both sides come from one table
    asked = placed.select(fresh("shard"), F.col("block").alias("part"), every.alias("block"), *map(fresh, ("id", "embedding", "shards")))

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"id": np.empty(0, np.int64), "links": np.empty(0, np.int64), "root": np.empty(0, np.int64)})
        if not len(rows) or not len(asked):
            return empty
        rows, asked = rows.sort_values("id"), asked.sort_values("id")
        ids, vectors, shard = rows["id"].to_numpy(), matrix(rows["embedding"]), int(rows["shard"].iat[0])
        # Of the united lists, what stands in this block.
        edges = []
        for near in rows["near"]:
            at = np.minimum(np.searchsorted(ids, near), len(ids) - 1)
            edges.append(at[ids[at] == near])
        entry = medoid(vectors)
        asking, points = asked["id"].to_numpy(), matrix(asked["embedding"])
        found = [within(vectors, edges, entry, point, least, slack, beam)[0] for point in points]
        q = np.repeat(np.arange(len(asking)), [len(f) for f in found])
        x = np.concatenate([*found, np.empty(0, np.int64)])
        if np.array_equal(asking, ids):  # both ends ask here: what either finds, both have
            q, x = np.unique(np.concatenate([np.stack([q, x]), np.stack([x, q])], axis=1), axis=1)
        other = asking[q] != ids[x]
        q, x = q[other], x[other]
        # A pair that shares several shards is counted in the first of them.
        mine, theirs = np.array(asked["shards"].tolist())[q], np.array(rows["shards"].tolist())[x]
        common = (mine[:, :, None] == theirs[:, None, :]).any(axis=2)
        first = np.where(common, mine, np.iinfo(np.int32).max).min(axis=1, initial=np.iinfo(np.int32).max)
        counted = first == shard
        links = np.bincount(q[counted], rows["copies"].to_numpy()[x[counted]], minlength=len(asking)).astype(np.int64)
        names, at = np.unique(np.concatenate([asking, ids]), return_inverse=True)
        least_name = names[roots(len(names), at[: len(asking)][q], at[len(asking) :][x])]
        result = pd.DataFrame({"id": names, "links": 0, "root": least_name})
        result.loc[at[: len(asking)], "links"] = links
        return result

    keys = ("shard", "block", "part")
    return graph.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(run, "id long, links long, root long")


def audited(points: DataFrame, found: DataFrame, least: float, sample: int) -> float:
    """Mean recall of links per vector, of those among ``sample`` vectors (smallest hashes of ids) that have any when compared with all.

    Every such vector counts alike, so a large group does not hide the loss of isolated pairs.
    """
    asked = points.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "embedding").toPandas()
    if not len(asked):
        return 1.0
    shared = share(points.sparkSession, (asked["id"].to_numpy(), matrix(asked["embedding"])))

    def run(batches):
        ids, queries = shared.value
        for rows in batches:
            if len(rows):
                hit = queries @ matrix(rows["embedding"]).T >= least
                hit &= ids[:, None] != rows["id"].to_numpy()[None, :]
                yield pd.DataFrame({"id": ids, "true": hit @ rows["copies"].to_numpy()})

    true = points.select("id", "copies", "embedding").mapInPandas(run, "id long, true long").groupBy("id").agg(F.sum("true").alias("true"))
    part = F.least("true", F.coalesce("links", F.lit(0))) / F.col("true")
    recall = true.filter(F.col("true") > 0).join(found, "id", "left").agg(F.avg(part)).first()[0]
    return 1.0 if recall is None else recall


def near_duplicates(
    work: Work,
    vectors: DataFrame,
    least: float = 0.9,
    shard_rows: int = 1000,
    block_rows: int = 4000,
    max_shards: int = 2048,
    sample_rows: int = 40_000,
    overlap: int = 3,
    degree: int = 24,
    pool: int = 48,
    alpha: float = 1.2,
    slack: float = 0.1,
    beam: int = 32,
    audit_rows: int = 200,
    target: float = 0.97,
) -> DataFrame:
    """``(vec_id, n_links, component_id, recall)`` of usable vectors ``(vec_id, embedding)`` (see ``vectors.usable``).

    Equal vectors form a class; its smallest id stands for it and carries the number of copies. Representatives go to
    their ``overlap`` nearest of up to ``max_shards`` k-means shards (fitted on at most ``sample_rows`` vectors). Shards that
    outgrow ``block_rows`` are cut into blocks by a hash of the id, and each block is searched for all vectors of its shard, so a
    hot shard costs more tasks, never a larger one, and loses no pair. Blocks get robust-pruned graphs; adjacency lists of a vector are
    united over its shards; from the block's medoid a range-expanding greedy search finds all vectors with cosine >= ``least``.
    Cosines are computed in double precision on the vectors, so no pair below the limit is linked.

    ``n_links`` counts linked vectors, copies included. A pair in several shards is counted in its first common one. Tasks send
    counts and, per vector, the smallest id it reaches there, never pairs. Recall is audited against all vectors
    for ``audit_rows`` of them, each alike; below ``target`` the graph is rebuilt with twice the overlap, until it is met. If it is
    not met with all shards either, an error is raised. ``recall`` is the last audit's value.

    Vectors of another dimension than the most frequent one are not comparable and raise an error. No vectors give no rows.
    """
    marked = work.keep(classes(vectors), "classes")
    reps = marked.groupBy("mark").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    reps = work.keep(reps.select("id", "copies", "embedding"), "reps")
    n = reps.count()
    sample = reps.select("id", "embedding").orderBy(F.xxhash64("id"), "id").limit(sample_rows).toPandas()
    shards = max(1, min(max_shards, -(-n // shard_rows)))
    centers = centroids(unit(matrix(sample["embedding"])), shards) if n else np.empty((0, 0))
    while True:
        points = work.keep(sharded(reps, centers, min(shards, overlap)), "points")
        found = work.keep(linked(work, points, least, block_rows, degree, pool, alpha, slack, beam), "links")
        links = found.groupBy("id").agg(F.sum("links").alias("links"))
        recall = audited(points, links, least, audit_rows)
        if recall >= target:
            break
        if overlap >= shards:
            raise RuntimeError(f"recall of links is {recall:.3f} with all {shards} shards; {target} is asked for")
        work.drop(points, found)
        overlap *= 2
    edges = found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    parts = components(work, edges)
    named = reps.select("id", "copies").join(links, "id", "left").join(parts, "id", "left")
    named = named.select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    members = marked.select("vec_id", "mark").join(marked.groupBy("mark").agg(F.min("vec_id").alias("id")), "mark")
    return members.join(named, "id").select("vec_id", "n_links", "component_id", F.lit(float(recall)).alias("recall"))
