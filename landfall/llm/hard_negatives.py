"""Hard-negative mining over an inverted multi-index, searched until the windows are certified."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import Work, share

#: Rows the codebooks are fitted on, and codewords a half-space has at the most.
SAMPLE, CODEWORDS = 20_000, 256
#: Numbers a shard's vectors hold, about; anchors that go through a shard together.
SHARD_NUMBERS, ANCHORS = 2**19, 1024
#: Components up to this size are searched by bounds; vectors with larger ones are always looked at.
PLAIN = 2.0**40
LONG = 2**63 - 1


def takes_part(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, label, embedding)``, one row per id, all vectors as long as the longest (filled up with zeros).

    Rows without an id, a label or a vector, or with a null or non-finite component, take no part. Of several rows of
    an id the one with the smallest vector, then the smallest label counts.
    """
    inf = float("inf")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite)
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("embedding", "label")).alias("row")).select("vec_id", "row.label", "row.embedding")
    return rows


def read(table: pa.Table | pa.RecordBatch, dims: int) -> np.ndarray:
    """The vectors of a batch as a matrix."""
    column = table["embedding"]
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) if dims else np.empty((len(column), 0))


def scaled(x: np.ndarray) -> np.ndarray:
    """``floor(256 * x)`` as doubles; very large ones may become infinite."""
    with np.errstate(over="ignore"):
        return np.floor(256 * x)


def exact(x: np.ndarray) -> np.ndarray:
    """The same as Python integers."""
    whole = [[int(v) * 256 if abs(v) >= 2.0**60 else math.floor(256 * v) for v in row] for row in x.tolist()]
    return np.array(whole, object).reshape(x.shape)


class Codebook:
    """Codewords of one half-space with the largest distance of a vector to its codeword, and groups of nearby codewords."""

    def __init__(self, sample: np.ndarray, n: int, groups: int):
        random = np.random.default_rng(5)
        words = sample[random.choice(len(sample), min(n, len(sample)), replace=False)]
        for _ in range(8):
            near = self.nearest(words, sample)[0]
            total = np.zeros_like(words)
            np.add.at(total, near, sample)
            count = np.bincount(near, minlength=len(words))[:, None]
            words = np.where(count > 0, total / np.maximum(count, 1), words)
        spread = words - words.mean(axis=0)
        axis = np.linalg.svd(spread, full_matrices=False)[2][0] if words.shape[1] else np.zeros(0)
        self.words = words[np.argsort(spread @ axis, kind="stable")]
        self.group = np.arange(len(words)) * min(groups, len(words)) // len(words)
        self.radius = np.zeros(len(words))

    @staticmethod
    def nearest(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest codeword's number and a distance to it that is never too small."""
        codes, far = np.empty(len(rows), np.int64), np.empty(len(rows))
        norms = (words * words).sum(axis=1)
        for start in range(0, len(rows), 4096):
            part = rows[start : start + 4096]
            code = (norms - 2 * part @ words.T).argmin(axis=1)
            codes[start : start + 4096] = code
            far[start : start + 4096] = np.sqrt(((part - words[code]) ** 2).sum(axis=1)) * (1 + 1e-9)
        return codes, far

    def bounds(self, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Upper and lower bounds of an anchor's half score with the vectors of each codeword."""
        size = math.sqrt(float((half * half).sum()))
        middle = self.words @ half
        reach = np.where(np.isinf(self.radius), np.inf, size * np.where(np.isinf(self.radius), 0, self.radius))
        reach = reach + 1e-9 * (np.abs(middle) + size * np.sqrt((self.words**2).sum(axis=1))) + 1e-6
        return middle + reach, middle - reach


def by_bound(u: np.ndarray, v: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Cells ``(i, j)`` by descending ``u[i] + v[j]``, found one by one from the sorted halves."""
    p, q = np.argsort(-u, kind="stable").tolist(), np.argsort(-v, kind="stable").tolist()
    u, v = u.tolist(), v.tolist()
    heap = [(-(u[p[0]] + v[q[0]]), 0, 0)]
    while heap:
        bound, x, y = heapq.heappop(heap)
        yield -bound, p[x], q[y]
        if y + 1 < len(q):
            heapq.heappush(heap, (-(u[p[x]] + v[q[y + 1]]), x, y + 1))
        if y == 0 and x + 1 < len(p):
            heapq.heappush(heap, (-(u[p[x + 1]] + v[q[0]]), x + 1, 0))


class Index:
    """The two codebooks, and which shards there are: ``pieces`` per pair of groups."""

    def __init__(self, sample: np.ndarray, dims: int, rows: int):
        self.dims, self.half = dims, dims // 2
        words = min(CODEWORDS, max(1, math.ceil(math.sqrt(rows / 50))))
        groups = math.ceil(math.sqrt(rows * max(dims, 1) / SHARD_NUMBERS))
        self.books = [Codebook(part, words, groups) for part in (sample[:, : self.half], sample[:, self.half :])]

    def halves(self, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vector[..., : self.half], vector[..., self.half :]

    def shards(self) -> tuple[int, int]:
        return tuple(int(book.group.max()) + 1 for book in self.books)

    def shard_bounds(self, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Upper and lower bounds of an anchor's scores in each pair of groups."""
        sides = []
        for book, half in zip(self.books, self.halves(vector)):
            upper, lower = book.bounds(half)
            starts = np.flatnonzero(np.diff(book.group, prepend=-1))
            sides.append((np.maximum.reduceat(upper, starts), np.minimum.reduceat(lower, starts)))
        (a, c), (b, d) = sides
        return (a[:, None] + b).reshape(-1), (c[:, None] + d).reshape(-1)


class Shard:
    """One shard's vectors in order of their cells, and what an anchor needs to search them."""

    def __init__(self, index: Index, rows: pa.Table):
        self.index = index
        raw = read(rows, index.dims)
        codes = [rows[c].to_numpy() for c in ("i", "j")]
        (self.i, self.j), cell = zip(*[np.unique(c, return_inverse=True) for c in codes])
        cell = cell[0].reshape(-1) * len(self.j) + cell[1].reshape(-1)
        order = np.argsort(cell, kind="stable")
        self.ids, self.labels, self.raw, self.cell = rows["vec_id"].to_numpy()[order], rows["label"].to_numpy()[order], raw[order], cell[order]
        self.vectors = scaled(self.raw)
        self.largest = np.abs(self.vectors).max(initial=0)
        self.by_label = np.argsort(self.labels, kind="stable")
        self.sorted_labels = self.labels[self.by_label]

    def of_label(self, label: int) -> np.ndarray:
        """The rows of a label, in order of their cells."""
        start, end = np.searchsorted(self.sorted_labels, [label, label + 1])
        return self.by_label[start:end]

    def scores(self, at: np.ndarray, raw: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Inner products as integers; those beyond 64 bits count as the nearest that fits."""
        if self.largest * np.abs(vector).max(initial=0) * max(self.index.dims, 1) < 2.0**53:
            return (self.vectors[at] @ vector).astype(np.int64)
        products = exact(self.raw[at]) @ exact(raw[None, :])[0]
        return np.array([min(max(int(s), -LONG), LONG) for s in products], np.int64)

    def visit(self, vector: np.ndarray, among: np.ndarray | None, at_once: int = 512) -> Iterator[tuple[float, float, np.ndarray]]:
        """Rows, some cells at a time, with an upper bound of the scores to come; the receiver stops when it is certain.

        Sent values are upper limits: cells whose scores all lie above are passed over.
        """
        cells = self.cell if among is None else self.cell[among]
        plain = np.abs(vector).max(initial=0) <= PLAIN
        first, second = (book.bounds(half) for book, half in zip(self.index.books, self.index.halves(np.clip(vector, -PLAIN, PLAIN))))
        upper, lower = (first[0][self.i], second[0][self.j]), (first[1][self.i], second[1][self.j])
        if not plain:
            upper, lower = [np.full(len(x), np.inf) for x in upper], [np.full(len(x), -np.inf) for x in lower]
        starts = np.searchsorted(cells, np.arange(len(self.i) * len(self.j) + 1)).tolist()
        held, n, limit = [], 0, math.inf
        for bound, x, y in by_bound(*upper):
            cell = x * len(self.j) + y
            start, end = starts[cell], starts[cell + 1]
            if start < end and lower[0][x] + lower[1][y] <= limit:
                held.append(np.arange(start, end))
                n += end - start
            if n >= at_once or (held and n and bound == -math.inf):
                limit = (yield bound, self.take(held, among)) or limit
                held, n = [], 0
        if held:
            yield -math.inf, self.take(held, among)

    @staticmethod
    def take(held: list[np.ndarray], among: np.ndarray | None) -> np.ndarray:
        at = np.concatenate(held)
        return at if among is None else among[at]


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:n]


def near_positives(shard: Shard, anchor: int, label: int, raw: np.ndarray, least: float, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the shard's ``n`` highest rows of the label, without the anchor; scores under ``least`` may be left out."""
    vector, ids, scores = scaled(raw), np.empty(0, np.int64), np.empty(0, np.int64)
    among = shard.of_label(label)
    if len(among):
        for bound, at in shard.visit(vector, among):
            at = at[shard.ids[at] != anchor]
            ids, scores = np.append(ids, shard.ids[at]), np.append(scores, shard.scores(at, raw, vector))
            top = best(scores, ids, n)
            ids, scores = ids[top], scores[top]
            if bound < max(least, scores[-1] if len(scores) == n else -math.inf):
                break
    return ids, scores


def near_negatives(shard: Shard, label: int, raw: np.ndarray, windows: list[tuple[int, int]], n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window of scores, the ids and scores of the shard's ``n`` highest rows of other labels in it."""
    vector = scaled(raw)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
    highest = max(hi for _, hi in windows)
    visits = shard.visit(vector, None)
    step = next(visits, None)
    while step is not None:
        bound, at = step
        at = at[shard.labels[at] != label]
        scores = shard.scores(at, raw, vector)
        open_from = math.inf
        for w, (lo, hi) in enumerate(windows):
            fits = (scores >= lo) & (scores <= hi)
            if fits.any():
                ids, own = np.append(found[w][0], shard.ids[at[fits]]), np.append(found[w][1], scores[fits])
                top = best(own, ids, n)
                found[w] = ids[top], own[top]
            open_from = min(open_from, found[w][1][-1] if len(found[w][1]) == n else lo)
        if bound < open_from:
            break
        try:
            step = visits.send(highest)
        except StopIteration:
            step = None
    return found


def mine(
    work: Work,
    embeddings: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: rows of other labels that lie near below a positive.

    Components count as floor(256 * x), scores are integer inner products, higher first, ties to the smaller id. An
    anchor's positives are its first ``n_positives`` other rows of its label; each has as negatives the first
    ``n_negatives`` rows of other labels with ``low`` * positive <= 100 * negative <= ``high`` * positive.

    Two codebooks, fitted on at most 20,000 rows, quantise the halves of all rows; a cell is a pair of codewords, a shard
    two groups of nearby codewords. A row's half score lies within the anchor's length times the codeword's radius of
    the codeword's own, so a cell's scores are bounded by the sum for its halves. A shard's cells are visited by descending
    bound until what is to come can no longer enter a window. Anchors first visit the shard they are in themselves,
    then those whose bound reaches what that gave; for negatives, those whose bounds meet a window. So results are exact.

    A shard with many rows is split by a hash of the id, its anchors go through it in parts of some thousand. Scores beyond
    64 bits count as the nearest that fits. Rows that ``takes_part`` leaves out take no part; a vector without components
    scores 0. Other columns are ignored. An empty table gives no rows.
    """
    rows = work.keep(takes_part(embeddings.select("vec_id", "label", "embedding")), "rows")
    n, dims, _ = rows.agg(F.count("*"), F.max(F.size("embedding")), F.lit(0)).first()
    dims = max(dims or 0, 0)
    sample = np.zeros((1, dims))
    if n:
        some = rows.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("embedding").toArrow()["embedding"].to_pylist()
        sample = np.clip(scaled(np.array([v + [0.0] * (dims - len(v)) for v in some], np.float64).reshape(-1, dims)), -PLAIN, PLAIN)
    index = Index(sample, dims, n)
    shared = share(work.spark, index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            vectors = scaled(read(batch, dims))
            huge = (np.abs(vectors) > PLAIN).any(axis=1)
            new = []
            for book, half in zip(own.books, own.halves(np.clip(vectors, -PLAIN, PLAIN))):
                code, far = book.nearest(book.words, half)
                new += [pa.array(code.astype(np.int32)), pa.array(np.where(huge, np.inf, far))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "i", "far_i", "j", "far_j"])

    padded = F.concat("embedding", F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("embedding"))).alias("embedding")
    coded = rows.select("vec_id", "label", padded).mapInArrow(assign, "vec_id bigint, label bigint, embedding array<double>, i int, far_i double, j int, far_j double")
    coded = work.keep(coded, "coded")
    for book, code in zip(index.books, "ij"):  # a row per codeword
        for at, radius in coded.groupBy(code).agg(F.max(f"far_{code}")).collect():
            book.radius[at] = radius
    shared = share(work.spark, index)
    groups = index.shards()
    group = [F.element_at(F.array(*map(F.lit, book.group.tolist())), F.col(code) + 1) for book, code in zip(index.books, "ij")]
    coded = coded.withColumn("shard", (group[0] * groups[1] + group[1]).cast("int"))
    sizes = {s: c for s, c in coded.groupBy("shard").agg(F.count("*")).collect()}  # a row per pair of groups
    most = max(256, SHARD_NUMBERS // max(dims, 1))
    pieces = [max(1, -(-sizes.get(s, 0) // most)) for s in range(groups[0] * groups[1])]
    anchors = work.keep(coded.filter(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "embedding", "shard"), "anchors")
    parts = max(1, -(-anchors.count() // ANCHORS))
    numbers = {"shard": pa.array(range(len(pieces)), pa.int32()), "pieces": pa.array(pieces, pa.int32())}
    cut = F.broadcast(work.spark.createDataFrame(pa.table(numbers)))  # a row per pair of groups
    stored = coded.join(cut, "shard").withColumn("piece", F.pmod(F.xxhash64("vec_id"), F.col("pieces")).cast("int"))
    stored = stored.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    stored = stored.select("shard", "piece", "part", "vec_id", "label", "embedding", "i", "j")

    def routed(wanted: DataFrame) -> DataFrame:
        """An anchor's row for every piece of the shards it has to visit."""
        piece = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece")
        return wanted.join(cut, "shard").select("*", F.pmod(F.xxhash64("anchor_id"), F.lit(parts)).cast("int").alias("part"), piece)

    def reaching(wanted: DataFrame, least: str, most_of: str | None, home: bool) -> DataFrame:
        """The shards whose scores may lie between ``least`` and ``most_of``; ``home`` leaves out the anchor's own."""
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, place = shared.value, wanted_names.index("shard")
            for batch in batches:
                rows, to = [], []
                vectors = scaled(read(batch, dims))
                lows = batch[least].to_pylist()
                highs = batch[most_of].to_pylist() if most_of else [None] * len(lows)
                for row, (vector, shard, lo, hi) in enumerate(zip(vectors, batch["shard"].to_pylist(), lows, highs)):
                    if np.abs(vector).max(initial=0) > PLAIN:
                        go = np.ones(groups[0] * groups[1], bool)
                    else:
                        upper, lower = own.shard_bounds(vector)
                        go = (upper >= (-math.inf if lo is None else lo)) & (lower <= (math.inf if hi is None else hi))
                    if home:
                        go[shard] = False
                    found = np.flatnonzero(go)
                    rows.append(np.full(len(found), row))
                    to.append(found)
                if rows:
                    taken = batch.take(pa.array(np.concatenate(rows)))
                    columns = list(taken.columns)
                    columns[place] = pa.array(np.concatenate(to).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(columns, names=wanted_names)

        wanted_names = wanted.columns
        return wanted.mapInArrow(run, ddl)

    def positives_in(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [[], [], []]
        if left.num_rows and right.num_rows:
            shard, vectors = Shard(shared.value, left), read(right, dims)
            for raw, anchor, label, least in zip(vectors, *(right[c].to_pylist() for c in ("anchor_id", "label", "least"))):
                ids, scores = near_positives(shard, anchor, label, raw, -math.inf if least is None else least, n_positives)
                for to, values in zip(found, (np.full(len(ids), anchor), ids, scores)):
                    to.append(values)
        columns = [pa.array(np.concatenate([np.empty(0, np.int64), *c]).astype(np.int64)) for c in found]
        return pa.Table.from_arrays(columns, names=["anchor_id", "vec_id", "score"])

    def negatives_in(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [[], [], [], []]
        if left.num_rows and right.num_rows:
            shard, vectors = Shard(shared.value, left), read(right, dims)
            for raw, anchor, label, asked in zip(vectors, *(right[c].to_pylist() for c in ("anchor_id", "label", "positives"))):
                windows = [(w["least"], w["most"]) for w in asked]
                for w, (ids, scores) in zip(asked, near_negatives(shard, label, raw, windows, n_negatives)):
                    for to, values in zip(found, (np.full(len(ids), anchor), np.full(len(ids), w["positive_id"]), ids, scores)):
                        to.append(values)
        columns = [pa.array(np.concatenate([np.empty(0, np.int64), *c]).astype(np.int64)) for c in found]
        return pa.Table.from_arrays(columns, names=["anchor_id", "positive_id", "vec_id", "score"])

    key = ["shard", "piece", "part"]

    def searched(wanted: DataFrame, search, ddl: str) -> DataFrame:
        return stored.groupBy(key).cogroup(routed(wanted).groupBy(key)).applyInArrow(search, ddl)

    in_order = [F.desc("score"), F.col("vec_id")]
    by_anchor = Window.partitionBy("anchor_id").orderBy(*in_order)
    ddl = "anchor_id bigint, vec_id bigint, score bigint"
    at_home = work.keep(searched(anchors.withColumn("least", F.lit(None).cast("bigint")), positives_in, ddl), "home")
    nth = at_home.withColumn("place", F.row_number().over(by_anchor)).filter(F.col("place") == n_positives)
    away = reaching(anchors.join(nth.select("anchor_id", F.col("score").alias("least")), "anchor_id", "left"), "least", None, True)
    all_found = at_home.union(searched(away, positives_in, ddl)).withColumn("place", F.row_number().over(by_anchor))
    positives = all_found.filter(F.col("place") <= n_positives).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    positives = work.keep(positives, "positives")

    score = F.col("positive_score").cast("decimal(20,0)")
    bound = {
        "least": F.ceil(score * F.lit(low) / F.lit(100)).cast("bigint"),
        "most": F.floor(score * F.lit(high) / F.lit(100)).cast("bigint"),
    }
    windows = positives.withColumns(bound).filter("least <= most")
    asked = windows.groupBy("anchor_id").agg(
        F.collect_list(F.struct("positive_id", "least", "most")).alias("positives"), F.min("least").alias("least"), F.max("most").alias("most")
    )
    wanted = reaching(anchors.join(asked, "anchor_id"), "least", "most", False)
    negatives = searched(wanted, negatives_in, "anchor_id bigint, positive_id bigint, vec_id bigint, score bigint")
    ranked = negatives.withColumn("rank", F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(*in_order)))
    ranked = ranked.filter(F.col("rank") <= n_negatives).join(positives, ["anchor_id", "positive_id"])
    return ranked.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
