"""MinHash near-dedup with sequential Bayesian verification of banded candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import Work, components

#: How the hashes of a signature are cut into bands, unless asked otherwise.
BANDS, ROWS = 24, 5
HASHES = BANDS * ROWS
#: Hashes compared at a time; a pair may be given up after each batch.
BATCH = 24


class WordHashes(dict):
    """64-bit hashes of words, computed once each; emptied when it grows past ``most`` entries."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, hashes: WordHashes, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of ``size`` words in a row; of the whole text, if it has fewer; none without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known = np.fromiter((hashes[w] for w in words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    value = np.full(n, min(len(words), size), np.uint64)
    for i in range(min(size, len(words))):
        value = value * np.uint64(0x9E3779B97F4A7C15) + known[i : i + n]
        value ^= value >> np.uint64(29)
    return np.unique(value)


def permutations(n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of ``n`` hash functions."""
    random = np.random.default_rng(seed)
    return random.integers(1, 2**64, n, np.uint64) | np.uint64(1), random.integers(0, 2**64, n, np.uint64)


def signature(items: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The smallest 32-bit hash under each function; ``items`` go in chunks, so long texts need no large matrix."""
    least = np.full(len(mult), 2**32 - 1, np.uint64)
    for start in range(0, len(items), 4096):
        values = items[None, start : start + 4096] * mult[:, None] + add[:, None]
        least = np.minimum(least, values.min(axis=1) >> np.uint64(32))
    return least.astype("<u4")


def least_matches(threshold: float, miss: float, total: int = HASHES, batch: int = BATCH) -> list[tuple[int, int]]:
    """``(n, m)`` per batch: with fewer than m matches among the first n hashes, P(similarity >= threshold) < ``miss``.

    The prior is uniform, so the posterior after m of n matches is Beta(m + 1, n - m + 1), and its upper tail at t
    equals a binomial lower tail: P(Binomial(n + 1, t) <= m).
    """
    from math import comb

    bounds = []
    for n in range(batch, total + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        bounds.append((n, m))
    return bounds


def survivors(left: np.ndarray, right: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Which pairs of signatures (rows) are still possible after all batches; pairs given up are compared no further."""
    alive, matches, done = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, least in bounds:
        matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
        alive, done = alive[matches[alive] >= least], n
    return alive


def signed(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, set_hash, sig)`` per row; equal sets have equal ``set_hash`` (128 bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (mult, add) = WordHashes(), permutations(HASHES)
        for batch in batches:
            sizes, marks, sigs = [], [], []
            for text in batch["text"]:
                items = shingles(text.as_py(), hashes)
                sizes.append(len(items))
                marks.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
                sigs.append(signature(items, mult, add).tobytes() if len(items) else None)
            arrays = [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_shingles", "set_hash", "sig"])

    schema = "doc_id bigint, n_shingles bigint, set_hash binary, sig binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def banded(reps: DataFrame, bands: int = BANDS, band_rows: int = ROWS) -> DataFrame:
    """``(bucket, id)``: one row per representative and band; the bucket hashes the band's number and its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 4 * band_rows
        for batch in batches:
            ids = np.repeat(batch["id"].to_numpy(zero_copy_only=False), bands)
            cuts = [
                xxhash.xxh3_64_intdigest(sig[b * width : (b + 1) * width], seed=b) for sig in batch["sig"].to_pylist() for b in range(bands)
            ]
            arrays = [pa.array(np.array(cuts, np.uint64).view(np.int64)), pa.array(ids.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "id"])

    return reps.select("id", "sig").mapInArrow(run, "bucket bigint, id bigint")


def likely(pairs: DataFrame, reps: DataFrame, threshold: float, miss: float) -> DataFrame:
    """The pairs ``(a, b)`` that sequential comparison of signature batches leaves possible."""
    bounds = least_matches(threshold, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lambda column: np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, HASHES)
        for batch in batches:
            if batch.num_rows:
                yield batch.select(["a", "b"]).take(pa.array(survivors(read(batch["sig_a"]), read(batch["sig_b"]), bounds)))

    sigs = reps.select("id", "sig")
    first = pairs.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
    both = first.join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b").select("a", "b", "sig_a", "sig_b")
    return both.mapInArrow(run, "a bigint, b bigint")


#: Ids that may be broadcast to pick the texts whose sets are needed (some 100 MB on an executor); beyond, texts are joined.
BROADCAST_IDS = 4_000_000


def item_sets(docs: DataFrame, wanted: DataFrame, broadcast_ids: int) -> DataFrame:
    """``(id, set_hash, items)``: sorted shingle hashes as bytes, of the rows of ``docs (id, text)`` whose id is ``wanted``."""
    wanted = F.broadcast(wanted) if wanted.count() <= broadcast_ids else wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            items = [shingles(t.as_py(), hashes).tobytes() for t in batch["text"]]
            marks = pa.array([xxhash.xxh3_128_digest(i) for i in items], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["id"], marks, pa.array(items, pa.binary())], names=["id", "set_hash", "items"])

    return docs.join(wanted, "id", "left_semi").mapInArrow(run, "id bigint, set_hash binary, items binary")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct items."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union of their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for row, (a, b) in enumerate(zip(batch["items_a"], batch["items_b"])):
                if similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), percent):
                    keep.append(row)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    first = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("items_a")), "a")
    both = first.join(sets.select(F.col("id").alias("b"), F.col("items").alias("items_b")), "b")
    return both.select("a", "b", "items_a", "items_b").mapInArrow(run, "a bigint, b bigint")


def one_document(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the representatives of different sets that rows of one id have."""
    classes = rows.select("doc_id", "set_hash").join(reps.select("set_hash", "id"), "set_hash")
    several = classes.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("doc_id", "a")
    return classes.join(several, "doc_id").filter("a < id").select("a", F.col("id").alias("b")).distinct()


def joined_in_buckets(rows: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links ``(a, b)`` that join different parts within a group of ``(bucket, i, j, block, id, part, sig, items)``.

    A group holds one block of a bucket (i = j), or two, whose members are compared across. Pairs of different parts go through
    the sequential comparison of signatures; what survives is verified on full sets, likeliest first, and a verified
    pair joins its parts, so later pairs of one part need no test. Links number less than the group's members.
    """
    bounds = least_matches(percent / 100, miss)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        sigs = np.frombuffer(b"".join(rows["sig"]), "<u4").reshape(len(rows), -1)
        items = [np.frombuffer(i, np.uint64) for i in rows["items"]]
        ids, block = rows["id"].to_numpy(), rows["block"].to_numpy()
        part = np.unique(rows["part"].to_numpy(), return_inverse=True)[1]
        across = rows["i"].iat[0] != rows["j"].iat[0]
        tests = []
        for x in range(len(rows) - 1):
            y = np.arange(x + 1, len(rows))
            y = y[(part[y] != part[x]) & (~across | (block[y] != block[x]))]
            y = y[survivors(np.broadcast_to(sigs[x], (len(y), sigs.shape[1])), sigs[y], bounds)]
            if len(y):
                tests.append(np.stack([np.full(len(y), x), y, (sigs[y] == sigs[x]).sum(axis=1)]))
        found = []
        if tests:
            x, y, matches = np.concatenate(tests, axis=1)
            for a, b in zip(*np.stack([x, y])[:, np.argsort(-matches, kind="stable")]):
                if part[a] != part[b] and similar(items[a], items[b], percent):
                    part[part == part[b]] = part[a]
                    found.append((ids[a], ids[b]))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return rows.groupBy("bucket", "i", "j").applyInPandas(run, "a bigint, b bigint")


def near_duplicates(
    work: Work,
    docs: DataFrame,
    percent: int = 85,
    miss: float = 1e-6,
    block_rows: int = 512,
    block_bytes: int = 32_000_000,
    bands: int = BANDS,
    band_rows: int = ROWS,
    broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked when 100 * |A & B| >= percent * |A | B| for their sets of 5-word shingles.

    1. Equal sets form a class, represented by its smallest id; only representatives go on.
    2. ``bands`` bands of ``band_rows`` MinHash rows (of 120 in all) put representatives into buckets. With the 24 of 5 a pair at 0.85
       misses all with odds 7e-7; at a lower ``percent`` ask for more bands of fewer rows.
    3. Each member is paired with its bucket's smallest id, one row a member. Signatures are compared in batches of 24
       hashes; a pair is given up when the posterior odds of reaching the threshold fall below ``miss``. Survivors are verified
       on their full sets, and verified links joined into parts.
    4. Buckets whose other members still belong to several parts are compared in full, inside tasks: members in blocks of about
       ``block_rows`` and ``block_bytes``, one task per pair of blocks, again sequentially and verified, skipping pairs of one
       part. Only links leave a task, fewer than it has members. So every two members of a bucket have been compared
       or are linked through others, whatever the bucket's size, and components are those of comparing all pairs.

    Sets are built for ids in shared buckets only, picked by broadcast ids while they number at most ``broadcast_ids``, else by
    a join. ``component_id`` is the smallest id reachable by links, ``kept`` marks the row that has it. Rows without words
    have no shingles and link with nothing, nor do rows with a null id (their component is null, and they are kept). Rows of
    one id are one document, which links with all that any of its texts links with: they share a component and are marked
    alike. An empty table gives no rows.
    """
    if bands * band_rows > HASHES:
        raise ValueError(f"{bands} bands of {band_rows} need more than the {HASHES} hashes of a signature")
    rows = work.keep(signed(docs), "signed")
    known = rows.filter("set_hash is not null and doc_id is not null")
    best = F.min(F.struct("doc_id", "sig")).alias("best")
    reps = known.groupBy("set_hash").agg(best).select("set_hash", F.col("best.doc_id").alias("id"), F.col("best.sig").alias("sig"))
    reps = work.keep(reps, "reps")
    rows_slim = work.keep(rows.select("doc_id", "n_shingles", "set_hash"), "rows")
    work.drop(rows)
    slim = rows_slim.filter("set_hash is not null and doc_id is not null")
    buckets = banded(reps, bands, band_rows)
    full = buckets.groupBy("bucket").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("bucket", "first")
    shared = work.keep(buckets.join(full, "bucket"), "buckets")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").filter("id is not null")
    wanted = work.keep(shared.select("id").distinct(), "wanted")
    sets = work.keep(item_sets(texts, wanted, broadcast_ids), "sets").dropDuplicates(["id", "set_hash"]).drop("set_hash")

    others = shared.filter("id <> first")
    pairs = work.keep(others.select(F.col("first").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    links = linked(work.keep(likely(pairs, reps, percent / 100, miss), "likely"), sets, percent).union(one_document(slim, reps))
    links = work.keep(links.distinct(), "links")
    parts = components(work, links)
    placed = others.join(parts, "id", "left").select("bucket", "id", F.coalesce("component_id", "id").alias("part"))
    open_rows = placed.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high")
    open_rows = placed.join(open_rows.select("bucket"), "bucket")
    loaded = open_rows.join(sets, "id").join(reps.select("id", "sig"), "id")
    loaded = work.keep(loaded.select("bucket", "id", "part", "sig", "items"), "open")
    size = loaded.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.octet_length("items")).alias("bytes"))
    blocks = F.ceil(F.greatest(F.col("n") / block_rows, F.col("bytes") / block_bytes)).cast("int")
    cut = loaded.join(size.select(F.col("bucket").alias("_bucket"), blocks.alias("blocks")), F.col("bucket") == F.col("_bucket"))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    more = joined_in_buckets(cut.select("bucket", i, j, "block", "id", "part", "sig", "items"), percent, miss)
    links = links.union(work.keep(more, "links").distinct())
    parts = components(work, links)
    work.drop(loaded)
    classes = reps.select("set_hash", "id").join(parts, "id", "left").select("set_hash", F.coalesce("component_id", "id").alias("_part"))
    own = rows_slim.join(classes, "set_hash", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_part", "doc_id")).alias("component_id")
    found = own.select("doc_id", "n_shingles", component)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
