"""Substring dedup: Rabin-Karp hashes of all windows of words, counted in Spark, merged into maximal intervals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from landfall.llm.common import Work, slices

#: Windows that one task holds while it drops those a smaller document of its own has.
CHUNK = 2**18
#: Windows of a segment, at the most for texts of one-letter words.
SEGMENT = 2**22
#: Document ids that may be broadcast (some 100 MB on an executor); beyond, whole texts are joined.
BROADCAST_IDS = 4_000_000
#: What a null id counts as: smaller than all others.
NO_ID = -(2**63)

#: Bases of the two polynomials (any odd numbers).
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class Digests(dict):
    """128-bit hashes of words, computed once each; emptied when it grows past ``most`` entries."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_128_digest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole number, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for i below ``n``, by doubling."""
    found = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 2**64))
        found[done : 2 * done] = found[: min(done, n - done)] * step
        done *= 2
    return found[:n]


def window_hashes(text: str | None, width: int, digests: Digests) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit Rabin-Karp hashes of each window of ``width`` words: sums of word hashes times powers of a base, modulo 2^64.

    Both come from running sums: the sum up to a window's end less the one up to its start, shifted back by the
    inverse power of the base (which is odd, so it has one).
    """
    words = [np.frombuffer(b"".join(map(digests.__getitem__, some)), np.uint64).reshape(-1, 2) for some in map(bytes.split, slices((text or "").encode()))]
    words = np.concatenate(words) if words else np.empty((0, 2), np.uint64)
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    found = []
    for which, base in enumerate(BASES):
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words[:, which] * powers(base, len(words)), out=sums[1:])
        found.append(mixed((sums[width:] - sums[:n]) * powers(pow(base, -1, 2**64), n)))
    return found[0], found[1]


def packed(values: np.ndarray) -> bytes:
    """Compressed differences of integers, byte by byte of equal weight."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(len(steps), -1).T.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind), dtype=kind)


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return starts, np.append(starts[1:], len(keys))


def changes(*columns: np.ndarray) -> np.ndarray:
    """Which rows differ from the one before in any column."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


#: A block of windows: ``own`` tells those already known to be repeated, which need no hash.
BLOCK = pa.schema([("seg", pa.int32()), ("own", pa.bool_()), ("h", pa.binary()), ("tail", pa.binary()), ("doc", pa.binary()), ("variant", pa.binary()), ("pos", pa.binary())])
BLOCK_DDL = "seg int, own boolean, h binary, tail binary, doc binary, variant binary, pos binary"


class Sizes:
    """How many segments, and how many bytes of hash, ``windows`` call for.

    Two different windows share a hash with a probability below 2^-11, in all of the input: the bits are twice the
    logarithm of the number of windows and ten more. A segment's number is worth ``log2(segments)`` of them.
    """

    def __init__(self, windows: int):
        log = max(1, windows).bit_length()
        self.seg_bits = max(4, log - SEGMENT.bit_length() + 1)
        self.tail = min(6, max(0, -(-(2 * log + 10 - 64 - self.seg_bits) // 8)))

    def segment(self, h2: np.ndarray) -> np.ndarray:
        return (h2 >> np.uint64(64 - self.seg_bits)).astype(np.int32)

    def tails(self, h2: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(h2).view(np.uint8).reshape(-1, 8)[:, : self.tail]


def blocks(docs: DataFrame, width: int, sizes: Sizes) -> DataFrame:
    """All windows of ``docs (doc_id, variant, text)`` in blocks, by segment of their hash.

    Of the documents with the same window a task holds, only the one with the smallest id sends the hash on; the
    windows of others go along as already known. So a passage of a third of all documents is a window a task.
    """

    def encode(part: list[tuple[int, int, np.ndarray, np.ndarray, int]]) -> Iterator[pa.RecordBatch]:
        part.sort(key=lambda p: p[:2])
        lengths = [len(p[2]) for p in part]
        doc = np.repeat(np.array([p[0] for p in part], np.int64), lengths)
        variant = np.repeat(np.array([p[1] for p in part], np.int64), lengths)
        pos = np.concatenate([np.arange(p[4], p[4] + n) for p, n in zip(part, lengths)]).astype(np.int32)
        h1, h2 = np.concatenate([p[2] for p in part]), np.concatenate([p[3] for p in part])
        order = np.argsort(h1, kind="stable")
        starts, ends = grouped(h1[order])
        later = np.empty(len(order), bool)
        later[order] = doc[order] != np.repeat(doc[order][starts], ends - starts)
        seg = sizes.segment(h2)
        order = np.argsort(seg, kind="stable")
        starts, ends = grouped(seg[order])
        rows = []
        for start, end in zip(starts, ends):
            for own in (False, True):
                at = order[start:end]
                at = at[later[at] == own]
                if len(at):
                    h, tail = (b"", b"") if own else (h1[at].tobytes(), sizes.tails(h2[at]).tobytes())
                    rows.append((int(seg[at[0]]), own, h, tail, packed(doc[at]), packed(variant[at]), packed(pos[at])))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), BLOCK)], schema=BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, part, held, seen = Digests(), [], 0, set()
        for batch in batches:
            for doc, variant, text in zip(batch["doc_id"].to_pylist(), batch["variant"].to_pylist(), batch["text"]):
                if (doc, variant) in seen:
                    continue
                h1, h2 = window_hashes(text.as_py(), width, digests)
                for start in range(0, len(h1), CHUNK):
                    part.append((doc, variant, h1[start : start + CHUNK], h2[start : start + CHUNK], start))
                    held += len(part[-1][2])
                    if held >= CHUNK:
                        yield from encode(part)
                        part, held, seen = [], 0, set()
                if held:
                    seen.add((doc, variant))
        if part:
            yield from encode(part)

    return docs.mapInArrow(run, BLOCK_DDL)


def repeated(windows: DataFrame, sizes: Sizes) -> DataFrame:
    """The windows that a smaller document has, in blocks by a hash of the document."""
    parts = 2**sizes.seg_bits

    def run(table: pa.Table) -> pa.Table:
        own = np.array(table["own"].to_pylist(), bool)
        read = lambda name, kind: [unpacked(data, kind) for data in table[name].to_pylist()]
        docs, variants, pos = read("doc", "i8"), read("variant", "i8"), read("pos", "i4")
        n = np.array([len(d) for d in docs])
        mine = np.repeat(own, n)
        doc, variant, pos = np.concatenate(docs), np.concatenate(variants), np.concatenate(pos)
        h = np.frombuffer(b"".join(table["h"].to_pylist()), np.uint64)
        tail = np.frombuffer(b"".join(table["tail"].to_pylist()), np.uint8)
        wide = np.zeros((len(h), 8), np.uint8)
        wide[:, : sizes.tail] = tail.reshape(len(h), sizes.tail)
        wide, asked = wide.view(np.uint64).reshape(-1), np.flatnonzero(~mine)
        order = np.lexsort((doc[asked], wide, h))
        new = changes(h[order], wide[order])
        least = doc[asked[order]][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        lost = np.concatenate([np.flatnonzero(mine), asked[order[doc[asked[order]] != least]]]).astype(np.int64)
        doc, variant, pos = doc[lost], variant[lost], pos[lost]
        bucket = (mixed(doc.view(np.uint64) ^ mixed(variant.view(np.uint64))) % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((pos, variant, doc, bucket))
        rows = [
            (int(bucket[order[s]]), packed(doc[order[s:e]]), packed(variant[order[s:e]]), packed(pos[order[s:e]]))
            for s, e in zip(*grouped(bucket[order]))
        ]
        schema = pa.schema([("bucket", pa.int32()), ("doc", pa.binary()), ("variant", pa.binary()), ("pos", pa.binary())])
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return windows.groupBy("seg").applyInArrow(run, "bucket int, doc binary, variant binary, pos binary")


def intervals(lost: DataFrame, width: int) -> DataFrame:
    """``(doc_id, variant, starts, ends)``: overlapping and touching windows merged into maximal intervals of words."""

    def run(table: pa.Table) -> pa.Table:
        read = lambda name, kind: np.concatenate([unpacked(data, kind) for data in table[name].to_pylist()])
        doc, variant, pos = read("doc", "i8"), read("variant", "i8"), read("pos", "i4").astype(np.int64)
        order = np.lexsort((pos, variant, doc))
        doc, variant, pos = doc[order], variant[order], pos[order]
        other = changes(doc, variant)
        new = other.copy()
        new[1:] |= pos[1:] > pos[:-1] + width
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(new)) - 1
        offsets = np.append(np.flatnonzero(other[first]), len(first)).astype(np.int32)
        docs = first[other[first]]
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32))) for values in (pos[first], pos[last] + width)]
        return pa.Table.from_arrays([pa.array(doc[docs]), pa.array(variant[docs]), *lists], names=["doc_id", "variant", "starts", "ends"])

    return lost.groupBy("bucket").applyInArrow(run, "doc_id bigint, variant bigint, starts array<int>, ends array<int>")


def cut(text: str | None, starts: list[int], ends: list[int]) -> tuple[str | None, int, int]:
    """The words outside the intervals, joined by one space; how many words there were, and how many go."""
    kept, n, gone = [], 0, 0
    spans = list(zip(starts, ends))
    for words in map(bytes.split, slices((text or "").encode())):
        stay, at = [], 0
        while spans and spans[0][0] < n + len(words):
            start, end = max(0, spans[0][0] - n), min(len(words), spans[0][1] - n)
            stay += words[at:start]
            gone += end - start
            at = end
            if spans[0][1] > n + len(words):
                break
            spans.pop(0)
        stay += words[at:]
        n += len(words)
        if stay:
            kept.append(b" ".join(stay))
    return None if text is None else b" ".join(kept).decode(), n, gone


def removed(joined: DataFrame, columns: list[str]) -> DataFrame:
    """The texts of rows with ``_span_starts`` and ``_span_ends`` (null: none) less those words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [
                cut(text.as_py(), starts or [], ends or [])
                for text, starts, ends in zip(batch["text"], batch["_span_starts"].to_pylist(), batch["_span_ends"].to_pylist())
            ]
            arrays = [pa.array([d[0] for d in done], batch.schema.field("text").type) if c == "text" else batch[c] for c in columns]
            arrays += [pa.array([d[i] for d in done], pa.int64()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "n_words", "n_removed"])

    schema = joined.select(*columns).schema.add("n_words", LongType()).add("n_removed", LongType())
    return joined.select(*columns, "_span_starts", "_span_ends").mapInArrow(run, schema)


def dedup_substrings(
    work: Work, docs: DataFrame, width: int = 50, broadcast_ids: int = BROADCAST_IDS, sizes: Sizes | None = None
) -> DataFrame:
    """Every row of ``docs`` with its text less repeated passages, ``n_words`` and ``n_removed``.

    Words are runs without ASCII white space, unchanged. A window is ``width`` words in a row of one document. A window
    goes, with all its words, if the same words in a row start anywhere in a document with a smaller doc_id; the first
    document keeps its copy. Windows are judged on the input. What stays is joined by single spaces.

    1. Tasks hash every window and send the hashes, in compressed blocks, to the segment they belong to; of documents
       with the same window in one task, the smallest alone. Hashes are as long as the input needs (``Sizes``).
    2. A segment's task finds each hash's smallest document. Windows of other documents go, in blocks, to their document.
    3. There they merge into maximal intervals, one row per document that loses words.
    4. Rows of those documents are joined with their intervals; others need no join. Which is which is told by
       broadcast ids, while they number at most ``broadcast_ids``; beyond, all rows are joined.

    Nothing is capped: a segment holds about as many windows at any size, and a long text is hashed in pieces. Null and
    empty texts have no words; a null text stays null. A null id is one more document, smaller than all. Rows of one id
    are one document: they do not take words from each other, whatever their texts, and each loses what smaller documents
    have. Columns of ``docs`` with the names of the added ones are replaced. An empty table gives no rows.
    """
    docs = docs.drop("n_words", "n_removed")
    columns = docs.columns
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")
    letters = F.sum(F.octet_length("text")).cast("long").alias("letters")
    by_id = ids.groupBy("doc_id").agg(letters, F.min(F.xxhash64("text")).alias("low"), F.max(F.xxhash64("text")).alias("high"))
    total = by_id.agg(F.sum("letters").alias("letters"), F.max(F.col("low") != F.col("high")).alias("several")).first()
    # Only rows of one id with different texts need to be told apart by a hash of the text.
    variant = F.xxhash64("text") if total["several"] else F.lit(0).cast("long")
    sizes = sizes or Sizes((total["letters"] or 0) // 2 + 1)
    windows = blocks(ids.select("doc_id", variant.alias("variant"), "text"), width, sizes)
    spans = work.keep(intervals(repeated(windows, sizes), width), "intervals")
    spans = spans.select(F.col("doc_id").alias("_span_id"), F.col("variant").alias("_span_variant"), F.col("starts").alias("_span_starts"), F.col("ends").alias("_span_ends"))

    keyed = docs.withColumns({"_span_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_span_own": variant})
    on = (F.col("_span_key") == F.col("_span_id")) & (F.col("_span_own") == F.col("_span_variant"))
    if spans.count() > broadcast_ids:
        return removed(keyed.join(spans, on, "left"), columns)
    losers = F.broadcast(spans.select(F.col("_span_id").alias("_span_loser")).distinct())
    some = keyed.join(losers, F.col("_span_key") == F.col("_span_loser"), "left_semi").join(spans, on, "left")
    none = keyed.join(losers, F.col("_span_key") == F.col("_span_loser"), "left_anti")
    none = none.withColumns({c: F.lit(None).cast("array<int>") for c in ("_span_starts", "_span_ends")})
    return removed(some.select(*columns, "_span_starts", "_span_ends").union(none.select(*columns, "_span_starts", "_span_ends")), columns)
