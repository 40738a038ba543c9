"""Packing tokenized documents into windows by best-fit decreasing."""

from __future__ import annotations

import json
import os
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import Work

PIECE = "doc_id bigint, start bigint, length int, doc_tokens bigint, ids binary, part int, nth bigint"


#: Fixed value: how a byte-level pre-tokenizer cuts text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: visible Latin-1 for itself, the others from U+0100 on."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b and b != 0xAD)]
    other = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(other)}


def merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ids by token bytes, when a tokenizer file is a plain byte-level BPE whose ids follow its merges; None otherwise."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and cut.get("type") == "ByteLevel"
        and cut.get("use_regex", True)
        and not cut.get("add_prefix_space")
        and not any(spec.get(part) for part in ("normalizer", "post_processor", "truncation", "padding"))
        and not any(model.get(o) for o in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and not any(t.get(o) for t in spec["added_tokens"] for o in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not plain:
        return None
    vocab, letters, added = model["vocab"], byte_letters(), {t["content"] for t in spec["added_tokens"]}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merged = [vocab.get(a + b) for a, b in merges]
    ids = sorted([vocab.get(letter, -1) for letter in letters]) + merged
    if ids != list(range(256 + len(merges))) or len(vocab.keys() - added) != len(ids):
        return None
    return {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in added}


class Encoder:
    """Ids of whole texts from a tokenizer file, without special tokens around them.

    The ids are what the ``tokenizers`` library gives for the file. A plain byte-level BPE is applied by ``tiktoken``, with
    the ranks its merges define: the same ids for a sixth of the time. Any other file goes through ``tokenizers``.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ranks = merge_ranks(spec)
        if ranks:
            import tiktoken

            special = {t["content"]: t["id"] for t in spec["added_tokens"]}
            plain = tiktoken.Encoding(os.path.basename(path), pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=special)
            self._plain = partial(plain.encode_to_numpy, allowed_special="all")
        else:
            self._plain = None
        self._path, self._loaded = path, None

    def _whole(self, text: str) -> list[int]:
        if self._loaded is None:
            from tokenizers import Tokenizer

            self._loaded = Tokenizer.from_file(self._path)
        return self._loaded.encode(text, add_special_tokens=False).ids

    def _ids(self, text: str) -> np.ndarray | list[int]:
        if self._plain is None:
            return self._whole(text)
        try:
            return self._plain(text)
        except ValueError:  # its pattern gives up on about a million blanks in a row; the other library gives the same ids
            return self._whole(text)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return [np.array(self._ids(text or ""), "<u4") for text in texts]


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder per process and file: a tokenizer takes time and memory to load."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    pa.default_memory_pool().release_unused()
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int, batch_chars: int = 500_000) -> DataFrame:
    """Each document's ids and ``end_id``, cut into full windows and a rest: one row a piece, ids as little-endian uint32.

    ``nth`` numbers the pieces of one length within one task's part of the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, seen = encoder_of(tokenizer), TaskContext.get().partitionId(), [0] * (window + 1)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("doc_tokens", pa.int64()),
                            ("ids", pa.binary()), ("part", pa.int32()), ("nth", pa.int64())])

        def cut(docs: list[int | None], texts: list[str | None]) -> pa.RecordBatch:
            rows = []
            for doc, ids in zip(docs, encoder.encode(texts)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    rows.append((doc, start, len(piece), len(ids), piece.tobytes(), part, seen[len(piece)]))
                    seen[len(piece)] += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            docs, texts, chars = [], [], 0
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                docs.append(doc)
                texts.append(text.as_py())
                chars += len(texts[-1] or "")
                if chars >= batch_chars:
                    yield cut(docs, texts)
                    docs, texts, chars = [], [], 0
            if docs:
                yield cut(docs, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE)


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree that finds the tightest capacity that still fits.

    Windows of one capacity are runs of consecutive sequence numbers, so many alike are handled at once.
    """

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = [False] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(self.size)]

    def _mark(self, capacity: int) -> None:
        node = capacity + self.size
        self.tree[node] = bool(self.runs[capacity])
        while node > 1:
            node //= 2
            self.tree[node] = self.tree[2 * node] or self.tree[2 * node + 1]

    def put(self, capacity: int, first: int, count: int) -> None:
        """Windows ``first`` to ``first + count - 1`` now have ``capacity`` left."""
        if capacity and count:
            self.runs[capacity].append((first, count))
            self._mark(capacity)

    def take(self, capacity: int) -> tuple[int, int]:
        run = self.runs[capacity].pop()
        self._mark(capacity)
        return run

    def tightest(self, length: int) -> int:
        """The smallest capacity of at least ``length`` with an open window; 0 if there is none."""
        node = length + self.size
        if self.tree[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return 0


PLAN = "of long, from_rank long, to_rank long, first long, per int, at int, used int"


def best_fit(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int, int]]:
    """Best-fit decreasing over piece counts per length: ``(length, from, to, first, per, offset, used)`` rows.

    Row: pieces number ``from`` to ``to - 1`` of ``length`` go, ``per`` at a time, into sequences ``first``,
    ``first + 1`` ..., the first of each at ``offset``; these sequences end up with ``used`` ids. Pieces of one length
    are alike, so placing them by runs gives what placing them one by one would. The list is bounded by the window,
    not by the number of documents.
    """
    opened, plan, next_sequence = OpenWindows(window), [], 0
    for length in sorted(counts, reverse=True):
        done, n = 0, counts[length]
        while done < n:
            capacity = opened.tightest(length)
            per = (capacity or window) // length
            if capacity:
                first, count = opened.take(capacity)
            else:
                capacity, first, count = window, next_sequence, -(-(n - done) // per)
                next_sequence += count
            full = min(count, (n - done) // per)
            if full:
                plan.append((length, done, done + full * per, first, per, window - capacity))
                opened.put(capacity - per * length, first, full)
                done += full * per
            if full < count and done < n:
                plan.append((length, done, n, first + full, per, window - capacity))
                opened.put(capacity - (n - done) * length, first + full, 1)
                done, full = n, full + 1
            opened.put(capacity, first + full, count - full)
    left = sorted((first, count, capacity) for capacity, runs in enumerate(opened.runs) for first, count in runs)
    ends, used, at = [], [], 0  # sequences up to each end have so many ids
    for first, count, capacity in [*left, (next_sequence, 0, 0)]:
        if first > at:
            ends, used = [*ends, first], [*used, window]
        if count:
            ends, used = [*ends, first + count], [*used, window - capacity]
        at = first + count
    split = []
    for length, start, stop, first, per, offset in plan:
        i = bisect_right(ends, first)
        while start < stop:
            upto = min(stop, start + (ends[i] - first) * per)
            split.append((length, start, upto, first, per, offset, used[i]))
            start, first, i = upto, ends[i], i + 1
    return split


def pack(
    work: Work,
    docs: DataFrame,
    tokenizer: str,
    window: int = 1024,
    end_id: int = 0,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, padded`` and the columns of ``carry``.

    A document is its token ids and ``end_id``. Documents longer than the window are cut into full windows, which are
    sequences of their own, and a rest. Rests are packed by best-fit decreasing over all documents at once: the
    plan needs only how many rests of each length there are (at most ``window`` counts), and so do the broadcast
    rows that place them. A rest's number among those of its length comes from counts per task, so nothing is
    collected by length and no length can be hot. ``padded`` is the sequence's stored length: the window, or its own
    length when that is a power of two. ``carry`` maps names to expressions over ``ids`` (little-endian uint32 bytes),
    taken before any shuffle; by default the ids themselves.

    Null text is empty: the end id alone. Every row is packed, repeated rows and null ids too; other columns are
    ignored; an empty table gives no rows. The tokenizer file must be readable at its path on every worker.
    """
    carry = {"ids": F.col("ids")} if carry is None else carry
    cut = pieces(docs, tokenizer, window, end_id).select(
        "doc_id", "start", "length", "doc_tokens", "part", "nth", *[e.alias(name) for name, e in carry.items()]
    )
    cut = work.keep(cut, "pieces")
    per_part = work.keep(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    totals = per_part.groupBy("length").agg(F.sum("n").alias("n"))
    counts = {row["length"]: row["n"] for row in totals.collect()}  # at most one row per length up to the window
    whole = counts.pop(window, 0)
    plan = best_fit(counts, window)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = per_part.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = cut.join(starts, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
    placed = ranked.filter(F.col("length") < window).join(
        F.broadcast(work.spark.createDataFrame(plan, PLAN)),
        (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")),
    )
    step = F.col("rank") - F.col("from_rank")
    nth = F.floor(step / F.col("per"))
    sequence, offset = F.col("first") + nth + F.lit(whole), F.col("at") + (step - nth * F.col("per")) * F.col("length")
    names = ["doc_id", "start", "length", "doc_tokens", *carry]
    alone = ranked.filter(F.col("length") == window)
    packed = alone.select(*names, F.col("rank").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(window).alias("used"))
    packed = packed.union(placed.select(*names, sequence.alias("sequence_id"), offset.cast("long").alias("offset"), "used"))
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return packed.withColumn("padded", F.when(power, F.col("used")).otherwise(F.lit(window))).drop("used")
