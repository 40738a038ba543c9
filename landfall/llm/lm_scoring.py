"""Language-model scoring from a log-frequency Bloom filter of quantised n-gram counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import WORD, Work, share
from landfall.llm.minhash import WordHashes

#: Stands for the end of a text, and before its first word. No word is white space, so no word has this hash's text.
END_TEXT = b"\n"
KEY_BITS = 48
KEY_MASK = np.uint64(2**KEY_BITS - 1)
PROBES = 4
#: Count ratio between neighbouring levels, per order: fine for single words, coarse for pairs.
BASES = {1: 1.2, 2: 2.0}


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def leveled(keys: np.ndarray, level: int) -> np.ndarray:
    """Hashes of n-grams together with a level."""
    return mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))


def levels(counts: np.ndarray, order: int) -> np.ndarray:
    """Quantised counts: level j holds counts from base^(j-1) up to base^j."""
    return 1 + np.floor(np.log(counts) / np.log(BASES[order]) + 1e-9).astype(np.int64)


def typical_counts(order: int, most: int = 256) -> np.ndarray:
    """By level: the geometric mean of the whole counts it holds (of its bounds, if it holds none); 0 for level 0."""
    base, found = BASES[order], [0.0]
    for j in range(1, most):
        low, high = base ** (j - 1), base**j
        first, last = int(np.ceil(low - 1e-9)), int(np.ceil(high - 1e-9)) - 1
        found.append(np.sqrt(float(first) * last) if 1 <= first <= last < 2**60 else low * np.sqrt(base))
    return np.array(found, float)


@dataclass
class Filter:
    """Bits in equal segments; an n-gram's key chooses its segment, so segments are built apart."""

    order: int
    segments: int
    segment_bits: int
    bits: np.ndarray | None = None

    def segment(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(self.segments)) >> np.uint64(KEY_BITS)

    def start(self, segment: int) -> int:
        """No key of the segment is smaller."""
        return (segment << KEY_BITS) // self.segments

    def places(self, keys: np.ndarray, level: int) -> Iterator[np.ndarray]:
        """Bit numbers within the segment, one array per probe."""
        x = leveled(keys, level)
        first, step = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
        for i in range(PROBES):
            yield (first + np.uint64(i) * step) % np.uint64(self.segment_bits)

    def build(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """One segment: each n-gram enters once per level up to its own."""
        flags, level, of = np.zeros(self.segment_bits, bool), 1, levels(counts, self.order)
        while len(keys):
            for place in self.places(keys, level):
                flags[place] = True
            level += 1
            keys, of = keys[of >= level], of[of >= level]
        return np.packbits(flags, bitorder="little")

    def probe(self, keys: np.ndarray, most: int = 255) -> np.ndarray:
        """The level of each key, up to ``most``: the last one in an unbroken row of levels found. It is never below the true level."""
        level, found, alive = 0, np.zeros(len(keys), np.int64), np.arange(len(keys))
        while len(alive) and level < most:
            level += 1
            some = keys[alive]
            start = self.segment(some) * np.uint64(self.segment_bits)
            # Of each probe only keys that passed the earlier ones go on.
            x = leveled(some, level)
            first, step = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
            for i in range(PROBES):
                place = start + (first + np.uint64(i) * step) % np.uint64(self.segment_bits)
                hit = (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                alive, start, first, step = alive[hit], start[hit], first[hit], step[hit]
            found[alive] = level
        return found


def tokens(text: str | None, hashes: WordHashes) -> np.ndarray:
    """64-bit hashes of a text's words and its end."""
    words = (text or "").encode().lower().split()
    words.append(END_TEXT)
    return np.fromiter((hashes[w] for w in words), np.uint64, len(words))


def single_keys(of: np.ndarray) -> np.ndarray:
    return mix(of) & KEY_MASK


def pair_keys(before: np.ndarray, of: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + of) & KEY_MASK


def packed(keys: np.ndarray, width: int) -> bytes:
    """Little-endian integers of ``width`` bytes."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return wide.view("<u8").ravel().astype(np.uint64)


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers in as many bytes each as the largest takes; the first byte says how many."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + packed(values.astype(np.uint64), width)


def widened(data: bytes) -> np.ndarray:
    return unpacked(data[1:], data[0])


CHUNKS = "chunk long, words binary, numbers binary, docs binary"
RUNS = "chunk long, n int, segment long, keys binary, counts binary"
#: A chunk number that stands for no rows: what a segment holds.
TOTALS = -2


class Numbers(dict):
    """Numbers of words by first appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def chunked(docs: DataFrame, keep: list[str], chunk_tokens: int) -> DataFrame:
    """Chunks of ``chunk_tokens`` tokens of ``docs (text, _training, ...)``: hashes of their words, the word numbers of all
    tokens, and the rows' ``keep`` columns with ``n_tokens`` and the mark as an Arrow stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, chunks = TaskContext.get().partitionId() << 32, 0
        known, numbers, held, size = Numbers(), [], [], 0
        columns = [*keep, "_training"]

        def flush() -> pa.RecordBatch:
            words = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), np.uint64, len(known))
            table = pa.Table.from_batches(held).append_column("n_tokens", pa.array([len(n) for n in numbers], pa.int64()))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            row = [words.tobytes(), squeezed(np.concatenate(numbers)), sink.getvalue().to_pybytes()]
            arrays = [pa.array([first + chunks]), *(pa.array([x], pa.binary()) for x in row)]
            return pa.RecordBatch.from_arrays(arrays, names=["chunk", "words", "numbers", "docs"])

        for batch in batches:
            start = 0
            for row, text in enumerate(batch["text"]):
                words = (text.as_py() or "").encode().lower().split()
                words.append(END_TEXT)
                numbers.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= chunk_tokens:
                    held.append(batch.slice(start, row + 1 - start).select(columns))
                    yield flush()
                    known, numbers, held, size, start = Numbers(), [], [], 0, row + 1
                    chunks += 1
            if start < batch.num_rows:
                held.append(batch.slice(start).select(columns))
        if held:
            yield flush()

    return docs.select(*keep, *[c for c in ("text", "_training") if c not in keep]).mapInArrow(run, CHUNKS)


def runs(values: np.ndarray, counts: np.ndarray, form: Filter) -> list[tuple[int, int, bytes, bytes]]:
    """``(n, segment, values, counts)`` per segment, of values in the order of their keys; pairs as differences."""
    segment = form.segment(single_keys(values) if form.order == 1 else values).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])) if len(values) else np.empty(0, np.int64)
    found = []
    for i, j in zip(cuts, np.append(cuts[1:], len(values))):
        own = values[i:j] if form.order == 1 else np.diff(values[i:j], prepend=form.start(int(segment[i])))
        found.append((form.order, int(segment[i]), squeezed(own), squeezed(counts[i:j])))
    return found


def chunk_runs(words: np.ndarray, numbers: np.ndarray, learned: np.ndarray, single: Filter, pair: Filter) -> list[tuple]:
    """Runs of a chunk's distinct words and pairs, each with how often it stands where ``learned`` is true."""
    by_key = np.argsort(single_keys(words), kind="stable")
    counts = np.bincount(numbers[learned], minlength=len(words))
    of = words[numbers]
    pairs, at = np.unique(pair_keys(np.append(of[-1:], of[:-1]), of), return_inverse=True)
    return runs(words[by_key], counts[by_key], single) + runs(pairs, np.bincount(at[learned], minlength=len(pairs)), pair)


def asked(chunks: DataFrame, single: Filter, pair: Filter) -> DataFrame:
    """The chunks' runs by segment: what to count and look up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk, words, numbers, docs = (batch[c][row] for c in ("chunk", "words", "numbers", "docs"))
                docs = pa.ipc.open_stream(docs.as_buffer()).read_all()
                learned = np.repeat(docs["_training"].to_numpy().astype(bool), docs["n_tokens"].to_numpy())
                words, numbers = np.frombuffer(words.as_buffer(), np.uint64), widened(numbers.as_py()).astype(np.int64)
                rows = chunk_runs(words, numbers, learned, single, pair)
                arrays = [pa.array(np.full(len(rows), chunk.as_py()))]
                arrays += [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), pa.int64(), pa.binary(), pa.binary()])]
                yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "n", "segment", "keys", "counts"])

    return chunks.mapInArrow(run, RUNS)


def answered(chunks: DataFrame, single: Filter, pair: Filter, n_tokens: int) -> DataFrame:
    """Each run with the levels (as ``keys``) the filter gives and the exact counts (as ``counts``).

    A group holds all runs of one segment: they are merged, the segment is built from them, and what they ask is looked up where it
    was built, so no segment leaves its task. A last row of chunk ``TOTALS`` says how many n-grams were counted, how many
    were asked without having been counted (``absent``), and how many of these the filter takes for counted ones (``wrong``).
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        n, segment = int(rows["n"].iat[0]), int(rows["segment"].iat[0])
        form, some = single if n == 1 else pair, [widened(k) for k in rows["keys"]]
        if n == 2:
            some = [np.cumsum(x) + np.uint64(form.start(segment)) for x in some]
        cuts = np.cumsum([len(x) for x in some])[:-1]
        values, at = np.unique(np.concatenate(some), return_inverse=True)
        times = np.concatenate([widened(c) for c in rows["counts"]])
        counts = np.bincount(at, times, len(values)).astype(np.int64)
        keys = single_keys(values) if n == 1 else values
        own, most = Filter(n, 1, form.segment_bits), int(levels(np.array([max(1, n_tokens)]), n)[0])
        known = counts > 0
        own.bits = own.build(keys[known], counts[known])
        all_levels = own.probe(keys, most).astype(np.uint8)
        found = all_levels[at]
        exact = [squeezed(x) for x in np.split(counts[at], cuts)]
        answers = pd.DataFrame({"chunk": rows["chunk"].to_numpy(), "keys": [x.tobytes() for x in np.split(found, cuts)], "counts": exact, "types": 0, "absent": 0, "wrong": 0})
        absent = counts == 0
        totals = {"chunk": TOTALS, "keys": None, "counts": None, "types": (~absent).sum(), "absent": absent.sum(), "wrong": (all_levels[absent] > 0).sum()}
        return pd.concat([answers, pd.DataFrame([totals])]).assign(n=n, segment=segment)

    schema = "chunk long, n int, segment long, keys binary, counts binary, types long, absent long, wrong long"
    return chunks.groupBy("n", "segment").applyInPandas(run, schema)


def left_out(counts: np.ndarray, row: np.ndarray, of: np.ndarray, order: int) -> np.ndarray:
    """Per token: the level of its n-gram's count in all rows but the token's own; ``of`` are the n-grams' numbers, as in ``counts``."""
    _, at, own = np.unique(row * np.int64(len(counts)) + of, return_inverse=True, return_counts=True)
    left = counts[of] - own[at]
    return np.where(left > 0, levels(np.maximum(left, 1), order), 0)


def lookups(words: np.ndarray, numbers: np.ndarray, sizes: np.ndarray, training: np.ndarray, told: dict[int, tuple[bytes, list[bytes]]]) -> tuple:
    """Per token of a chunk: levels of its word and of the pair it ends, and the exact count of its word; then the training tokens as
    ``(cells, times)``: how often (level before, level, pair level) stands there, each level without the token's own row.

    ``told`` has levels and counts of all runs in order of segments.
    """
    by_key = np.argsort(single_keys(words), kind="stable")
    level, count = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
    level[by_key] = np.frombuffer(told[1][0], np.uint8)
    count[by_key] = np.concatenate([widened(c) for c in told[1][1]])
    of = words[numbers]
    at = np.unique(pair_keys(np.append(of[-1:], of[:-1]), of), return_inverse=True)[1]
    pair_level, pair_count = np.frombuffer(told[2][0], np.uint8), np.concatenate([widened(c) for c in told[2][1]]).astype(np.int64)
    row, learned = np.repeat(np.arange(len(sizes)), sizes), np.repeat(training, sizes)
    single, pair = left_out(count, row, numbers, 1), left_out(pair_count, row, at, 2)
    before = np.append(single[-1:], single[:-1])
    cells, times = np.unique(((before << 16) | (single << 8) | pair)[learned], return_counts=True)
    return level[numbers], pair_level[at], count[numbers], cells, times


@dataclass
class Model:
    """Interpolated pair model over the filters.

    P(w | v) = s * c(vw) / c(v) + (1 - s) * (c(w) + 1) / (N + V + 1), with counts as the filters give them (N at most) and a
    share s by the level of c(v).
    """

    n_tokens: int
    n_types: int
    shares: np.ndarray

    def open(self) -> Model:
        self._of = {order: np.minimum(typical_counts(order), self.n_tokens) for order in BASES}
        return self

    def parts(self, single_level: np.ndarray, pair_level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token of one or more texts in a row: level of the token before, share of this pair among its followers, plain probability.

        Every text ends in the end token, which is also what stands before its first word.
        """
        level_before = np.append(single_level[-1:], single_level[:-1])
        count_before, count = self._of[1][level_before], self._of[1][single_level]
        # A pair is no more frequent than either of its words; this also bounds the effect of false hits.
        pairs = np.minimum(self._of[2][pair_level], np.minimum(count_before, count))
        followed = np.divide(pairs, count_before, out=np.zeros(len(pairs)), where=count_before > 0)
        return level_before, followed, (count + 1) / (self.n_tokens + self.n_types + 1)

    def log10(self, single_level: np.ndarray, pair_level: np.ndarray) -> np.ndarray:
        level_before, followed, plain = self.parts(single_level, pair_level)
        share = np.where(level_before > 0, self.shares[level_before], 0.0)
        return np.log10(share * followed + (1 - share) * plain)


def fitted_shares(model: Model, cells: np.ndarray, times: np.ndarray, rounds: int = 30, default: float = 0.1) -> np.ndarray:
    """Interpolation shares per level of the preceding word, by expectation-maximisation over all training tokens.

    ``cells`` are (level before, level, pair level), a byte each, that stand ``times`` often, counted without the token's own row.
    """
    shares, of = np.full(256, default), model.open()._of
    before, single, pair = cells >> 16, cells >> 8 & 255, cells & 255
    known = before > 0
    before, single, pair, times = before[known], single[known], pair[known], times[known]
    if len(before):
        followed = np.minimum(of[2][pair], np.minimum(of[1][before], of[1][single])) / of[1][before]
        plain = (of[1][single] + 1) / (model.n_tokens + model.n_types + 1)
        total = np.bincount(before, times, minlength=256)
        for _ in range(rounds):
            from_pair = shares[before] * followed
            won = times * from_pair / (from_pair + (1 - shares[before]) * plain)
            # A few pseudo-tokens at the default keep rare levels away from 0 and 1.
            shares = (np.bincount(before, won, minlength=256) + 20 * default) / (total + 20)
        # The full count of a word may have a level that no count without a row has: it takes its neighbours' share.
        some = np.flatnonzero(total)
        shares = np.interp(np.arange(256), some, shares[some])
    return np.clip(shares, 1e-4, 0.99)


def filters(n_tokens: int, all_tokens: int, bits_per_token: int = 8, segment_tokens: int = 2_500_000) -> tuple[Filter, Filter]:
    """Filters of words and pairs: ``bits_per_token`` bits a training token each, in segments of so many tokens counted or asked."""
    segments = min(2**15, max(4, -(-all_tokens // segment_tokens)))
    bits = -(-max(2**16, bits_per_token * n_tokens) // segments // 8) * 8
    return Filter(1, segments, bits), Filter(2, segments, bits)


def score(
    work: Work,
    docs: DataFrame,
    training: Column,
    keep: list[str] | None = None,
    bits_per_token: int = 8,
    chunk_tokens: int = 1_000_000,
    segment_tokens: int = 2_500_000,
    frequent: int | None = None,
) -> DataFrame:
    """Every row of ``docs`` with ``n_tokens, n_known, train_tokens, base_score, score``, learning from ``training`` rows.

    Tokens are a text's words, A-Z lower-cased, and one end. Map tasks cut texts into chunks and send each chunk's distinct words
    and pairs as sorted runs by segment of the filter, with their counts in training rows. Each segment is merged, built and asked
    by one task, about ``segment_tokens`` tokens wide; it sends one byte an n-gram back to the chunk, which is
    scored there. No filter is collected or broadcast. Segments go by a hash of the whole n-gram, so a frequent
    word's pairs spread over all of them.

    The filters (pairs; single words) hold every n-gram once per level of its quantised count and have ``bits_per_token`` bits a
    training token each, at any size, so the rate of false hits does not grow; these can only raise counts, at most to the number of
    training tokens. The interpolation shares are fitted on all training tokens, each by its pair's and words' counts in the
    other rows (levels of exact counts), so shares fall where pairs are not informative. A copy of a row under any id is another row. Of
    these tokens only how often each combination of levels stands there is gathered, which the number of levels bounds.

    ``base_score`` and ``n_known`` are exact: the task that builds a segment sends the counts along. ``frequent`` (words
    whose counts were once broadcast) has no effect any more.

    ``keep`` names the columns of ``docs`` to return (all by default). Null text is empty: one end token. Rows with null or
    repeated ids are scored one by one; a null ``training`` means held out. Without training rows every word is
    unknown and N is 0. Columns with the names of the added ones are replaced.
    """
    spark = work.spark
    own = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in own]
    marked = docs.withColumn("_training", F.coalesce(training, F.lit(False)))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)) + 1
    totals = marked.agg(F.sum(size).alias("all"), F.sum(F.when(F.col("_training"), size)).alias("training"), F.count_if("_training").alias("rows")).first()
    n_tokens = totals["training"] or 0
    single, pair = filters(n_tokens, totals["all"] or 0, bits_per_token, segment_tokens)

    rows = work.keep(chunked(marked, keep, chunk_tokens), "chunks", "zstd")
    answers = work.keep(answered(asked(rows, single, pair), single, pair, n_tokens), "answers", "zstd")
    n_types = answers.filter((F.col("chunk") == TOTALS) & (F.col("n") == 1)).agg(F.sum("types")).first()[0] or 0
    model = Model(n_tokens, n_types, np.zeros(256))
    asks = share(spark, model)

    def look(table: pa.Table) -> pa.Table:
        model = asks.value
        table = table.combine_chunks().sort_by([("n", "ascending"), ("segment", "ascending")])
        orders = table["n"].to_numpy()
        whole = table.slice(0, 1).to_pylist()[0]
        parts = {n: table.filter(pa.array(orders == n)) for n in (1, 2)}
        told = {n: (b"".join(part["keys"].to_pylist()), part["counts"].to_pylist()) for n, part in parts.items()}
        docs = pa.ipc.open_stream(whole["docs"]).read_all()
        sizes, training = docs["n_tokens"].to_numpy(), docs["_training"].to_numpy().astype(bool)
        words, numbers = np.frombuffer(whole["keys"], np.uint64), widened(whole["counts"]).astype(np.int64)
        single_level, pair_level, count, cells, times = lookups(words, numbers, sizes, training, told)
        starts = np.cumsum(sizes) - sizes
        base = np.log10(count + 1.0) - np.log10(float(model.n_tokens + model.n_types + 1))
        docs = docs.select([*keep, "n_tokens"])
        exact = [np.add.reduceat((count > 0).astype(np.int64), starts), np.full(len(sizes), model.n_tokens), np.add.reduceat(base, starts)]
        for name, values in zip(own[1:], exact):
            docs = docs.append_column(name, pa.array(values))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema) as writer:
            writer.write_table(docs)
        row = [sink.getvalue().to_pybytes(), single_level.astype(np.uint8).tobytes(), pair_level.tobytes()]
        found = pa.table([pa.array([x], pa.binary()) for x in row], names=["docs", "singles", "pairs"])
        return found.append_column("cells", pa.array([cells], pa.list_(pa.int64()))).append_column("times", pa.array([times], pa.list_(pa.int64())))

    plain = ["chunk", "n", "segment", "keys", "counts"]
    parts = rows.select("chunk", F.lit(0).alias("n"), F.lit(0).cast("long").alias("segment"), F.col("words").alias("keys"), F.col("numbers").alias("counts"), "docs")
    parts = parts.union(answers.filter("chunk >= 0").select(*plain, F.lit(None).cast("binary")))
    looked = parts.groupBy("chunk").applyInArrow(look, "docs binary, singles binary, pairs binary, cells array<long>, times array<long>")
    looked = work.keep(looked, "looked", "zstd")
    cells = looked.select(F.inline(F.arrays_zip("cells", "times"))).groupBy("cells").agg(F.sum("times").alias("times")).toPandas()
    model.shares = fitted_shares(model, cells["cells"].to_numpy(np.int64), cells["times"].to_numpy(np.int64))
    shared = share(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value.open()
        for batch in batches:
            for data, singles, pairs in zip(batch["docs"], batch["singles"], batch["pairs"]):
                docs = pa.ipc.open_stream(data.as_buffer()).read_all()
                sizes = docs["n_tokens"].to_numpy()
                tokens = model.log10(*(np.frombuffer(x.as_buffer(), np.uint8).astype(np.int64) for x in (singles, pairs)))
                docs = docs.append_column("score", pa.array(np.add.reduceat(tokens, np.cumsum(sizes) - sizes)))
                yield from docs.combine_chunks().to_batches()

    schema = docs.select(*keep).schema
    for field in spark.createDataFrame([], "n_tokens long, n_known long, train_tokens long, base_score double, score double").schema:
        schema = schema.add(field)
    return looked.select("docs", "singles", "pairs").mapInArrow(run, schema)
