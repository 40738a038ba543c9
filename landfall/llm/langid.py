"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from landfall.llm.common import share

#: Longest context, in bytes.
ORDER = 4
#: Bytes coded at a time. They take some 20 MB with ten languages, whatever the length of a word.
CHUNK = 2**17
#: Parts of a language that are ranked apart before its sample is picked.
SHARES = 32
ASCII_LETTER = re.compile("[A-Za-z]")
UNDETERMINED = "und"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def has_letter(text: str | None) -> bool:
    return bool(text) and (ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def context_tree(counts: Counter) -> dict[bytes, Counter]:
    """Followers of every context of up to ``ORDER`` bytes, from words with their counts.

    A word is coded with the space before it as context and the space after it as its last byte; contexts do not
    reach past the space, so a word costs the same wherever it stands.
    """
    tree: dict[bytes, Counter] = defaultdict(Counter)
    for word, n in counts.items():
        line = b" " + word + b" "
        for at in range(1, len(line)):
            for order in range(min(ORDER, at) + 1):
                tree[line[at - order : at]][line[at]] += n
    return tree


def number(data: bytes) -> int:
    return int.from_bytes(data, "big")


@dataclass
class Model:
    """Frozen statistics of all languages as sorted tables.

    ``keys`` holds every (context, byte) any language has seen; ``costs`` its code length in bits under each language,
    escapes to shorter contexts included. ``contexts`` and ``escapes`` do the same for leaving a context.
    """

    languages: list[str]
    keys: np.ndarray
    costs: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray

    def code_lengths(self, of: list[bytes]) -> np.ndarray:
        """Bits per word and language. Work goes on in chunks of about ``CHUNK`` bytes; a word may span several."""
        totals = np.zeros((len(of), len(self.languages)))
        pieces: list[tuple[int, bytes, int]] = []
        size = 0
        for i, word in enumerate(of):
            for piece, known in parts(b" " + word + b" "):
                pieces.append((i, piece, known))
                size += len(piece)
                if size >= CHUNK:
                    self._add(pieces, totals)
                    pieces, size = [], 0
        if pieces:
            self._add(pieces, totals)
        return totals

    def _add(self, pieces: list[tuple[int, bytes, int]], totals: np.ndarray) -> None:
        """Add the bits of pieces ``(word, bytes, bytes that are context only)`` to their words' totals."""
        data = np.frombuffer(b"".join(piece for _, piece, _ in pieces), np.uint8).astype(np.int64)
        sizes = np.array([len(piece) for _, piece, _ in pieces])
        ends = np.cumsum(sizes)
        at = np.arange(len(data)) - np.repeat(ends - sizes, sizes)
        # Before each byte: the number of its context of 0 to ORDER bytes.
        context = [np.zeros(len(data), np.int64)]
        for order in range(1, ORDER + 1):
            shifted = np.concatenate([np.zeros(order, np.int64), data[:-order]])[: len(data)]
            context.append(context[-1] + (shifted << (8 * (order - 1))))
        bits = np.zeros((len(data), len(self.languages)))
        coded = at >= np.repeat([known for _, _, known in pieces], sizes)
        left = coded.copy()
        for order in range(ORDER, -1, -1):
            here = np.flatnonzero(left & (at >= order))
            key = (order << 40) | (context[order][here] << 8) | data[here]
            found, hit = lookup(self.keys, key)
            bits[here[hit]] += self.costs[found[hit]]
            left[here[hit]] = False
            missed = here[~hit]
            found, hit = lookup(self.contexts, (order << 40) | context[order][missed])
            bits[missed[hit]] += self.escapes[found[hit]]
        bits[left] += 8.0  # a byte no language has seen: one of 256
        bits[~coded] = 0
        np.add.at(totals, [i for i, _, _ in pieces], np.add.reduceat(bits, ends - sizes, axis=0))


def parts(line: bytes, size: int = 2**16) -> Iterator[tuple[bytes, int]]:
    """A bordered word in pieces that code ``size`` bytes at most, each with how many of its first bytes are context only."""
    for start in range(1, len(line), size):
        before = min(ORDER, start)
        yield line[start - before : start + size], before


def lookup(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def train(samples: dict[str, Counter]) -> Model:
    """Tables from words with counts per language. Escapes use method C: as likely as the number of distinct followers."""
    languages = sorted(samples)
    trees = [context_tree(samples[lang]) for lang in languages]
    contexts = sorted({c for tree in trees for c in tree}, key=lambda c: (len(c), c))
    escapes, keys, costs = {}, [], []
    known: dict[tuple[bytes, int], np.ndarray] = {}
    for context in contexts:  # shorter ones first, so what an escape leads to is there
        followers = [tree.get(context, Counter()) for tree in trees]
        totals = [sum(f.values()) for f in followers]
        leave = np.array([np.log2((t + len(f)) / len(f)) if f else 0.0 for f, t in zip(followers, totals)])
        escapes[context] = leave
        for byte in set().union(*followers):
            shorter = known[context[1:], byte] if context else np.full(len(trees), 8.0)
            seen = np.array([f.get(byte, 0) for f in followers])
            whole = np.array([t + len(f) for f, t in zip(followers, totals)])
            own = np.log2(np.maximum(whole, 1) / np.maximum(seen, 1))
            known[context, byte] = np.where(seen > 0, own, leave + shorter)
    place = lambda c: (len(c) << 40) | number(c)
    items = sorted(((len(c) << 40) | (number(c) << 8) | b, cost) for (c, b), cost in known.items()) if known else []
    keys = np.array([k for k, _ in items], np.int64)
    costs = np.array([c for _, c in items]).reshape(len(items), len(languages))
    left = sorted((place(c), e.tolist()) for c, e in escapes.items())
    return Model(languages, keys, costs, np.array([k for k, _ in left], np.int64), np.array([e for _, e in left]).reshape(len(left), len(languages)))


def excerpt(text: Column, max_chars: int, windows: int = 10) -> Column:
    """A text of up to ``max_chars`` characters as it is; of a longer one, windows spread evenly over all of it, as long together."""
    size, length = max_chars // windows, F.length(text)
    starts = [F.floor((length - size) * i / (windows - 1)).cast("int") + 1 for i in range(windows)]
    return F.when(length <= max_chars, text).otherwise(F.concat_ws("\n", *[F.substring(text, start, F.lit(size)) for start in starts]))


def fit(docs: DataFrame, docs_per_language: int = 200, max_chars: int = 20_000) -> Model:
    """Context trees from ``docs (doc_id, text, lang)``, on a bounded sample: per language the ``docs_per_language`` ids with the
    smallest hashes among texts of 1 to ``max_chars`` characters, and if those are fewer, ids of longer texts, by excerpts of
    ``max_chars`` characters spread over the text. Of several rows of an id and language one counts, by its text's hash. The
    driver receives no more than that. Null languages, ids and texts are left out; without any the model knows no language.
    """
    known = docs.filter("lang is not null and doc_id is not null").filter(F.length("text") > 0).select("doc_id", "lang", "text")
    known = known.withColumn("text_hash", F.xxhash64("text"))
    first = F.min(F.struct((F.length("text") > max_chars).alias("long"), "text_hash")).alias("first")
    ids = known.groupBy("doc_id", "lang").agg(first).select("doc_id", "lang", "first.*")
    # A language may hold most rows: its first ids are those among the first ones of shares of it.
    ids = ids.withColumn("share", F.pmod(F.hash("doc_id"), F.lit(SHARES)))
    for part in (["lang", "share"], ["lang"]):
        order = Window.partitionBy(*part).orderBy("long", F.xxhash64("doc_id"), "doc_id")
        ids = ids.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= docs_per_language)
    key = ["doc_id", "lang", "text_hash"]
    sample = known.join(F.broadcast(ids.select(*key)), key, "left_semi")
    sample = sample.select(*key, excerpt(F.col("text"), max_chars).alias("text")).groupBy(*key).agg(F.min("text").alias("text"))
    samples: dict[str, Counter] = defaultdict(Counter)
    for row in sample.collect():
        samples[row["lang"]].update(words(row["text"]))
    return train(samples)


class Costs(dict):
    """Row numbers of words' code lengths; starts anew beyond ``most`` words. Very long words are not kept."""

    def __init__(self, model: Model, most: int = 500_000, longest: int = 64):
        super().__init__()
        self.model, self.most, self.longest = model, most, longest
        self.bits = np.empty((0, len(model.languages)))

    def of(self, texts: list[str | None]) -> np.ndarray:
        """Bits per text and language."""
        split = [words(text) for text in texts]
        new = list({w for some in split for w in some} - self.keys())
        if len(self) + len(new) > self.most:
            self.clear()
            self.bits = self.bits[:0]
            new = list({w for some in split for w in some})
        totals = np.zeros((len(texts), len(self.model.languages)))
        if new:
            self.update(zip(new, range(len(self.bits), len(self.bits) + len(new))))
            self.bits = np.concatenate([self.bits, *[self.model.code_lengths(new[i : i + 50_000]) for i in range(0, len(new), 50_000)]])
        for i, some in enumerate(split):
            if some:
                totals[i] = self.bits[np.fromiter(map(self.__getitem__, some), np.int64, len(some))].sum(axis=0)
        for word in [w for w in new if len(w) > self.longest]:
            del self[word]
        return totals


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None, batch_chars: int = 2_000_000) -> DataFrame:
    """Every row of ``docs`` with ``lang_pred`` and ``score``.

    The language whose tree gives the whole text the shortest code wins, ties to the smaller name. ``score`` is its
    share of two to the minus code length over all languages. Null texts and those without a letter are ``und``, score 0; so is
    everything if the model knows no language. ``keep`` names the columns of ``docs`` to return (all by default); columns
    with the names of the added ones are replaced. The model is bounded by its sample and broadcast.
    """
    columns = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    schema = docs.select(*columns).schema.add("lang_pred", StringType()).add("score", DoubleType())
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        costs = Costs(model)

        def judged(texts: list[str | None]) -> list[tuple[str, float]]:
            found = []
            for text, bits in zip(texts, costs.of(texts)):
                if not model.languages or not has_letter(text):
                    found.append((UNDETERMINED, 0.0))
                    continue
                best = int(bits.argmin())
                found.append((model.languages[best], float(1 / np.exp2(np.clip(bits[best] - bits, -1000, 0)).sum())))
            return found

        for batch in batches:
            found, texts, chars = [], [], 0
            for text in batch["text"]:
                texts.append(text.as_py())
                chars += len(texts[-1] or "")
                if chars >= batch_chars:
                    found += judged(texts)
                    texts, chars = [], 0
            found += judged(texts)
            arrays = [*[batch[c] for c in columns], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "lang_pred", "score"])

    return docs.select(*columns, *([] if "text" in columns else ["text"])).mapInArrow(run, schema)
