"""Toxicity by compression distance under two zstandard dictionaries."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from landfall.llm.common import share
from landfall.llm.minhash import WordHashes, permutations, shingles, signature

#: Bytes per gram when the recurring parts of a class are looked for.
GRAM = 5
#: Window differences are counted between these bounds, in bytes.
LOW, HIGH = -6, 12


@dataclass
class Settings:
    """What a model is fitted with. The first three bound the sample of labelled documents, by count and by length."""

    toxic_docs: int = 3000
    ordinary_docs: int = 7000
    max_chars: int = 20_000
    window: int = 8
    step: int = 4
    base_bytes: int = 32_768
    own_bytes: int = 8_192
    min_docs: int = 6
    ratio: float = 30.0
    level: int = 3
    min_match: int = 5


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def windows(of: list[bytes], size: int, step: int) -> list[bytes]:
    """Overlapping windows of ``size`` words, ``step`` apart, that cover all words."""
    if not of:
        return []
    return [b" " + b" ".join(of[i : i + size]) + b" " for i in range(0, max(1, len(of) - size + step), step)]


def grams(word: bytes) -> set[bytes]:
    """The word with its borders, and its parts."""
    word = b" " + word + b" "
    return {word, *(word[i : i + GRAM] for i in range(len(word) - GRAM + 1))}


def distinct(texts: list[str]) -> list[str]:
    """The texts less near copies of earlier ones (a shared MinHash value of 5-word shingles out of four)."""
    hashes, (mult, add), seen, kept = WordHashes(), permutations(4), set(), []
    for text in texts:
        items = shingles(text, hashes)
        marks = set(enumerate(signature(items, mult, add).tolist())) if len(items) else {text}
        if not marks & seen:
            kept.append(text)
        seen |= marks
    return kept


def document_counts(docs: list[list[bytes]]) -> Counter:
    counts: Counter = Counter()
    for doc in docs:
        counts.update(set().union(*map(grams, set(doc))) if doc else set())
    return counts


def typical(own: list[list[bytes]], other: list[list[bytes]], min_docs: int, ratio: float) -> list[bytes]:
    """Words of ``own`` with a gram that recurs there, and is ``ratio`` times as frequent by document as in ``other``.

    Rarest first: a dictionary's end is cheapest to refer to.
    """
    here, there = document_counts(own), document_counts(other)
    scale = ratio * len(own) / max(1, len(other))
    marked = {g for g, n in here.items() if n >= min_docs and n >= scale * (there[g] + 1)}
    seen = Counter(w.strip(b".,;:!?\"'()") for doc in own for w in doc if grams(w) & marked)
    return sorted((w for w, n in seen.items() if w and n > 2), key=lambda w: (seen[w], w))


@dataclass
class Model:
    """Two dictionaries that share a base and differ in what is typical of a class; evidence per window difference; calibration."""

    settings: Settings
    toxic: bytes
    ordinary: bytes
    evidence: np.ndarray = field(default_factory=lambda: np.zeros(HIGH - LOW + 1))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))
    constant: float | None = None

    def open(self) -> Model:
        """Make the compressors; they stay in this process."""
        s = self.settings
        params = zstandard.ZstdCompressionParameters.from_level(
            s.level, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0,
            min_match=s.min_match, hash_log=17, window_log=18,
        )
        make = lambda content: zstandard.ZstdCompressor(
            dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params
        )
        self._toxic, self._ordinary = make(self.toxic).compress, make(self.ordinary).compress
        return self

    def __getstate__(self) -> dict:
        """Without the compressors, which cannot travel."""
        return {name: value for name, value in self.__dict__.items() if not name.startswith("_")}

    def differences(self, text: str | None) -> np.ndarray:
        """Per window: bytes under the ordinary dictionary less bytes under the toxic one, within LOW to HIGH."""
        found = [len(self._ordinary(w)) - len(self._toxic(w)) for w in windows(words(text), self.settings.window, self.settings.step)]
        return np.clip(np.array(found, np.int64), LOW, HIGH)

    def features(self, differences: np.ndarray) -> np.ndarray:
        """Constant, evidence per window, strongest evidence in sum, and length."""
        if not len(differences):
            return np.array([1.0, 0.0, 0.0, 0.0])
        found = self.evidence[differences - LOW]
        total = found.sum()
        return np.array([1.0, found.mean() * 10, np.sign(total) * np.log1p(abs(total)), np.log1p(len(found))])

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        at = float(self.features(self.differences(text)) @ self.weights)
        return float(1 / (1 + np.exp(-np.clip(at, -30, 30))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights by Newton steps; the ridge keeps separable data finite."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w + np.clip(np.linalg.solve(hessian, x.T @ (y - p) - ridge * w), -5, 5)
    return w


def train(toxic: list[str], ordinary: list[str], settings: Settings) -> Model:
    """Fit on labelled texts. One half of each class makes the dictionaries, the other calibrates;
    of near copies one counts, so that a copied document's words do not pass for its class's."""
    sides = []
    for texts in (toxic, ordinary):
        unique = distinct(texts)
        sides.append(([words(t) for t in unique[::2]], unique[1::2]))
    (own, own_rest), (other, other_rest) = sides
    if not own_rest or not other_rest:
        share = len(toxic) / max(1, len(toxic) + len(ordinary))
        return Model(settings, b"", b"", constant=share)
    plain = [w for doc in other for w in windows(doc, 64, 64)][:20_000]
    try:
        base = zstandard.train_dictionary(settings.base_bytes, plain, k=64, d=8).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        base = b"".join(plain)[: settings.base_bytes]
    bad = b" " + b" ".join(typical(own, other, settings.min_docs, settings.ratio)) + b" "
    bad = bad[-settings.own_bytes :]
    often = Counter(w.strip(b".,") for doc in other for w in doc)
    filler = [w for w, _ in often.most_common(40_000) if b" " + w not in base]
    good = (b" " + b" ".join(reversed(filler)) + b" ")[-len(bad) :]
    model = Model(settings, base + bad, base + good).open()
    found = [[model.differences(t) for t in rest] for rest in (own_rest, other_rest)]
    rates = []
    for side in found:
        # A document counts by the share of its windows, so that long ones do not outvote the rest.
        shares = [np.bincount(d - LOW, minlength=HIGH - LOW + 1) / len(d) for d in side if len(d)]
        total = np.sum(shares, axis=0) + 0.2 if shares else np.ones(HIGH - LOW + 1)
        rates.append(total / total.sum())
    model.evidence = np.log(rates[0] / rates[1])
    x = np.array([model.features(d) for side in found for d in side])
    y = np.array([1.0] * len(found[0]) + [0.0] * len(found[1]))
    model.weights = logistic(x, y)
    return model


def fit(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """A model from ``docs (doc_id, text)`` and ``labels (doc_id, toxic)``.

    The sample: of each class, the labelled ids with the smallest hashes, at most ``toxic_docs`` and ``ordinary_docs``
    of them, whose texts have at most ``max_chars`` characters; of several rows of an id, the one whose text has the smallest hash.
    It is bounded by these three, whatever the size of the tables and the rows of an id, and is fitted on the driver. A class with
    longer texts only is not learned. The calibration is moved to the classes' shares among all labels.
    Null labels, ids and texts are left out. If a class is missing, every text scores the share of toxic labels.
    """
    settings = settings or Settings()
    known = labels.filter("toxic is not null and doc_id is not null").select("doc_id", (F.col("toxic") == 1).alias("toxic"))
    shares = {row["toxic"]: row["n"] for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    texts: dict[bool, list[str]] = {}
    for toxic, most in ((True, settings.toxic_docs), (False, settings.ordinary_docs)):
        ids = known.filter(F.col("toxic") == toxic).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        own = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")
        own = own.filter((F.length("text") > 0) & (F.length("text") <= settings.max_chars))
        own = own.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        texts[toxic] = [row["text"] for row in sorted(own.collect(), key=lambda row: (row["doc_id"], row["text"]))]
    model = train(texts[True], texts[False], settings)
    bad, good = shares.get(True, 0), shares.get(False, 0)
    if model.constant is not None:
        model.constant = bad / max(1, bad + good)
    elif bad and good:
        # Prior correction: the sample's odds are replaced by those of all labels.
        model.weights[0] += np.log(bad / good) - np.log(len(texts[True]) / len(texts[False]))
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.3, keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with ``score``, 0 to 1, and ``predicted``, 1 from ``threshold`` on.

    ``keep`` names the columns of ``docs`` to return (all by default).

    Every window of the whole text is compressed twice; a window's evidence is the log ratio at which its difference
    occurs in toxic and in ordinary documents. Null and empty texts have no windows and score by the calibration's
    constants alone. Rows keep their number and values; columns named like the added ones are replaced.
    """
    columns = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    schema = docs.select(*columns).schema.add("score", DoubleType())
    docs = docs.select(*columns, *([] if "text" in columns else ["text"]))
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = shared.value.open() if shared.value.constant is None else shared.value
        for batch in batches:
            scores = pa.array([opened.score(text.as_py()) for text in batch["text"]], pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in columns], scores], names=[*columns, "score"])

    scored = docs.mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
