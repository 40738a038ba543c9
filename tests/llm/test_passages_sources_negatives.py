"""Substring dedup, the source audit and hard-negative mining against brute force, and on odd rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from landfall.llm import divergence, hard_negatives, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# Substring dedup.


def brute_removal(rows, width):
    """``(id, text)`` rows to ``(id, n_words, n_removed, kept text)``."""
    key = lambda i: -(2**63) if i is None else i
    words = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for s in range(len(w) - width + 1):
            at = tuple(w[s : s + width])
            first[at] = min(first.get(at, key(i)), key(i))
    out = []
    for (i, t), w in zip(rows, words):
        gone = set()
        for s in range(len(w) - width + 1):
            if first[tuple(w[s : s + width])] < key(i):
                gone.update(range(s, s + width))
        out.append((i, len(w), len(gone), None if t is None else " ".join(x for n, x in enumerate(w) if n not in gone)))
    return sorted(out, key=str)


def passages(seed):
    rnd = random.Random(seed)
    shared = [" ".join(rnd.choice("abcde") for _ in range(rnd.randrange(3, 12))) for _ in range(4)]

    def text():
        parts = [rnd.choice(shared) if rnd.random() < 0.4 else " ".join(rnd.choice("abcdefghij é") for _ in range(rnd.randrange(9))) for _ in range(rnd.randrange(6))]
        return rnd.choice([" ", "\n", "\t  "]).join(parts)

    rows = [(rnd.choice([None, *range(20)]) if rnd.random() < 0.2 else n, None if rnd.random() < 0.05 else text()) for n in range(40)]
    return rows + rows[:3] + [(100 + n, rows[7][1]) for n in range(10)] + [(99, ""), (98, " \n "), (97, "x " * 3000)]


@pytest.mark.parametrize("seed, options", [(0, {}), (1, {"broadcast_ids": 0}), (2, {"sizes": substrings.Sizes(2**44)})])
def test_repeated_passages(spark, work, seed, options):
    rows = passages(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substrings.dedup_substrings(work, docs, width=4, **options).select("doc_id", "n_words", "n_removed", "text")
    assert sorted(map(tuple, got.collect()), key=str) == brute_removal(rows, 4)


def test_passages_keep_other_columns_and_empty_tables(spark, work, docs):
    odd = docs.withColumns({"n_words": F.lit("x"), "_span_key": F.lit("own"), "starts": F.lit(1)})
    got = substrings.dedup_substrings(work, odd, width=3)
    assert got.columns == [*(c for c in odd.columns if c != "n_words"), "n_words", "n_removed"]
    rows = sorted(((r["doc_id"], r["n_removed"]) for r in got.collect()), key=str)
    assert rows == [(1, 0), (1, 0), (2, 0), (3, 0), (4, 0), (None, 0)]
    assert substrings.dedup_substrings(work, odd.limit(0), width=3).count() == 0


def test_a_passage_of_every_document_stays_once(spark, work):
    passage = " ".join(f"w{n}" for n in range(60))  # and the word after it
    docs = spark.range(0, 3000, 1, 7).select(F.col("id").alias("doc_id"), F.concat(F.lit(passage), F.lit(" own "), "id").alias("text"))
    got = substrings.dedup_substrings(work, docs).agg(F.sum("n_removed"), F.min(F.when(F.col("n_removed") == 0, F.col("doc_id")))).first()
    assert tuple(got) == (61 * 2999, 0)


def test_long_texts_are_hashed_alike_in_pieces():
    text = " ".join(str(n % 977) for n in range(600_000))
    whole, _ = substrings.window_hashes(text, 50, substrings.Digests())
    late, _ = substrings.window_hashes(" ".join(text.split()[400_000:400_100]), 50, substrings.Digests())
    assert len(whole) == 600_000 - 49
    assert (whole[400_000:400_051] == late).all()
    words = text.split()
    kept, n, gone = substrings.cut(text, [5, 300_000], [10, 590_000])
    assert (n, gone) == (600_000, 290_005)
    assert kept.split() == words[:5] + words[10:300_000] + words[590_000:]


def test_hash_sizes_follow_the_corpus():
    for log in range(1, 50):
        sizes = substrings.Sizes(2**log)
        assert 64 + 8 * sizes.tail + sizes.seg_bits >= min(2 * log + 10, 100)
        assert 2 ** (log - sizes.seg_bits) <= substrings.SEGMENT


# Source divergence.


def brute_audit(rows, min_docs, top):
    rows = [(lang or "", source or "", TERM.findall(lower(text or ""))) for lang, source, text in rows]
    in_docs, groups = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in rows:
        in_docs[lang].update(set(words))
        groups[lang, source].update(words)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in in_docs[lang].items() if n >= min_docs)
        own = {s: c for (k, s), c in groups.items() if k == lang}

        def chance(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: chance(c) for s, c in own.items()}
        q = chance(sum(own.values(), Counter()))
        for s in own:
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in own if o != s]
            found = [(t, gap(p[s][t], q[t])) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", found, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, n + 1) for n, (item, value) in enumerate(ranked)]
    return sorted(out)


def labelled(seed, n=150):
    rnd = random.Random(seed)
    words = ["Alpha", "beta", "gamma", "délta", "Épsilon", "zeta9eta", "x_y", "日本", "q", "É"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(5) for j in range(6)]
    rows = [(rnd.choice(["en", "de", "", None]), rnd.choice(["a", "b", "c", "é", None, ""]), " ".join(rnd.choices(words, k=rnd.randrange(12)))) for _ in range(n)]
    return rows + rows[:9] + [("fr", "lonely", None), ("fr", "other", ""), ("it", "one", "some words " * 5)]


@pytest.mark.parametrize("seed, bits", [(0, 64), (1, 4), (2, 1)])
def test_source_audit(spark, work, seed, bits):
    """Few bits make terms share digests, which must change nothing."""
    rows = labelled(seed)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({"part": F.lit(1), "grp": F.lit("x")}).repartition(4)
    got = divergence.audit(work, docs, min_docs=6, top=4, bits=bits)
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == brute_audit(rows, 6, 4)


def test_source_audit_in_blocks_and_tiles(spark, work, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 7)
    monkeypatch.setattr(divergence, "TILE_GROUPS", 2)
    monkeypatch.setattr(divergence, "BROADCAST_TERMS", 0)
    rows = labelled(5)
    got = divergence.audit(work, spark.createDataFrame(rows, "lang string, source string, text string"), min_docs=4, top=10)
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, 4, 10)


def test_source_audit_of_nothing(spark, work):
    assert divergence.audit(work, spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_counts_beyond_64_bit_products(spark):
    n = 5 * 10**13
    row = spark.range(1).select(F.lit(n).alias("n"), F.lit(3 * n).alias("total"), F.lit(10**6).alias("terms"))
    assert row.select(divergence.probability(F.col("n"), "total", "terms")).first()[0] == 1 + 10**9 * (n + 2) // (3 * n + 2 * 10**6)


# Hard negatives.


def brute_negatives(rows, is_anchor, n_positives=5, n_negatives=3):
    dims = max((len(v) for _, _, v in rows if v is not None), default=0)
    best = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            best[i] = min(best.get(i, (v, label)), (v, label))
    whole = lambda x: int(x) * 256 if abs(x) >= 2.0**60 else math.floor(256 * x)
    q = {i: ([whole(x) for x in v] + [0] * (dims - len(v)), label) for i, (v, label) in best.items()}
    out = []
    for a in filter(is_anchor, q):
        score = {i: max(-(2**63) + 1, min(2**63 - 1, sum(x * y for x, y in zip(q[a][0], v)))) for i, (v, _) in q.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if q[i][1] == q[a][1]][:n_positives]:
            fits = [i for i in order if q[i][1] != q[a][1] and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, n + 1, i, score[p], score[i]) for n, i in enumerate(fits[:n_negatives])]
    return sorted(out)


def vectors(seed, n=400, dims=9):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 0.4) for _ in range(dims)] for _ in range(4)]
    rows = [(i, rnd.randrange(3), [x + rnd.gauss(0, 0.3) for x in rnd.choice(centres)]) for i in range(n)]
    rows += [(n + i, 0, rows[5][2]) for i in range(40)] + [(n + 50, 1, [0.0] * dims), (n + 51, 2, [1.0]), (n + 52, 0, [])]
    rows += [(n + 60, None, rows[1][2]), (n + 61, 1, None), (n + 62, 1, [math.nan] * dims), (n + 63, 1, [math.inf] * dims), (n + 64, 1, [None] * dims)]
    return rows + rows[:4] + [(3, 2, rows[9][2]), (None, 1, rows[1][2])]


SCHEMA = "vec_id long, label int, embedding array<double>"


@pytest.mark.parametrize("seed, large", [(0, False), (1, True)])
def test_hard_negatives(spark, work, monkeypatch, seed, large):
    monkeypatch.setattr(hard_negatives, "SHARD_NUMBERS", 400)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    rows = vectors(seed)
    if large:
        rows += [(900, 0, [3e38] * 9), (901, 1, [-3e38] * 9), (902, 2, [1e15] * 9), (903, 0, [2.0**41] * 9)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).repartition(3)
    anchor = (F.col("vec_id") % 10 == 0) | (F.col("vec_id") > 900)
    got = hard_negatives.mine(work, frame, anchor)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.select(*columns).collect())) == brute_negatives(rows, lambda i: i % 10 == 0 or i > 900)


def test_hard_negatives_of_few_rows(spark, work):
    assert hard_negatives.mine(work, spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    rows = [(1, 0, [1.0]), (2, 0, [2.0]), (3, 1, [1.5]), (4, 1, [1.5])]
    got = hard_negatives.mine(work, spark.createDataFrame(rows, SCHEMA), F.lit(True))
    assert sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())) == brute_negatives(rows, lambda i: True)


def test_cells_come_by_descending_bound():
    rnd = random.Random(1)
    u, v = (hard_negatives.np.array([rnd.random() for _ in range(n)]) for n in (7, 4))
    cells = list(hard_negatives.by_bound(u, v))
    assert sorted(c[1:] for c in cells) == [(i, j) for i in range(7) for j in range(4)]
    assert [c[0] for c in cells] == sorted((a + b for a in u for b in v), reverse=True)


def test_digest_of_kept_text(spark):
    """The query's digest is that of the text's bytes."""
    got = spark.range(1).select(F.sha2(F.lit("ä b").cast("binary"), 256)).first()[0]
    assert got == hashlib.sha256("ä b".encode()).hexdigest()
