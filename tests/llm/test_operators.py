"""Every operator against a brute-force version on small input, and on odd rows."""

import itertools
import json
import math
import random
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from landfall.llm import ann, graph_dedup, langid, line_dedup, lm_scoring, minhash, mixing, packing, toxicity, url_rules
from landfall.llm.common import components, fold
from landfall.llm.queries import HOST_RULES, QUERIES, tokenizer
from landfall.llm.vectors import usable

SF = "/root/testdata/sf0.001"
FULL = "doc_id long, text string, lang string, source string, n_chars long"


def none(df):
    return df.filter(F.lit(False))


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert {"op4_mixing", "op8_line_dedup", "op9_minhash_dedup"} <= set(oracle_sql())


def test_components(spark, work):
    edges = spark.createDataFrame([(i, i + 1) for i in range(2, 40)] + [(50, 60), (60, 50)], "a long, b long")
    found = {r.id: r.component_id for r in components(work, edges).collect()}
    assert found == {**{i: 2 for i in range(2, 41)}, 50: 50, 60: 50}


# 1: LM scoring


def test_lm_scores(spark, work):
    docs = table(spark, "documents").select("doc_id", "text")
    got = {r.doc_id: r for r in lm_scoring.score(work, docs, fold(F.col("doc_id"), 7) != 2, frequent=50).collect()}
    rows = docs.collect()
    tokens = {r.doc_id: [*(r.text or "").encode().lower().split(), None] for r in rows}
    held = {d for d in tokens if zlib.crc32(str(d).encode()) % 7 == 2}
    counts = Counter(t for d, some in tokens.items() if d not in held for t in some)
    n, v = sum(counts.values()), len(counts)
    for d, some in tokens.items():
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in some)
        assert (got[d].n_tokens, got[d].n_known, got[d].train_tokens) == (len(some), sum(counts[t] > 0 for t in some), n)
        assert got[d].base_score == pytest.approx(base, rel=1e-9)
        assert got[d].score <= 0
    assert sum(got[d].score for d in held) > sum(got[d].base_score for d in held)


def test_filter_never_misses():
    keys = lm_scoring.mix(np.arange(5000, dtype=np.uint64)) & lm_scoring.KEY_MASK
    counts = np.random.default_rng(1).integers(1, 500, 5000)
    form = lm_scoring.Filter(2, 1, 8 * 40_000)
    form.bits = form.build(keys, counts)
    true, found = lm_scoring.levels(counts, 2), form.probe(keys)
    assert (found >= true).all() and (found == true).mean() > 0.95
    other = lm_scoring.mix(np.arange(5000, 9000, dtype=np.uint64)) & lm_scoring.KEY_MASK
    assert (form.probe(other) > 0).mean() < 0.05


def test_lm_filters_follow_the_corpus(spark, work):
    for n in (10**6, 10**8, 5 * 10**9):  # a fixed load, so false hits stay as rare
        assert all(f.segments * f.segment_bits >= 8 * n for f in lm_scoring.filters(n, n))
    model = lm_scoring.Model(1000, 10, np.full(256, 0.1)).open()
    assert all(counts.max() <= 1000 for counts in model._of.values())
    docs, training = table(spark, "documents").select("doc_id", "text"), fold(F.col("doc_id"), 7) != 2
    # With next to no false hits, cutting into chunks and segments makes no difference.
    whole = {r.doc_id: r for r in lm_scoring.score(work, docs, training, bits_per_token=128).collect()}
    cut = {r.doc_id: r for r in lm_scoring.score(work, docs, training, bits_per_token=128, chunk_tokens=3000, segment_tokens=5000).collect()}
    assert whole.keys() == cut.keys() and len(whole) == docs.count()
    for d, row in whole.items():
        assert cut[d][:4] == row[:4] and cut[d].base_score == pytest.approx(row.base_score, rel=1e-9)
        assert cut[d].score == pytest.approx(row.score, rel=1e-3)


def test_lm_learns_pairs_of_small_corpora(spark, work):
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words)) for i in range(60)] + [(100, " ".join(words)), (101, " ".join(words[::-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.score for r in lm_scoring.score(work, docs, F.col("doc_id") < 100).collect()}
    assert found[100] > found[101] + 10  # the same words, in an order that was learned or not
    # A pair that only a tuning text holds is learned as well: every training text's own pair is known when it is scored.
    rows = [(i, f"a{i} b{i}") for i in range(40)] + [(100 + i, f"b{i} a{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.score for r in lm_scoring.score(work, docs, F.col("doc_id") < 100).collect()}
    assert all(found[i] > found[100 + i] for i in range(40))


def test_lm_odd_rows(work, docs):
    found = lm_scoring.score(work, docs, F.col("doc_id") == 1).collect()
    assert sorted(r.n_tokens for r in found) == [1, 1, 4, 8, 8, 60_001]
    assert all(r.train_tokens == 16 for r in found)
    untrained = lm_scoring.score(work, docs, F.lit(None).cast("boolean")).collect()
    assert {r.n_known for r in untrained} == {0} and {r.train_tokens for r in untrained} == {0}
    assert lm_scoring.score(work, none(docs), F.lit(True)).collect() == []


# 2: toxicity


def toxic_corpus(n=600):
    random.seed(4)
    plain = ["".join(random.choices("abcdefgh", k=random.randint(3, 8))) for _ in range(300)]
    texts, labels = [], []
    for i in range(n):
        words = random.choices(plain, k=120)
        if i % 4 == 0:
            for at in random.sample(range(120), 8):
                words[at] = random.choice(["zorkon", "vuxxer", "quizzop"])
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_toxicity_held_out(spark):
    texts, labels = toxic_corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    model = toxicity.fit(docs.filter("doc_id < 400"), marks.filter("doc_id < 400"))
    found = toxicity.score(docs.filter("doc_id >= 400"), model).collect()
    hits = [(r.predicted, labels[r.doc_id]) for r in found]
    assert sum(p == y for p, y in hits) / len(hits) > 0.95


def test_toxicity_odd_rows(spark, docs):
    nothing = toxicity.fit(none(docs), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}
    texts, labels = toxic_corpus(200)
    model = toxicity.train([t for t, y in zip(texts, labels) if y], [t for t, y in zip(texts, labels) if not y], toxicity.Settings())
    found = toxicity.score(docs, model).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert toxicity.score(none(docs), model).collect() == []


def test_toxicity_scores_by_hand(spark):
    """Scores are window lengths under the model's two dictionaries, weighed and calibrated; one row of an id teaches, whatever their number."""
    texts, labels = toxic_corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    again = toxicity.fit(docs.union(docs).union(docs), marks.union(marks.limit(0)))
    assert (again.toxic, again.ordinary) == (model.toxic, model.ordinary) and again.weights.tolist() == model.weights.tolist()
    s = model.settings
    params = zstandard.ZstdCompressionParameters.from_level(
        s.level, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0,
        min_match=s.min_match, hash_log=17, window_log=18,
    )

    def length(window, dictionary):
        content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(dict_data=content, compression_params=params).compress(window))

    sample = [*texts[:3], *texts[-3:], "", None, "one", " ".join(texts[:2])]
    frame = spark.createDataFrame(list(enumerate(sample)), "doc_id long, text string")
    for r in toxicity.score(frame, model).collect():
        words = (sample[r.doc_id] or "").encode().lower().split()
        starts, at = [], 0
        while words and (not starts or starts[-1] + s.window < len(words)):
            starts.append(at)
            at += s.step
        found = []
        for start in starts:
            window = b" " + b" ".join(words[start : start + s.window]) + b" "
            less = length(window, model.ordinary) - length(window, model.toxic)
            found.append(model.evidence[max(toxicity.LOW, min(toxicity.HIGH, less)) - toxicity.LOW])
        at = model.weights[0]
        if found:
            total = sum(found)
            at += model.weights[1] * 10 * total / len(found) + model.weights[2] * math.copysign(math.log1p(abs(total)), total)
            at += model.weights[3] * math.log1p(len(found))
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, at)))), rel=1e-9)
        assert r.predicted == (r.score >= 0.3)


# 3: nearest neighbours


def test_ann_recall(spark):
    vectors = usable(table(spark, "embeddings"))
    found = defaultdict(list)
    for r in ann.search(vectors, vectors.filter("vec_id % 10 = 0"), block_rows=200).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    rows = {r.vec_id: np.array(r.embedding) for r in vectors.collect()}
    right = 0
    for q, near in found.items():
        true = sorted((math.dist(rows[q], x), i) for i, x in rows.items() if i != q)[:10]
        right += len({i for _, i in true} & {i for i, _ in near})
        assert near == sorted(near, key=lambda p: (p[1], p[0]))
        assert all(s == pytest.approx(math.dist(rows[q], rows[i]), rel=1e-12) for i, s in near)
    assert right / (10 * len(found)) >= 0.95


def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [0.0, 2.0]), (None, [1.0, 0.0])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_ann_odd_rows(spark):
    vectors = usable(odd_vectors(spark))
    found = [(r.query_id, r.rank, r.vec_id) for r in ann.search(vectors, vectors.filter("vec_id = 0")).collect()]
    assert found == [(0, 1, 1), (0, 2, 7)]
    assert ann.search(none(vectors), none(vectors)).collect() == []


def test_ann_loses_no_finite_vector(spark):
    """Differences whose squares, sums or projections leave the range of doubles."""
    large, small = 1.5e308, 3e-200
    points = {0: [1.0, 0.0], 1: [1e200, 0.0], 2: [0.0, -1e200], 3: [large, large], 4: [-large, large], 5: [1.0, small], 6: [1.0, 0.0], 7: [2.0, 0.0]}
    vectors = spark.createDataFrame(list(points.items()), "vec_id long, embedding array<double>")
    found = [(r.vec_id, r.score) for r in ann.search(vectors, vectors.filter("vec_id = 0")).orderBy("rank").collect()]
    assert [i for i, _ in found] == [6, 5, 7, 1, 2, 3, 4]
    assert [s for _, s in found] == [0.0, pytest.approx(small), 1.0, pytest.approx(1e200), pytest.approx(1e200), math.inf, math.inf]
    found = [r.vec_id for r in ann.search(vectors, vectors.filter("vec_id = 3")).collect()]
    assert sorted(found) == [0, 1, 2, 4, 5, 6, 7]


# 4: mixing


def test_mixing(spark, docs):
    found = mixing.mix(docs).collect()
    assert {r.size for r in found if r.doc_id == 1} == {7} and {r.size for r in found if r.doc_id in (2, 3)} == {0}
    assert all(0 <= r.copies <= 2 for r in found)
    assert mixing.emitted(mixing.mix(docs)).count() == sum(r.copies for r in found)
    assert mixing.mix(none(docs)).collect() == []
    rows = [(i, "w " * (i % 50 + 1), f"s{i % 3}" if i % 7 else None) for i in range(3000)]
    big = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), salts=8)
    for r in big.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 100


# 5: urls


def test_url_parts_and_rules(spark):
    urls = [None, "", "x", "http://A.Example.org/es/1?q#f", "https://com/de/x", "ftp://b.com/fr/", "http://example.org/en/12", "h://notorg/", "h://org", "a://b?c://d/e"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' as host")
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, labels, HOST_RULES).collect()}
    empty = ("", "", None, "allow")
    assert [found[i] for i in range(10)] == [
        empty, empty, empty, ("a.example.org", "/es/1", "example.org/es/", "block"), ("com", "/de/x", "com/de/", "block"),
        ("b.com", "/fr/", "com/fr/", "allow"), ("example.org", "/en/12", "example.org/en/1", "block"), ("notorg", "/", None, "allow"),
        ("org", "", None, "allow"), ("b", "", None, "allow"),
    ]


def test_url_mining_against_brute_force(spark):
    random.seed(2)
    rows = []
    for i in range(400):
        some = random.sample(["p:a", "p:b", "p:c", "p:d", "h:x"], 3)
        rows.append((some, random.random() < (0.9 if {"p:a", "h:x"} <= set(some) else 0.2)))
    mined = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), 0.02, 10, 0.6, z=0.0)
    items = sorted({t for some, _ in rows for t in some})
    rules = {}
    for n in (1, 2, 3):
        for rule in itertools.combinations(items, n):
            hit = [bad for some, bad in rows if set(rule) <= set(some)]
            if sum(hit) >= 10 and sum(hit) / len(hit) >= 0.6:
                rules[rule] = sum(hit) / len(hit)
    kept = {r: c for r, c in rules.items() if not any(set(s) < set(r) and k >= c for s, k in rules.items())}
    assert {tuple(r.tokens): pytest.approx(r.confidence) for r in mined.collect()} == kept and kept
    urls = spark.createDataFrame([(i, some) for i, (some, _) in enumerate(rows)], "k int, tokens array<string>")
    hits = {r.k for r in url_rules.matched(urls, mined, "k").collect()}
    assert hits == {i for i, (some, _) in enumerate(rows) if any(set(r) <= set(some) for r in kept)}


def test_url_tokens_that_stand_together_are_one_item(spark):
    random.seed(3)
    common = [f"p:common{i}" for i in range(30)]
    rows = []
    for _ in range(300):
        some = common + random.sample(["h:a", "h:b", "h:c"], 1) + (["q:x", "q:y"] if random.random() < 0.3 else [])
        rows.append((some, random.random() < (0.95 if "h:a" in some and "q:x" in some else 0.25)))
    began = time.time()
    found = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()
    assert time.time() - began < 60
    assert [(r.tokens, r.members) for r in found] == [(["h:a", "q:x"], [["h:a"], ["q:x", "q:y"]])]
    urls = spark.createDataFrame([(1, ["h:a", "q:y"]), (2, ["h:a"]), (3, ["q:x", "h:a", "z"]), (4, ["q:x", "q:y"])], "k int, tokens array<string>")
    rules = spark.createDataFrame(found, "tokens array<string>, members array<array<string>>, confidence double, support double")
    assert {r.k for r in url_rules.matched(urls, rules, "k").collect()} == {1, 3}


def test_url_rules_do_not_depend_on_the_share_of_rows(spark):
    """A host with few urls, nearly all bad, gives a rule among many rows as among few."""
    for n in (200, 4000):
        rows = [(["h:spam"], i < 9) for i in range(10)] + [([f"h:{i % 50}"], i % 4 == 0) for i in range(n)]
        found = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), z=1.64).collect()
        assert [r.tokens for r in found] == [["h:spam"]]


def test_url_mining_fires_on_the_given_pages(spark):
    found = QUERIES["op5_url_filter"](spark, "/root/testdata/sf0.1")
    assert found.filter("rule is null and verdict = 'block'").count() > 0


# 6: embedding dedup


def test_graph_against_brute_force(spark, work):
    vectors = usable(table(spark, "embeddings"))
    twice = vectors.union(vectors.filter("vec_id < 20").withColumn("vec_id", F.col("vec_id") + 100_000))
    rows = {r.vec_id: np.array(r.embedding) for r in twice.collect()}
    found = {r.vec_id: r for r in graph_dedup.near_duplicates(work, twice, shard_rows=150, block_rows=100).collect()}
    ids = sorted(rows)
    unit = np.array([rows[i] / np.linalg.norm(rows[i]) for i in ids])
    near = unit @ unit.T >= 0.9
    label = graph_dedup.roots(len(ids), *np.nonzero(near))
    links = near.sum(axis=1) - 1
    got = np.array([found[i].n_links for i in ids])
    assert (got <= links).all() and got.sum() >= 0.95 * links.sum()
    same = np.mean([found[i].component_id == ids[k] for i, k in zip(ids, label)])
    assert same > 0.95 and next(iter(found.values())).recall >= 0.9


def test_graph_audit_counts_vectors_alike(spark, work):
    random.seed(5)
    axis = lambda i: [float(k == i) for k in range(12)]
    rows = [(i, 1, axis(0)) for i in range(20)] + [(100 + i, 1, axis(1 + i // 2)) for i in range(20)]
    points = spark.createDataFrame(rows, "id long, copies long, embedding array<double>")
    # All links of the group are found, none of the ten pairs.
    found = spark.createDataFrame([(i, 19) for i in range(20)], "id long, links long")
    assert graph_dedup.audited(points, found, 0.9, 200) == pytest.approx(0.5)
    with pytest.raises(RuntimeError, match="recall"):
        graph_dedup.near_duplicates(work, points.selectExpr("id as vec_id", "embedding"), target=1.5)
    assert "recall" in QUERIES["op6_embedding_dedup"](spark, SF).columns


def test_graph_odd_rows(spark, work):
    vectors = usable(odd_vectors(spark))
    found = sorted(tuple(r)[:3] for r in graph_dedup.near_duplicates(work, vectors).collect())
    assert found == [(0, 1, 0), (1, 1, 0), (7, 0, 7)]
    assert graph_dedup.near_duplicates(work, none(vectors)).collect() == []


# 7: packing


def one_by_one(lengths, window):
    """Best-fit decreasing over single pieces: how full the windows are."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [c for c in left if c >= n]
        if fits:
            left.remove(min(fits))
            left.append(min(fits) - n)
        else:
            left.append(window - n)
    return sorted(left)


@pytest.mark.parametrize("seed", range(5))
def test_best_fit(seed):
    random.seed(seed)
    counts = Counter(random.choices(range(1, 64), k=300))
    used, placed = defaultdict(int), defaultdict(set)
    for length, start, stop, first, per, offset, end in packing.best_fit(counts, 64):
        for k in range(start, stop):
            sequence, at = first + (k - start) // per, offset + (k - start) % per * length
            assert not placed[sequence] & set(range(at, at + length)) and at + length <= end
            placed[sequence] |= set(range(at, at + length))
            used[sequence] = end
    assert all(placed[s] == set(range(used[s])) for s in placed)
    assert sorted(64 - u for u in used.values()) == one_by_one(counts.elements(), 64)


def test_packing_round_trip(work, docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer())
    rows = packing.pack(work, docs, tokenizer()).collect()
    texts = {d: whole.encode(t or "", add_special_tokens=False).ids + [0] for d, t in {(r.doc_id, r.text) for r in docs.collect()}}
    pieces = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == texts[r.doc_id][r.start : r.start + r.length] and len(texts[r.doc_id]) == r.doc_tokens
        pieces[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(len(i) for i in texts.values()) + len(texts[1])
    for some in pieces.values():
        ends = list(itertools.accumulate(n for _, n in sorted(some)))
        assert [o for o, _ in sorted(some)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert packing.pack(work, none(docs), tokenizer()).collect() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_gives_the_ids_of_tokenizers(spark, name):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    whole, own = Tokenizer.from_file(path), packing.Encoder(path)
    assert (packing.merge_ranks(json.load(open(path))) is not None) == name.startswith("byte")
    texts = ["a  b", " a", "a ", "don't  we'll\n\n x\t y", "é ü\u3000z  \u00a0 q", "1 22 333 !? a1 b", "<|endoftext|> x", "", "\x1c a \x85b c"]
    texts += [c * 100_000 for c in (" ", "\n", "a", "é", "^", "7")] + ["".join(map(chr, range(1, 0xD800)))]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text]
    assert [i.tolist() for i in own.encode(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("blank", [" ", "\n"])
def test_very_long_white_space(spark, work, blank):
    from tokenizers import Tokenizer

    whole, run = Tokenizer.from_file(tokenizer()), blank * 2_000_000
    texts = {1: f"{run}led", 2: f"in{run}side", 3: f"trail{run}", 4: run, 5: "plain"}
    packed = packing.pack(work, spark.createDataFrame(list(texts.items()), "doc_id long, text string"), tokenizer()).collect()
    for doc, text in texts.items():
        own = [np.frombuffer(r.ids, "<u4") for r in sorted((r for r in packed if r.doc_id == doc), key=lambda r: r.start)]
        assert np.concatenate(own).tolist() == whole.encode(text, add_special_tokens=False).ids + [0]


# 8: line dedup


@pytest.mark.parametrize("batches", [1, 7])
def test_lines(spark, work, docs, batches):
    line = "This very common line is longer than forty code points."
    rows = [(i, f"own {i}\n  {line.upper() if i % 2 else line}\t\nshort", "x") for i in range(8)]
    rows += [(100 + i, "rare line that is still longer than forty code points", "x") for i in range(4)] + [(200, None, "x"), (201, "", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    found = {r.doc_id: r for r in line_dedup.dedup_lines(work, frame, batches=batches, fanout=2).collect()}
    for i in range(8):
        lost = i != 7
        assert (found[i].n_lines, found[i].n_dropped) == (3, int(lost))
        assert found[i].text == (f"own {i}\nshort" if lost else rows[i][1])
    assert found[100].n_dropped == 0 and found[200].text is None and (found[201].text, found[201].n_lines) == ("", 1)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run")]
    assert line_dedup.dedup_lines(work, docs).count() == 6 and line_dedup.dedup_lines(work, none(docs)).collect() == []


def test_line_batches_follow_the_corpus():
    assert [line_dedup.batch_count(n, 3) for n in (0, 10**5, 2**20, 2**24, 2**30)] == [7, 7, 8, 11, 17]


def test_line_lookups_move_no_run(spark, work):
    """A batch meets merged runs, leaves out what they have settled, and is shuffled alone."""
    runs = line_dedup.Runs(work, fanout=2, enough=3)
    for top in range(50, 0, -10):
        ids = spark.range(top - 9, top + 1).withColumnRenamed("id", "doc_id")
        often, own = F.lit("often"), F.col("doc_id").cast("string")
        rare = F.concat(F.lit("twice"), F.col("doc_id") % 25)
        lines = ids.select(F.explode(F.array(often, own, rare)).alias("h"), "doc_id").withColumn("h", F.col("h").cast("binary"))
        runs.add(lines.union(lines))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    last = spark.table(runs.all()[0])
    assert last.count() == 20 and last.filter("h = cast('often' as binary)").isEmpty()
    assert [tuple(r) for r in runs.frequent().collect()] == [(b"often", 50)]
    settled = spark.table(runs.all()[1]).filter("n_docs >= 3").select("h").hint("merge")
    with line_dedup.sorted_buckets(spark):
        plan = last.join(settled, "h", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort " not in plan
    runs.drop()


def test_lines_of_null_and_repeated_ids(spark, work):
    """What rows of one id lose is gathered by text, not by id."""
    line = [f"Line {n} of them, common to all and longer than forty code points." for n in range(4)]
    rows = [(i, "\n".join(line)) for i in range(6)] + [(None, f"{line[n % 4]}\nown {n}") for n in range(200)] + [(3, line[1]), (5, line[2])]
    found = line_dedup.dedup_lines(work, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    assert {r.text for r in found if r.doc_id is None} == {f"own {n}" for n in range(200)}
    assert {r.text for r in found if r.doc_id == 5} == {"\n".join(line), line[2]} and {r.text for r in found if r.doc_id == 3} == {""}


# 9: MinHash


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("block_rows", [512, 7])
def test_minhash_against_brute_force(spark, work, block_rows):
    random.seed(8)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):  # variants of one text that link with few others each
        words = list(base)
        for at in random.sample(range(150), random.randint(0, 4)):
            words[at] = f"x{random.randint(0, 3)}"
        rows.append((i, " ".join(words)))
    rows += [(500, None), (501, ""), (502, "a b"), (503, "A B"), (504, "a c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in minhash.near_duplicates(work, frame, block_rows=block_rows).collect()}
    sets = {i: shingle_set(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    part = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            part[a] = part[b] = min(part[a], part[b])
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in found.items()} == {i: (len(s), part[i], part[i] == i) for i, s in sets.items()}


def test_minhash_odd_rows(work, docs):
    found = [(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(work, docs).collect()]
    assert sorted(found, key=str) == sorted([(1, 1, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (None, None, True)], key=str)
    assert minhash.near_duplicates(work, none(docs)).collect() == []


def test_minhash_rows_of_one_id_are_one_document(spark, work):
    words = [f"w{i}" for i in range(120)]
    near = " ".join([*words[:60], "x", *words[61:]])
    other, third = " ".join(f"v{i}" for i in range(90)), " ".join(f"u{i}" for i in range(90))
    rows = [(7, " ".join(words)), (5, other), (5, near), (5, third), (2, third), (9, other), (None, other), (11, "alone here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for most in (100, 0):
        found = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(work, frame, broadcast_ids=most).collect()}
        assert found == {(7, 2, False), (5, 2, False), (2, 2, True), (9, 2, False), (None, None, True), (11, 11, True)}


def test_pipeline_keeps_one_row_of_each_document(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text), (1, text), (1, text + " more"), (2, text), (3, "other text"), (3, "other text"), (None, "no id"), (None, "no id"), (None, text)]
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in rows], FULL)
    left = corpus_pipeline.drop_near_copies(spark, docs, SF).collect()
    assert sorted(((r.doc_id, r.text if r.doc_id != 1 else "") for r in left), key=str) == sorted([(1, ""), (3, "other text"), (None, "no id"), (None, text)], key=str)


# 10: language


def test_language_held_out(spark):
    docs = table(spark, "documents").withColumn("held", fold(F.col("doc_id"), 5) == 0)
    found = langid.predict(docs, langid.fit(docs.filter("not held"))).filter("held").collect()
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.95


def test_language_code_lengths():
    """The tables give what walking the trees byte by byte gives."""
    samples = {"a": Counter({b"the": 5, b"then": 2, b"cat": 1}), "b": Counter({b"der": 4, b"den": 3})}
    model = langid.train(samples)
    words = [b"the", b"thy", b"den", b"zz", b"x" * 100]
    for lang, got in zip(model.languages, model.code_lengths(words).T):
        tree = langid.context_tree(samples[lang])
        for word, bits in zip(words, got):
            line, want = b" " + word + b" ", 0.0
            for at in range(1, len(line)):
                for order in range(min(langid.ORDER, at), -2, -1):
                    if order < 0:
                        want += 8
                        break
                    seen = tree.get(line[at - order : at])
                    if not seen:
                        continue
                    whole = sum(seen.values()) + len(seen)
                    if line[at] in seen:
                        want += math.log2(whole / seen[line[at]])
                        break
                    want += math.log2(whole / len(seen))
            assert bits == pytest.approx(want)


def test_language_odd_rows(docs):
    found = langid.predict(docs, langid.fit(docs)).collect()
    assert sorted(r.lang_pred for r in found if r.doc_id in (2, 3)) == ["und", "und"] and len(found) == 6
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(none(docs))).collect()} == {"und"}
    assert langid.predict(none(docs), langid.fit(docs)).collect() == []


def test_language_of_long_words(monkeypatch):
    """A word of any length is coded piece by piece: same bits, bounded memory."""
    model = langid.train({f"l{n}": Counter({bytes([97 + n, 98, 99 + n] * 4): 5, b"common": n + 1}) for n in range(8)})
    rng = random.Random(5)
    some = [bytes(rng.choices(b"abcdefghijk", k=n)) for n in (1, 2, 3, 4, 5, 6, 60, 1000)]
    whole = model.code_lengths(some)
    cut = langid.parts
    for size in (1, 3, 7):
        monkeypatch.setattr(langid, "parts", lambda line, size=size: cut(line, size))
        assert np.allclose(model.code_lengths(some), whole, rtol=1e-12)
    monkeypatch.setattr(langid, "parts", cut)
    monkeypatch.setattr(langid, "CHUNK", 50)
    assert np.allclose(model.code_lengths(some), whole, rtol=1e-12)
    monkeypatch.undo()
    tracemalloc.start()
    model.code_lengths([b"abcde" * 1_000_000])
    assert tracemalloc.get_traced_memory()[1] < 120e6
    tracemalloc.stop()


def test_language_sample(spark):
    """Long texts alone still teach a language; rows of one id count once."""
    rows = [(i, "the cat sat on the mat " * 3, "en") for i in range(5)] + [(9, "der hund lief schnell ins haus " * 2000, "de")]
    rows += [(3, "zzz qqq xxx", "en")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.languages == ["de", "en"]
    ask = spark.createDataFrame([(1, "hund und haus"), (2, "cat on mat")], "doc_id long, text string")
    assert [r.lang_pred for r in langid.predict(ask, model).orderBy("doc_id").collect()] == ["de", "en"]
    size = docs.filter("lang = 'de'").select(F.length(langid.excerpt(F.col("text"), 20_000))).first()[0]
    assert 19_000 < size <= 20_010


# the pipeline


def test_pipeline_stages(spark, work):
    docs = table(spark, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = work.keep(stage(spark, docs, SF), name)
        assert after.columns == docs.columns
        if name == "toxicity":
            lost = docs.join(after, "doc_id", "left_anti").join(table(spark, "labels"), "doc_id")
            assert lost.filter("toxic = 0").count() <= 0.1 * docs.count()
        if name == "line_dedup":
            keys = Counter(k for r in docs.collect() for k in set(line_dedup.keys(r.text, 40)) if k)
            left = Counter(k for r in after.collect() for k in set(line_dedup.keys(r.text, 40)) if k)
            assert after.count() == docs.count() and all(left[k] == 1 for k, n in keys.items() if n >= 5)
        if name == "minhash_dedup":
            sets = [s for s in (shingle_set(r.text) for r in after.collect()) if s]
            assert not any(100 * len(a & b) >= 80 * len(a | b) for a, b in itertools.combinations(sets, 2))
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.agg(F.sum("length")).first()[0] == packed.filter("start = 0").agg(F.sum("doc_tokens")).first()[0]
    assert packed.filter("start = 0").count() == docs.count()


def test_pipeline_drops_pairs_from_eighty_percent(spark):
    random.seed(6)
    rows, pairs = [], {}
    for i in range(0, 400, 2):  # pairs of texts with one to four words replaced apart from each other
        words = [f"w{i}x{j}" for j in range(random.randint(60, 200))]
        other = list(words)
        for k in range(random.randint(1, 4)):
            other[5 + 10 * k] = f"y{i}x{k}"
        a, b = shingle_set(" ".join(words)), shingle_set(" ".join(other))
        rows += [(i, " ".join(words)), (i + 1, " ".join(other))]
        pairs[i + 1] = len(a & b) / len(a | b)
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in rows], FULL)
    found = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()}
    assert found == {i for i in range(0, 400, 2)} | {i for i, s in pairs.items() if s < 0.8}
    assert any(0.8 <= s < 0.85 for s in pairs.values()) and any(s < 0.8 for s in pairs.values())


def test_url_mining_keeps_all_items_of_a_row(spark):
    """A rule of the least telling items among rows of a dozen."""
    random.seed(5)
    rows = []
    for i in range(600):
        pair, bad = [(["p:a", "p:b"], True), (["p:a"], False), (["p:b"], False), ([], True)][random.choices(range(4), [10, 25, 25, 40])[0]]
        rows.append((random.sample([f"q:{n}" for n in range(100)], 10) + pair, bad))
    mined = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), 0.05, 10, 0.6).collect()
    both = sum({"p:a", "p:b"} <= set(some) for some, _ in rows)
    assert [(r.confidence, r.support) for r in mined if r.tokens == ["p:a", "p:b"]] == [(1.0, pytest.approx(both / 600))]


def test_lm_shares_come_from_all_training_tokens(spark, work):
    """A word's followers say much in most texts, too few of which a sample of short texts would hold."""
    random.seed(6)
    long = " ".join(random.choice(["new york", "red sea", "old"]) for _ in range(6000))  # beyond what was once the longest text sampled
    rows = [(i, long) for i in range(4)] + [(i, f"york{i} sea{i}") for i in range(10, 25)] + [(100, "red sea new york " * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in lm_scoring.score(work, docs, F.col("doc_id") < 100, chunk_tokens=5000).collect()}
    assert found[100].score > found[100].base_score * 0.6


def test_lm_leaves_out_the_own_row():
    counts, row, of = np.array([5, 2, 1]), np.array([0, 0, 0, 1, 1]), np.array([0, 0, 1, 1, 2])
    assert lm_scoring.left_out(counts, row, of, 2).tolist() == lm_scoring.levels(np.array([3, 3, 1, 1, 1]), 2).tolist()[:4] + [0]
