"""Source divergence audit: term statistics by fixed-width digests, texts joined back only for what is reported."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import Work, slices

#: Letters in lower case and bytes beyond ASCII (as in UTF-8) stay; every other byte parts terms.
LETTERS = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))
#: Tokens a task gathers before it sends their sums, but for the end of one text.
HELD = 2**21
#: Terms of a block and groups of a tile: what one task compares at a time.
BLOCK_TERMS, TILE_GROUPS = 4096, 512
#: Kept terms that may be broadcast (some 100 MB on an executor); beyond, they are joined by a shuffle.
BROADCAST_TERMS = 2_000_000

SUMS_DDL = "grp bigint, digest bigint, n bigint, docs bigint"


def digests(some: list[bytes], bits: int) -> np.ndarray:
    """The lowest ``bits`` bits of a 64-bit hash of each term."""
    mask = np.uint64(2**bits - 1)
    return (np.fromiter(map(xxhash.xxh3_64_intdigest, some), np.uint64, len(some)) & mask).view(np.int64)


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it at a time."""
    for piece in slices((text or "").encode()):
        yield piece.translate(LETTERS).split()


def term_sums(docs: DataFrame, bits: int) -> DataFrame:
    """``(grp, digest, n, docs)``: occurrences and documents of each digest, summed up within a task; no text.

    A term's documents are those of all terms with its digest together, so a document may count more than once there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        rows: list[tuple[int, int]] = []  # grp and tokens of each row held

        def batch_of() -> pa.RecordBatch:
            digest = np.concatenate(parts)
            sizes = [n for _, n in rows]
            keys, grp = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)
            grp, row = np.repeat(grp, sizes), np.repeat(np.arange(len(rows)), sizes)
            order = np.argsort(digest, kind="stable")
            if len(keys) < 2**16:
                order = order[np.argsort(grp.astype(np.uint16)[order], kind="stable")]
            else:
                order = order[np.argsort(grp[order], kind="stable")]
            digest, grp, row = digest[order], grp[order], row[order]
            new = np.ones(len(order), bool)
            new[1:] = (digest[1:] != digest[:-1]) | (grp[1:] != grp[:-1])
            fresh = new.copy()
            fresh[1:] |= row[1:] != row[:-1]
            first = np.flatnonzero(new)
            in_docs = np.add.reduceat(fresh, first, dtype=np.int64)
            arrays = [keys[grp[first]], digest[first], np.diff(np.append(first, len(new))), in_docs]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in arrays], names=["grp", "digest", "n", "docs"])

        held = 0
        for batch in batches:
            for grp, text in zip(batch["grp"].to_pylist(), batch["text"]):
                own = [digests(some, bits) for some in terms(text.as_py())]
                parts += own
                rows.append((grp, sum(map(len, own))))
                held += rows[-1][1]
                if held >= HELD:
                    yield batch_of()
                    parts.clear()
                    rows.clear()
                    held = 0
        if held:
            yield batch_of()

    return docs.select("grp", "text").mapInArrow(run, SUMS_DDL)


def term_texts(docs: DataFrame, bits: int) -> DataFrame:
    """``(lang, digest, term)``, each once per task (or a few times, in a large one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, set[bytes]] = defaultdict(set)

        def batch_of() -> pa.RecordBatch:
            found = [(lang, list(some)) for lang, some in seen.items()]
            lang = np.repeat(np.array([k for k, _ in found], np.int64), [len(some) for _, some in found])
            digest = np.concatenate([digests(some, bits) for _, some in found])
            term = pa.array([t.decode() for _, some in found for t in some], pa.string())
            return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(digest), term], names=["lang", "digest", "term"])

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                for some in terms(text.as_py()):
                    seen[lang].update(some)
            if sum(map(len, seen.values())) > HELD // 8:
                yield batch_of()
                seen.clear()
        if seen:
            yield batch_of()

    return docs.select("lang", "text").mapInArrow(run, "lang bigint, digest bigint, term string")


def split_sums(docs: DataFrame, bits: int) -> DataFrame:
    """``(lang, grp, digest, term, n)``: a row per document and term, for the few digests that several terms share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for lang, grp, text in zip(batch["lang"].to_pylist(), batch["grp"].to_pylist(), batch["text"]):
                counts = Counter(chain.from_iterable(terms(text.as_py())))
                rows += [(lang, grp, d, t.decode(), n) for d, (t, n) in zip(digests(list(counts), bits).tolist(), counts.items())]
            schema = pa.schema([("lang", pa.int64()), ("grp", pa.int64()), ("digest", pa.int64()), ("term", pa.string()), ("n", pa.int64())])
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return docs.select("lang", "grp", "text").mapInArrow(run, "lang bigint, grp bigint, digest bigint, term string, n bigint")


def coded(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with numbers for languages and groups, and ``(lang, grp, lang_name, source)``. Numbers are hashes under the first seed without a collision."""
    named = docs.select(F.coalesce("lang", F.lit("")).alias("lang_name"), F.coalesce("source", F.lit("")).alias("source"), "text")
    names = named.select("lang_name", "source").distinct()
    for seed in range(64):
        lang, grp = F.xxhash64(F.lit(seed), "lang_name"), F.xxhash64(F.lit(seed), "lang_name", "source")
        counts = [F.count_distinct(c) for c in (lang, F.col("lang_name"), grp)]
        langs, lang_names, groups, all_groups = names.agg(*counts, F.count("*")).first()
        if (langs, groups) == (lang_names, all_groups):
            return named.select(lang.alias("lang"), grp.alias("grp"), "text"), names.select(lang.alias("lang"), grp.alias("grp"), "lang_name", "source")
    raise RuntimeError("groups collide under every seed")


def kept_terms(work: Work, docs: DataFrame, groups: DataFrame, min_docs: int, bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(lang, grp, digest, part, n)`` of kept terms, ``(lang, digest, part, n, term)`` of languages' kept terms with their text.

    ``part`` is empty, or the term itself where several terms share a digest. Two terms can only add to each other's
    count, so a kept term's digest is among those that reach ``min_docs``: only these get a text. Their smallest and
    largest text differ exactly if a digest stands for several terms; such digests are counted anew by text.
    """
    sums = term_sums(docs, bits).groupBy("grp", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = work.keep(sums.join(groups.select("lang", "grp"), "grp").select("lang", "grp", "digest", "n", "docs"), "sums")
    often = counts.groupBy("lang", "digest").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).filter(F.col("docs") >= min_docs)
    often = work.keep(often.select("lang", "digest", "n"), "often")
    small = often.count() <= BROADCAST_TERMS
    known = F.broadcast(often) if small else often
    found = term_texts(docs, bits).join(known, ["lang", "digest"], "left_semi").groupBy("lang", "digest")
    texts = work.keep(found.agg(F.min("term").alias("low"), F.max("term").alias("high")), "texts")
    whole = texts.filter("low = high").select("lang", "digest", F.lit("").alias("part"), F.col("low").alias("term"))
    by_group = counts.join(whole.select("lang", "digest", "part"), ["lang", "digest"]).select("lang", "grp", "digest", "part", "n")
    by_lang = whole.join(often, ["lang", "digest"]).select("lang", "digest", "part", "n", "term")
    shared = texts.filter("low <> high").select("lang", "digest")
    if not shared.isEmpty():
        apart = split_sums(docs, bits).join(shared, ["lang", "digest"], "left_semi")
        apart = apart.groupBy("lang", "grp", "digest", "term").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))
        apart = work.keep(apart.withColumnRenamed("term", "part"), "apart")
        own = apart.groupBy("lang", "digest", "part").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
        own = work.keep(own.select("lang", "digest", "part", "n", F.col("part").alias("term")), "own")
        more = apart.join(own.select("lang", "digest", "part"), ["lang", "digest", "part"]).select("lang", "grp", "digest", "part", "n")
        by_group, by_lang = by_group.unionByName(more), by_lang.unionByName(own)
    return work.keep(by_group, "by-group"), work.keep(by_lang, "by-lang")


def probability(n: Column | int, total: str, terms: str) -> Column:
    """``1 + floor(10^9 * (n + 2) / (total + 2 * terms))``, exactly; null without terms."""
    n = (F.lit(n) if isinstance(n, int) else n).cast("decimal(20,0)").alias("n")
    above = F.lit(1_000_000_000).cast("decimal(10,0)") * (n + F.lit(2))
    below = F.nullif(F.col(total).cast("decimal(20,0)") + F.col(terms).cast("decimal(20,0)") * F.lit(2), F.lit(0).cast("decimal(20,0)"))
    return F.call_function("div", above, below) + F.lit(1)


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def pair_sums(counts: DataFrame, groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(grp, other, value)``: the gaps of all kept terms summed up, for every two groups of a language.

    A task gets a block of a language's terms and two tiles of its groups, as probabilities, and returns a sum per
    pair of groups: neither the terms of a pair nor the pairs of a term are ever rows. ``counts (lang, grp, digest,
    part, p)`` holds what occurs; ``groups (lang, grp, p0, terms)`` what a term without occurrence gets.
    """
    per_lang = groups.groupBy("lang").agg(F.count("*").alias("groups"), F.max("terms").alias("terms"))
    per_lang = per_lang.select(
        "lang",
        F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK_TERMS)).alias("blocks"),
        F.ceil(F.col("groups") / TILE_GROUPS).alias("tiles"),
    )
    tile = F.pmod(F.xxhash64("grp"), F.col("tiles")).alias("tile")
    block = F.pmod(F.xxhash64("digest", "part"), F.col("blocks")).alias("block")
    placed = sizes.join(per_lang, "lang").select("lang", block).groupBy("lang", "block").agg(F.count("*").alias("terms"))
    marks = groups.join(per_lang, "lang").select("lang", "grp", tile, "tiles", F.col("p0").alias("p"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    marks = marks.join(placed, ["lang", "block"], "left")
    zero = F.lit(0).cast("bigint")
    p, terms = F.coalesce("p", zero).alias("p"), F.coalesce("terms", zero).alias("terms")
    marks = marks.select("lang", "block", "tile", "tiles", "grp", p, terms, zero.alias("digest"), F.lit("").alias("part"), F.lit(True).alias("mark"))
    rows = counts.join(per_lang, "lang")
    rows = rows.select("lang", block, tile, "tiles", "grp", "p", zero.alias("terms"), "digest", "part", F.lit(False).alias("mark"))
    both = marks.union(rows).withColumn("beside", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    both = both.withColumns({"a": F.least("tile", "beside"), "b": F.greatest("tile", "beside")})

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        marks, rows = rows[rows["mark"]], rows[~rows["mark"]]
        place = pd.Index(marks["grp"])
        same = marks["a"].iat[0] == marks["b"].iat[0]
        total = int(marks["terms"].iat[0])
        if total:
            base = marks["p"].to_numpy(np.int64)
            term = rows.groupby(["digest", "part"]).ngroup().to_numpy()
            seen = term.max() + 1 if len(term) else 0
            p = np.vstack([np.tile(base, (seen, 1)), base])
            p[term, place.get_indexer(rows["grp"])] = rows["p"].to_numpy(np.int64)
            weight = np.append(np.ones(seen, np.int64), total - seen)
        tiles, groups = marks["tile"].to_numpy(), marks["grp"].to_numpy()
        found = []
        for i in range(len(groups)):
            other = (np.arange(len(groups)) != i) if same else tiles != tiles[i]
            value = np.zeros(other.sum(), np.int64)
            if total:
                left, right = p[:, i : i + 1], p[:, other]
                value = ((left - right) ** 2 // (left + right) * weight[:, None]).sum(axis=0)
            found.append(pd.DataFrame({"grp": groups[i], "other": groups[other], "value": value}))
        return pd.concat(found)

    sums = both.groupBy("lang", "block", "a", "b").applyInPandas(run, "grp bigint, other bigint, value bigint")
    return sums.groupBy("grp", "other").agg(F.sum("value").alias("value"))


def audit(work: Work, docs: DataFrame, min_docs: int = 10, top: int = 10, bits: int = 64) -> DataFrame:
    """How the sources of each language differ: ``lang, source, part, item, value, rank``.

    A language keeps the terms that at least ``min_docs`` of its documents hold. A group is a source of a language. Each
    group, and each language, gives a kept term p = 1 + floor(10^9 * (count + 2) / (N + 2 * V)); two of them lie
    floor((p - q)^2 / (p + q)) apart in a term. Part ``pair`` ranks a group's language's other sources by that summed over
    all kept terms; part ``term`` ranks the terms a group has more often than its language, the first ``top``. Higher
    values come first, then smaller texts by bytes. All arithmetic is exact.

    Only digests of ``bits`` bits and counts are shuffled until terms are kept; texts then come back by digest, the
    smallest and the largest of each. Digests of several terms are counted anew by text, so results do not depend on ``bits``.

    Null and empty texts have no terms; their groups occur. Null languages and sources are the empty ones. Each row is a
    document, repeated ids or not; other columns are ignored. A language without kept terms has pairs of value 0 and no
    terms. An empty table gives no rows.
    """
    docs, groups = coded(docs)
    groups = work.keep(groups, "groups")
    by_group, by_lang = kept_terms(work, docs, groups, min_docs, bits)
    langs = by_lang.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    totals = by_group.groupBy("grp").agg(F.sum("n").alias("total"))
    sized = groups.select("lang", "grp").join(langs, "lang", "left").join(totals, "grp", "left").na.fill(0, ["terms", "lang_total", "total"])
    sized = work.keep(sized.withColumn("p0", probability(0, "total", "terms")), "sized")

    counts = by_group.join(sized.select("grp", "total", "terms", "lang_total"), "grp")
    counts = counts.withColumn("p", probability(F.col("n"), "total", "terms"))
    pairs = pair_sums(counts.select("lang", "grp", "digest", "part", "p"), sized.select("lang", "grp", "p0", "terms"), by_lang.select("lang", "digest", "part"))
    names = groups.select(F.col("grp").alias("other"), F.col("source").alias("item"))
    pairs = pairs.join(names, "other").select("grp", F.lit("pair").alias("part"), "item", "value")

    all_of_lang = by_lang.select("lang", "digest", "part", F.col("n").alias("lang_n"))
    higher = counts.join(all_of_lang, ["lang", "digest", "part"]).withColumn("q", probability(F.col("lang_n"), "lang_total", "terms"))
    higher = higher.filter("p > q").select("lang", "grp", "digest", "part", gap(F.col("p"), F.col("q")).alias("value"))
    first = higher.withColumn("place", F.rank().over(Window.partitionBy("grp").orderBy(F.desc("value")))).filter(F.col("place") <= top)
    named = first.join(by_lang.select("lang", "digest", "part", "term"), ["lang", "digest", "part"])
    named = named.select("grp", F.lit("term").alias("part"), F.col("term").alias("item"), "value")

    in_order = Window.partitionBy("grp", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.union(named).withColumn("rank", F.row_number().over(in_order)).filter((F.col("part") == "pair") | (F.col("rank") <= top))
    found = ranked.join(groups.select("grp", F.col("lang_name").alias("lang"), "source"), "grp")
    return found.select("lang", "source", "part", "item", "value", "rank")
