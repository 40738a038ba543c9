"""URL filters: association rules mined by FP-growth, and curated host rules (built-in functions and MLlib only)."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import Work

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def tokens(url: Column) -> Column:
    """Distinct tokens of a url, marked by where they stand: scheme, host labels, path words, query and fragment words.

    Digits become ``0``, so that page numbers do not make every url a combination of its own.
    """
    low = F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER)

    def words(text: Column, mark: str) -> Column:
        parts = F.split(F.regexp_replace(text, "[0-9]+", "0"), r"[^\p{L}0-9-]+")
        return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.concat(F.lit(mark), w))

    scheme = F.when(F.instr(low, "://") > 0, F.substring_index(low, "://", 1)).otherwise(F.lit(""))
    tail = F.regexp_extract(_rest(low), r"^[^?#]*(.*)$", 1)
    return F.array_distinct(
        F.concat(words(scheme, "s:"), words(host(low), "h:"), words(path(low), "p:"), words(tail, "q:"))
    )


def token_classes(sets: DataFrame) -> DataFrame:
    """``(token, item)``: tokens that stand in the same token sets, and no others, are one item, named after the smallest."""
    marks = [F.sum(F.xxhash64(F.lit(seed), "tokens").cast("decimal(20,0)")).alias(f"mark_{seed}") for seed in (1, 2)]
    seen = sets.select("tokens", F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("sets"), *marks)
    same = ["sets", "mark_1", "mark_2"]
    return seen.join(seen.groupBy(*same).agg(F.min("token").alias("item")), same).select("token", "item")


def trusted(confidence: Column, rows: Column, base: float, z: float) -> Column:
    """Whether the lower end of Wilson's interval of a share among ``rows`` lies above ``base``."""
    spread = F.sqrt(confidence * (F.lit(1.0) - confidence) / rows + F.lit(z * z / 4) / (rows * rows))
    return (confidence + F.lit(z * z / 2) / rows - F.lit(z) * spread) / (F.lit(1.0) + F.lit(z * z) / rows) > F.lit(base)


def mine(
    labelled: DataFrame,
    min_support: float = 0.0005,
    min_rows: int = 3,
    min_confidence: float = 0.6,
    z: float = 1.64,
    work: Work | None = None,
) -> DataFrame:
    """Rules ``(tokens, members, confidence, support)`` from ``(tokens, bad)``: token combinations whose urls are mostly bad.

    Tokens that always stand together are one item: ``tokens`` names the items, ``members`` lists the tokens of each, any of
    which stands for it. A rule needs ``min_confidence``, ``min_rows`` bad rows, and more bad rows than chance gives: the
    lower end of its confidence's interval (``z`` standard errors) lies above the share of bad rows. Rules of one item are
    counted directly, whatever their share of the rows. Rules of more are mined among item sets that ``min_support`` of all
    labelled rows and ``min_rows`` of them have as bad rows: FP-growth finds these among the bad rows, each with all its items, and
    their other rows are counted over the distinct token sets. The bound on support is the method's: it keeps FP-growth's list of items, which it holds
    on the driver, in proportion to the labels. No row's items are cut, so urls that share many items which do not always stand
    together cost as many combinations as are that frequent. A rule is pruned when a subset of its items
    has the same or a higher confidence, since the shorter rule then fires wherever it does. No labelled row: no rule.
    With ``work`` each step's result is a table there, which the next ones read; without, plans are run whole.
    """
    spark = labelled.sparkSession
    keep = work.keep if work else lambda df, label: df
    labelled = keep(labelled, "labelled")
    schema = "tokens array<string>, members array<array<string>>, confidence double, support double"
    rows, bad = labelled.agg(F.count("*"), F.count_if("bad")).first()
    if not rows:
        return spark.createDataFrame([], schema)
    base, least = bad / rows, max(min_rows, min_support * rows)
    marked = labelled.select(F.array_sort("tokens").alias("tokens"), "bad")
    sets = marked.groupBy("tokens").agg(F.count("*").alias("n"), F.count_if("bad").alias("hits"))
    sets = keep(sets, "sets")
    classes = keep(token_classes(sets), "classes")
    held = sets.withColumn("token", F.explode("tokens")).join(classes, "token").select("tokens", "n", "hits", "item").distinct()
    held = keep(held, "held")
    items = held.groupBy("item").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).withColumn("confidence", F.col("hits") / F.col("n"))
    items = keep(items, "items")
    enough = (F.col("hits") >= min_rows) & (F.col("confidence") >= min_confidence) & trusted(F.col("confidence"), F.col("n"), base, z)
    single = items.filter(enough).select(F.array("item").alias("tokens"), "confidence", (F.col("hits") / F.lit(rows)).alias("support"))

    # An item that all rows have adds nothing to a rule.
    often = items.filter((F.col("hits") >= least) & (F.col("n") < rows)).select("item", F.col("n").alias("item_n"))
    listed = held.join(often, "item").groupBy("tokens").agg(F.first("n").alias("n"), F.first("hits").alias("hits"), F.sort_array(F.collect_list("item")).alias("items"))
    listed = keep(listed, "listed")
    baskets = listed.filter("hits > 0").select("items", F.explode(F.sequence(F.lit(1), F.col("hits").cast("int"))).alias("copy")).select("items")
    in_baskets, need = listed.agg(F.sum("hits")).first()[0] or 0, math.ceil(least)
    found = single
    if in_baskets >= need:
        # Half a row less, so that no rounding of the share asks for one more.
        model = FPGrowth(itemsCol="items", minSupport=(need - 0.5) / in_baskets).fit(baskets)
        several = model.freqItemsets.filter(F.size("items") > 1).select(F.array_sort("items").alias("tokens"), F.col("freq").alias("hits"))
        several = keep(several, "several")
        rarest = several.withColumn("item", F.explode("tokens")).join(often, "item").groupBy("tokens", "hits")
        rarest = rarest.agg(F.min_by("item", F.struct("item_n", "item")).alias("item"))
        met = listed.select("n", "items", F.explode("items").alias("item")).join(rarest, "item")
        counted = met.filter(F.size(F.array_except("tokens", "items")) == 0).groupBy("tokens", "hits").agg(F.sum("n").alias("n"))
        counted = counted.withColumn("confidence", F.col("hits") / F.col("n"))
        counted = counted.filter((F.col("confidence") >= min_confidence) & trusted(F.col("confidence"), F.col("n"), base, z))
        found = single.union(counted.select("tokens", "confidence", (F.col("hits") / F.lit(rows)).alias("support")))
    found = keep(found, "found")
    # A shorter rule is a subset of a longer one only if it holds one of its tokens: match on the shorter rule's first.
    short = found.select(F.col("tokens").alias("sub"), F.col("confidence").alias("sub_confidence"), F.col("tokens")[0].alias("token"))
    long = found.withColumn("token", F.explode("tokens"))
    covered = long.join(short, "token").filter(
        (F.size("sub") < F.size("tokens")) & (F.size(F.array_except("sub", "tokens")) == 0) & (F.col("sub_confidence") >= F.col("confidence"))
    )
    kept = found.join(covered.select("tokens").distinct(), "tokens", "left_anti")
    members = classes.groupBy("item").agg(F.array_sort(F.collect_list("token")).alias("own"))
    listed = kept.select("*", F.posexplode("tokens").alias("place", "item")).join(members, "item")
    listed = listed.groupBy("tokens", "confidence", "support").agg(F.array_sort(F.collect_list(F.struct("place", "own"))).alias("listed"))
    return keep(listed.select("tokens", F.col("listed.own").alias("members"), "confidence", "support"), "rules")


def matched(urls: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """Keys of ``urls (key, tokens)`` on which a rule fires, with the highest confidence, through an inverted index.

    A rule fires if the url has a token of each of its items. The index lists a rule under the tokens of its rarest item (by
    the rules' own counts), so a url meets only rules that share one; its other items are then looked for in the url's tokens.
    """
    often = rules.select(F.explode("tokens").alias("item")).groupBy("item").agg(F.count("*").alias("uses"))
    listed = rules.withColumn("id", F.xxhash64("tokens")).select("*", F.posexplode("tokens").alias("place", "item")).join(often, "item")
    index = listed.groupBy("id").agg(
        F.min_by("place", F.struct("uses", "item")).alias("place"),
        F.first("members").alias("members"),
        F.first("confidence").alias("confidence"),
    )
    index = index.select("members", "confidence", F.explode(F.element_at("members", F.col("place") + 1)).alias("token"))
    met = urls.withColumn("token", F.explode("tokens")).join(index, "token")
    fires = met.filter(F.forall("members", lambda own: F.arrays_overlap(own, F.col("tokens"))))
    return fires.groupBy(key).agg(F.max("confidence").alias("confidence"))


def host_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest of ``(verdict, host, path)`` rules that fits, as ``(rule, verdict)``; nulls if none does.

    A rule fits its host and all subdomains, if the path starts with the rule's path. Ties go to the smaller text.
    """
    rule = verdict = F.lit(None).cast("string")
    for said, of, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(of + start)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], **mining) -> DataFrame:
    """Every row of ``pages (page_id, url)`` with ``host``, ``path``, ``rule``, ``confidence`` and ``verdict``.

    ``labels (page_id, bad)`` marks some pages. A curated rule decides; else a page is blocked when a mined rule
    fires on its url, and allowed otherwise. Urls are matched once per distinct text, so a url on a third of all
    rows costs one match. Null and empty urls have no tokens and are allowed; null labels are left out; repeated
    rows are judged alike, and a page labelled twice counts as often as it is labelled. Without pages or labels
    there are no rules. Columns of ``pages`` with the names of added ones are replaced.
    """
    own = ["host", "path", "rule", "confidence", "verdict"]
    pages = pages.drop(*own)
    marked = labels.filter("bad is not null").select(F.col("page_id").alias("_page"), "bad")
    labelled = pages.select("page_id", "url").join(marked, F.col("page_id") == F.col("_page"))
    mined = mine(labelled.select(tokens(F.col("url")).alias("tokens"), "bad"), **mining)
    distinct = pages.select(F.col("url").alias("_url")).filter("_url is not null").distinct()
    hits = matched(distinct.withColumn("tokens", tokens(F.col("_url"))), mined, "_url")
    rule, verdict = host_rule(F.col("host"), F.col("path"), rules)
    said = F.coalesce(verdict, F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    judged = pages.join(hits, pages.url == hits["_url"], "left").drop("_url")
    judged = judged.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    return judged.withColumn("rule", rule).withColumn("verdict", said)
