"""Mixing sources to target weights by systematic sampling (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import WORD


def words(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row a source.

    Sources in code point order, null last, take the weights in turn and share ``share`` times all words. No
    target passes ``most`` times its source; the excess goes to the others by weight until none is above. Both
    ends meet in one level: every target is min(cap, level * weight). With sources sorted by cap / weight the
    first ones are capped, and the level follows from the running sums, so no loop is needed.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("nth") - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("nth", F.row_number().over(order)).withColumn("weight", weight)
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(most))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "nth")
    before, from_here = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy("nth")
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(from_here)
    leveled = ranked.withColumn("budget", F.sum("source_size").over(everything) * F.lit(share)).withColumn("level", level)
    # The first source whose cap is not reached sets the level of all that follow it.
    free = F.min(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.struct("cap_rank", "level"))).over(everything)
    leveled = leveled.withColumn("cap_rank", F.row_number().over(by_ratio)).withColumn("free", free)
    target = F.when(F.col("cap_rank") < F.coalesce(F.col("free.cap_rank"), F.lit(2**31)), F.col("cap")).otherwise(
        F.least("cap", F.col("free.level") * F.col("weight"))
    )
    return leveled.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    salts: int = 1024,
) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, how often the mix emits it.

    A document of a source with target T and size S is expected T / S times. Documents of a source are laid on a
    line in the order (size, salt, id), each as long as its expected copies, from one random offset per source; a
    document is emitted once per integer boundary in its stretch. Ordering by size spreads the choice over short
    and long documents, so the words taken come within about one document of the target. Copies differ from the
    expectation by less than one, and never pass ``most``.

    The place on the line needs only a document's rank in its source. Ranks are sums of counts per size, counts
    per salt within a size, and a row number within (source, size, salt), so a source or size that holds a third
    of the rows is spread over ``salts`` groups. The same rows give the same mix: the offset depends on the
    source and ``seed`` alone. Rows of one id are ordered by
    a hash of their values, so only equal rows can change places. Null sources form one
    source, null or empty texts have size 0 and add no words; an empty table gives no rows. Columns of ``docs``
    named like the added ones are replaced. Rows with a null id sort first.
    """
    own = ["size", "source_size", "target", "copies"]
    docs = docs.drop(*own)
    salt = F.coalesce(F.pmod(F.col("doc_id"), F.lit(salts)), F.lit(0)).alias("_salt")
    tie = F.xxhash64(*docs.columns).alias("_tie")  # made before the shuffle, so that texts nobody asks for stay behind
    sized = docs.select("*", words(F.col("text")).alias("size"), salt, tie)
    part = ["source", "size", "_salt"]
    groups = sized.groupBy(part).agg(F.count("*").alias("_n"))
    sums = groups.groupBy("source", "size").agg(F.sum("_n").alias("_n"))
    before = lambda over: F.coalesce(F.sum("_n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_size = sums.select("source", "size", before(Window.partitionBy("source").orderBy("size")).alias("_by_size"))
    by_salt = groups.select(*part, before(Window.partitionBy("source", "size").orderBy("_salt")).alias("_by_salt"))
    goal = targets(sums.groupBy("source").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size")), weights, share, most)
    same = lambda a, b, on: [a[c].eqNullSafe(b[c]) for c in on]
    place = by_salt.join(by_size, same(by_salt, by_size, part[:2])).select(
        *[by_salt[c] for c in part], (F.col("_by_size") + F.col("_by_salt")).alias("_start")
    )
    place = place.join(goal, place.source.eqNullSafe(goal.source)).select(place["*"], "source_size", "target")
    row = F.row_number().over(Window.partitionBy(part).orderBy("doc_id", "_tie")) - 1
    ranked = sized.withColumn("_row", row)
    joined = ranked.join(place, same(ranked, place, part)).select(
        *[ranked[c] for c in docs.columns], ranked["size"], "source_size", "target", (F.col("_start") + F.col("_row")).alias("_rank")
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    digits = F.substring(F.md5(F.concat(F.coalesce("source", F.lit("")), F.lit(f"/{seed}")).cast("binary")), 1, 8)
    offset = F.conv(digits, 16, 10).cast("double") / F.lit(float(2**32))
    edge = lambda rank: F.floor(rank * rate + offset)
    copies = F.least(edge(F.col("_rank") + 1) - edge(F.col("_rank")), F.lit(int(most))).cast("long")
    return joined.select(*docs.columns, "size", "source_size", "target", copies.alias("copies"))


def emitted(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken."""
    own = ["size", "source_size", "target", "copies"]
    repeated = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mixed.filter("copies > 0").withColumn("_copy", repeated).drop("_copy", *own)
