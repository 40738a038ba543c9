"""Landed files that bring again what another file brought, told by their content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from landfall.operators.expand import POSITION
from landfall.paths import exists

MARKS = ("records", "rejects", "mark_1", "mark_2")
LEDGER = "SourceFileName string, records long, rejects long, mark_1 decimal(38,0), mark_2 decimal(38,0), batch string"


def fingerprints(staged: DataFrame) -> DataFrame:
    """Per file with records: counts, and two sums of hashes over all its records and set-aside payloads.

    Sums do not depend on the order of rows, and are partial before the shuffle, so a file of a third of all rows costs
    its reducer no more than any other. Two files of different content agree with odds of 2^-64 and less.
    """
    values = [c for c in staged.columns if c not in ("SourceFileName", "SourceFileTime")]
    parts = [x for c in values for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    marks = [F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)")).cast("decimal(38,0)").alias(f"mark_{seed}") for seed in (1, 2)]
    found = staged.groupBy("SourceFileName").agg(
        F.max("SourceFileTime").alias("SourceFileTime"),
        F.count_if(F.col(POSITION).isNotNull()).alias("records"),
        F.count_if(F.col(POSITION).isNull()).alias("rejects"),
        *marks,
    )
    return found.filter("records > 0")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The fingerprints of files loaded so far; none if there is no ledger yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def resent(prints: DataFrame, ledger: DataFrame) -> DataFrame:
    """``(SourceFileName, SourceFileTime, original)``: files with the content of a file that was loaded, or of another in this batch.

    A file under its own name is no copy: loading it again is left to the load, which repeats it or finds it done. Of files
    with the same new content in one batch, the first by name is the original.
    """
    own = prints.select("SourceFileName", "SourceFileTime", *MARKS)
    before = ledger.groupBy(*MARKS).agg(F.min("SourceFileName").alias("known"), F.collect_set("SourceFileName").alias("names"))
    first = F.min("SourceFileName").over(Window.partitionBy(*MARKS))
    judged = own.withColumn("first", first).join(before, list(MARKS), "left")
    again = F.array_contains("names", F.col("SourceFileName"))
    original = F.when(again, F.lit(None)).when(F.col("known").isNotNull(), F.col("known")).when(F.col("first") != F.col("SourceFileName"), F.col("first"))
    return judged.select("SourceFileName", "SourceFileTime", original.alias("original")).filter("original is not null")
