"""Which landed files are proven to be in bronze."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from landfall.functions.payload import BAD_FILE_NAME
from landfall.operators.expand import REASON

LOADED = "loaded"
NO_RECORDS = "no_records"
MISMATCH = "mismatch"
RESENT = "resent"  # another file brought the same content


def file_counts(expanded: DataFrame) -> DataFrame:
    """Per source file: record rows, set-aside payloads, and its change time as listed.

    Partial counts are taken before the shuffle, so a file with a third of all rows costs its
    reducer no more than any other.
    """
    bad = F.col(REASON).isNotNull()
    return expanded.groupBy("SourceFileName").agg(
        F.count_if(~bad).alias("records"),
        F.count_if(bad).alias("rejects"),
        F.count_if(F.col(REASON) == BAD_FILE_NAME).alias("bad_names"),
        F.max("SourceFileTime").alias("SourceFileTime"),
    )


def reconcile(listing: DataFrame, counts: DataFrame, bronze: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row per landed file with its disposition.

    ``loaded``: every record row is in ``bronze`` and every set-aside payload is in ``rejects``, as
    read back from the written tables; only these may be deleted. ``bad_file_name`` and
    ``no_records`` were not loaded. ``mismatch`` means that a table does not hold what was read.
    """
    facts = [
        listing.select("SourceFileName", F.lit(True).alias("landed")),
        counts.withColumn("landed", F.lit(True)),
        bronze.select("SourceFileName", F.lit(1).alias("in_bronze")),
        rejects.select("SourceFileName", F.lit(1).alias("in_rejects")),
    ]
    # One grouping over all facts, with partial sums, instead of a join per table.
    files = (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), facts)
        .groupBy("SourceFileName")
        .agg(
            F.max("landed").alias("landed"),
            F.max("SourceFileTime").alias("SourceFileTime"),
            F.sum("records").alias("records"),
            F.sum("rejects").alias("rejects"),
            F.sum("bad_names").alias("bad_names"),
            F.count("in_bronze").alias("in_bronze"),
            F.count("in_rejects").alias("in_rejects"),
        )
        .where("landed")
    )
    complete = (F.col("records") == F.col("in_bronze")) & (F.col("rejects") == F.col("in_rejects"))
    disposition = (
        F.when(F.col("records").isNull(), NO_RECORDS)
        .when(~complete, MISMATCH)
        .when(F.col("bad_names") > 0, BAD_FILE_NAME)
        .otherwise(LOADED)
    )
    zero = F.lit(0).cast("bigint")
    return files.select(
        "SourceFileName",
        "SourceFileTime",
        F.coalesce("records", zero).alias("records"),
        F.coalesce("rejects", zero).alias("rejects"),
        disposition.alias("disposition"),
    )
