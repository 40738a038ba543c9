"""File listings as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def list_files(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """One row per file below ``path``: name, size and change time. No file is opened.

    The listing is fixed when this is called, so a file that lands later is not in it.
    """
    return spark.read.format("binaryFile").options(**options).load(path).select(
        F.col("_metadata.file_path").alias("SourceFileName"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("SourceFileTime"),
    )
