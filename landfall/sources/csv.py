"""CSV scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_csv(spark: SparkSession, path: str | list[str], schema: str, **options: str) -> DataFrame:
    """Read CSV part files that each repeat the header line. ``schema`` is a DDL string."""
    return spark.read.schema(schema).option("header", True).options(**options).csv(path)
