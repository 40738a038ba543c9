"""Files of a wanted size, from files of any size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landfall.paths import qualified, sizes
from landfall.sinks.layer import WriteResult, write_layer

#: Files whose places may be broadcast (some 100 MB on an executor); beyond, rows are joined to them by a shuffle.
BROADCAST_FILES = 500_000
LARGEST = 100_000  # files a rewrite may make at once


@dataclass(frozen=True)
class Sizing:
    """How many files a rewrite made, of how many bytes each was to be."""

    files: int
    target_bytes: float
    written: WriteResult


def place(spark: SparkSession, path: str, target_bytes: int) -> tuple[DataFrame, int, int]:
    """``(file, start, bytes, rows)`` of each parquet file below ``path``, the bytes of all, and how many files to make.

    Files are laid end to end, largest first, as on a tape; ``start`` is where a file begins on it.
    """
    listed = sizes(spark, path, ".parquet")
    at, rows = 0, []
    for name, size in sorted(listed.items(), key=lambda x: (-x[1], x[0])):
        rows.append((name, at, size))
        at += size
    table = spark.createDataFrame(rows, "file string, start long, bytes long")
    counts = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("rows"))
    joined = table.join(counts.withColumn("file", tail(F.col("path"))), "file")
    return joined.select("file", "start", "bytes", "rows"), at, max(1, round(at / target_bytes))


def tail(path: Column) -> Column:
    """A part file's own name; they are unique within a table."""
    return F.try_url_decode(F.replace(F.substring_index(path, "/", -1), F.lit("+"), F.lit("%2B")))


def resize(
    spark: SparkSession, path: str, target: str, target_bytes: int, compression: str = "snappy", broadcast_files: int = BROADCAST_FILES
) -> Sizing:
    """Rewrite the parquet table at ``path`` to ``target`` in files of about ``target_bytes``.

    The tape of all files is cut into equal parts, as near to the wanted size as their number allows. A row lies on the tape
    by its place in its file; so large files are split, small ones put together, and rows near each other stay so. Each
    part is one task and one file, so the largest task is one file's worth whatever the input files were. One shuffle of
    the rows; a part's bytes differ from the wanted ones only as far as rows of one file differ, and its compression.
    """
    path = qualified(spark, path)
    files, total, n = place(spark, path, target_bytes)
    if n > LARGEST:
        raise ValueError(f"{n} files of {target_bytes} bytes; ask for larger ones or rewrite folder by folder")
    table = spark.read.parquet(path)
    columns = table.columns
    few = files.count() <= broadcast_files
    own = files.select(F.col("file").alias("_file"), F.col("start").alias("_start"), F.col("bytes").alias("_bytes"), F.col("rows").alias("_rows"))
    read = table.select("*", tail(F.col("_metadata.file_path")).alias("_file"), F.col("_metadata.row_index").alias("_row"))
    placed = read.join(F.broadcast(own) if few else own, "_file")
    at = F.col("_start") + F.col("_bytes") * (F.col("_row") + F.lit(0.5)) / F.col("_rows")
    part = F.least(F.lit(n - 1), F.floor(at * F.lit(n) / F.lit(max(total, 1)))).cast("int")
    dealt = placed.withColumn("_part", part).repartitionById(n, F.col("_part")).select(*columns)
    return Sizing(n, total / n, write_layer(dealt, target, compression=compression))
