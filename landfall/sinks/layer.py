"""Writing a layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from landfall.paths import exists


@dataclass(frozen=True)
class WriteResult:
    """What a write did. ``status`` is 0 on success and 1 on failure."""

    status: int
    rows: int | None
    path: str
    message: str = ""


def write_layer(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    compression: str = "snappy",
    files: int | None = None,
    merge_to: int | None = None,
    raise_errors: bool = True,
) -> WriteResult:
    """Write ``df`` and return how many rows were written, counted by the write itself.

    ``files`` asks for exactly that many files by spreading the rows evenly, at the price of a
    shuffle; the plan above it stays parallel. ``merge_to`` only merges input partitions, without a
    shuffle: use it when ``df`` is a plain scan. With neither, every task writes its own file.
    Mode ``ignore`` leaves an existing table alone and reports 0 rows.
    Errors propagate unless ``raise_errors`` is off, which turns them into ``status`` 1.
    """
    if files is not None:
        df = df.repartition(files)
    elif merge_to is not None:
        df = df.coalesce(merge_to)
    written = Observation()
    if mode == "ignore" and exists(df.sparkSession, path):
        return WriteResult(0, 0, path, "exists")
    try:
        df.observe(written, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode).option(
            "compression", compression
        ).save(path)
    except Exception as error:
        if raise_errors:
            raise
        return WriteResult(1, None, path, str(error))
    return WriteResult(0, written.get["rows"], path)
