"""A fixed number of rows per group, the same on every run, without sorting or moving the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

PLACE = "sample_place"


def sample_per(df: DataFrame, by: str | Sequence[str], k: int, key: Sequence[str] = (), seed: str = "") -> DataFrame:
    """``k`` rows of each ``by`` group (all, if it has fewer), in the order of ``sample_place`` from 1.

    Rows are ranked by a hash of ``key`` (all columns, if none is named), so a sample depends on the rows alone: not on their order,
    files or tasks. The sample of two tables together is the sample of their samples, so samples kept with batches merge.
    Every task passes on its own first ``k`` rows of a group, so the shuffle carries samples, and a hot group costs its
    reducer ``k`` rows a task. Rows that agree in ``key`` tie; which of them stay is settled by their other columns. Nulls count as
    a value of their own, in ``key`` and in ``by``. Maps cannot be compared and must not be among the columns.
    """
    if k < 1:
        raise ValueError("a sample has a row at least")
    if PLACE in df.columns:
        df = df.drop(PLACE)
    named = list(key) or df.columns
    text = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(named)]), {"ignoreNullFields": "false"})
    mark = F.md5(F.concat(F.lit(seed), text))
    groups = [by] if isinstance(by, str) else list(by)
    order = Window.partitionBy(*groups).orderBy(mark, *[F.col(f"`{c}`") for c in df.columns])
    return df.withColumn(PLACE, F.row_number().over(order)).where(F.col(PLACE) <= k)
