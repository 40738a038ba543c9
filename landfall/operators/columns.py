"""Bulk column renames."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame


def strip_prefix(df: DataFrame, separator: str = ".") -> DataFrame:
    """Name every column by what follows the first separator in its name, if there is one.

    Raises ``ValueError`` when two columns would share a name, or one would have none.
    """
    names = [rest if found else name for name, found, rest in (c.partition(separator) for c in df.columns)]
    wrong = sorted(name for name, n in Counter(names).items() if n > 1 or not name)
    if wrong:
        raise ValueError(f"columns would collide or lose their name: {wrong}")
    return df.toDF(*names)
