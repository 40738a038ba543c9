"""What the vector operators share: usable vectors and their blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, embedding)``, one row per id: vectors that are not null, not zero, and have only finite components.

    Rows without an id are left out; of several rows of an id the smallest vector counts.
    """
    inf = float("inf")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one. Scaling by the largest component first keeps very large and very small vectors exact."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
