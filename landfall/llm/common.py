"""Helpers the operators share: input tables, hold-out folds, intermediate tables and linked components."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.paths import remove
from landfall.session import work_folder

#: ASCII white space: what separates words. Java and Python patterns read it alike.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


BLANK = re.compile(rf"[{SPACE}]".encode())


def slices(data: bytes, size: int = 2**20) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes, cut at white space; a longer word stays whole."""
    start = 0
    while start < len(data):
        cut = BLANK.search(data, start + size)
        end = cut.start() if cut else len(data)
        yield data[start:end]
        start = end


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did; on a cluster it is installed or shipped as usual."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


#: Rows of whole texts are large: so many go to a Python worker at a time, unless the session asks for fewer.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def share(spark: SparkSession, value):
    """Broadcast a value of bounded size."""
    importable(spark)
    small_batches(spark)
    return spark.sparkContext.broadcast(value)


class Work:
    """Tables of one run in the folder all executors share. A written table cuts lineage and outlives executors."""

    def __init__(self, spark: SparkSession, label: str):
        importable(spark)
        small_batches(spark)
        self.spark, self.root, self.n = spark, work_folder(spark, label), 0

    def keep(self, df: DataFrame, label: str, codec: str = "snappy", by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df``, in a folder for each value of ``by``, and read it back. The path is remembered, so ``drop`` can remove it."""
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{label}"
        df.write.option("compression", codec).partitionBy(*by).parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.kept_at = path
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that no later step reads."""
        for df in tables:
            remove(self.spark, df.kept_at)


def components(work: Work, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(id, component_id)`` of every id in ``edges (a, b)``: the smallest id its links reach.

    Each round points every vertex at the smallest label among its neighbours and itself, then jumps along
    labels (the label of its label), so a chain shortens by more than half per round. Rounds are tables in
    the shared folder. A hot vertex is fine: neighbours' labels are pre-aggregated by a partial minimum.
    """
    both = work.keep(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = work.keep(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    for _ in range(rounds):
        near = both.join(labels, both.b == labels.id).groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        best = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("id").alias("label"), F.col("label").alias("jump"))
        new = work.keep(best.join(up, "label", "left").select("id", "old", F.coalesce("jump", "label").alias("label")), "labels")
        work.drop(labels)
        labels = new.select("id", "label")
        labels.kept_at = new.kept_at
        if new.filter("old <> label").isEmpty():
            work.drop(both)
            return labels.select("id", F.col("label").alias("component_id"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")
