import os

import pytest
from landed import rows
from pyspark.sql import functions as F

from landfall.sinks.sizing import resize


def skewed(spark, folder):
    """A table of one large, some middling and many tiny files."""
    path = f"{folder}/in"
    wide = lambda a, b: spark.range(a, b).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    wide(0, 60_000).coalesce(1).write.parquet(path)
    wide(60_000, 75_000).repartition(3).write.mode("append").parquet(path)
    wide(75_000, 76_000).repartition(30).write.mode("append").parquet(path)
    return path


def bytes_of(path):
    return [os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet")]


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_all_files_but_one_are_near_the_wanted_size(spark, folder, broadcast):
    path, out = skewed(spark, folder), f"{folder}/out"
    target = 600_000
    before = bytes_of(path)
    assert max(before) > 4 * target and min(before) < target / 50
    made = resize(spark, path, out, target, broadcast_files=broadcast)
    after = bytes_of(out)
    assert len(after) == made.files == round(sum(before) / target)
    assert sum(abs(size - target) > 0.2 * target for size in after) <= 1
    assert made.written.rows == 76_000
    assert spark.read.parquet(out).exceptAll(spark.read.parquet(path)).count() == 0


def test_small_tables_become_one_file(spark, folder):
    spark.range(10).repartition(5).write.parquet(f"{folder}/in")
    assert resize(spark, f"{folder}/in", f"{folder}/out", 1_000_000).files == 1
    assert len(bytes_of(f"{folder}/out")) == 1
    assert rows(spark.read.parquet(f"{folder}/out")) == [(i,) for i in range(10)]


def test_empty_tables(spark, folder):
    spark.range(0).write.parquet(f"{folder}/in")
    assert resize(spark, f"{folder}/in", f"{folder}/out", 1_000_000).written.rows == 0
    assert spark.read.parquet(f"{folder}/out").count() == 0


def test_too_many_files_are_refused(spark, folder):
    spark.range(100_000).write.parquet(f"{folder}/in")
    with pytest.raises(ValueError, match="larger"):
        resize(spark, f"{folder}/in", f"{folder}/out", 1)
