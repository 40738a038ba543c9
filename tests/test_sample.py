import pytest
from landed import rows
from pyspark.sql import functions as F

from landfall.operators.sample import sample_per


def frame(spark, n=3000):
    group = F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 6 > 0, F.concat(F.lit("g"), (F.col("id") % 70).cast("string")))
    return spark.range(n).select(group.alias("file"), "id", F.when(F.col("id") % 2 == 0, "x").alias("note"))


def test_the_same_rows_on_every_run(spark):
    df = frame(spark)
    first = sample_per(df, "file", 5)
    again = sample_per(df.repartition(17).orderBy(F.rand()), "file", 5)
    assert rows(first) == rows(again)
    sizes = {r["file"]: r["count"] for r in df.groupBy("file").count().collect()}
    got = {r["file"]: r["count"] for r in first.groupBy("file").count().collect()}
    assert got == {f: min(n, 5) for f, n in sizes.items()}
    assert rows(sample_per(df, "file", 5, seed="other")) != rows(first)


def test_samples_merge(spark):
    df = frame(spark)
    parts = [sample_per(df.where(f"id % 4 = {n}"), "file", 4).drop("sample_place") for n in range(4)]
    merged = sample_per(parts[0].union(parts[1]).union(parts[2]).union(parts[3]), "file", 4)
    assert rows(merged) == rows(sample_per(df, "file", 4))


def test_only_samples_are_shuffled(spark, folder):
    frame(spark).write.parquet(f"{folder}/t")
    plan = sample_per(spark.read.parquet(f"{folder}/t"), "file", 5, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) > 0  # below the exchange, in each task


def test_ties_repeats_and_odd_input(spark):
    same = spark.createDataFrame([("a", 1, None)] * 7 + [("a", 2, "x"), (None, 3, "y")], "file string, id int, note string")
    got = sample_per(same, "file", 3, ["file"])
    assert got.where("file is null").count() == 1 and got.where("file = 'a'").count() == 3
    assert rows(got) == rows(sample_per(same.repartition(4), "file", 3, ["file"]))
    assert sample_per(same.where("id > 9"), "file", 3).count() == 0
    with pytest.raises(ValueError):
        sample_per(same, "file", 0)
