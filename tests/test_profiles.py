import random

import pytest
from landed import rows
from pyspark.sql import functions as F

from landfall.operators.profiles import column_profile, estimated, exact_figures, merged_profiles


def frame(spark, n=40_000):
    group = F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 6 > 0, F.concat(F.lit("g"), (F.col("id") % 5).cast("string")))
    return spark.range(n).select(
        group.alias("file"), "id", (F.col("id") % 100).cast("string").alias("code"),
        F.when(F.col("id") % 4 > 0, F.col("id") / 7).alias("amount"), F.timestamp_seconds("id").alias("moment"),
        F.array(F.col("id") % 2).alias("pair"),
    )


def test_estimates_stay_within_their_bounds(spark):
    df = frame(spark)
    got = {r["field"]: r for r in estimated(column_profile(df.drop("file"), []), [0.1, 0.5, 0.9]).collect()}
    assert {f: (r["n_rows"], r["n_nulls"]) for f, r in got.items()} == {
        "id": (40_000, 0), "code": (40_000, 0), "amount": (40_000, 10_000), "moment": (40_000, 0), "pair": (40_000, 0),
    }
    assert abs(got["id"]["n_distinct"] - 40_000) < 0.06 * 40_000 and abs(got["amount"]["n_distinct"] - 30_000) < 0.06 * 30_000
    assert got["code"]["n_distinct"] == 100 and got["pair"]["n_distinct"] == 2
    for share, value in zip((0.1, 0.5, 0.9), got["id"]["quantiles"]):
        assert abs(value / 40_000 - share) < 0.03
    assert got["code"]["quantiles"] is None and (got["id"]["least"], got["id"]["greatest"]) == ("0", "39999")
    assert (got["moment"]["least"], got["pair"]["greatest"]) == ("1970-01-01 00:00:00", "[1]")


def test_merged_parts_are_the_whole(spark):
    df = frame(spark)
    parts = [column_profile(df.where(f"id % 4 = {n}"), ["file"]) for n in range(4)]
    early, late = parts[0].union(parts[1]), parts[2].union(parts[3])
    merged = merged_profiles(merged_profiles(early, ["file"]).unionByName(merged_profiles(late, ["file"])), ["file"])
    exact = ["file", "field", "n_rows", "n_nulls", "least", "greatest"]
    whole = column_profile(df, ["file"])
    assert rows(merged, *exact) == rows(whole, *exact)
    key = lambda df: {(r["file"], r["field"]): r for r in estimated(df, [0.5]).collect()}
    one, two = key(merged), key(whole)
    for at in two:
        assert abs(one[at]["n_distinct"] - two[at]["n_distinct"]) <= 0.08 * two[at]["n_distinct"]
        assert (one[at]["quantiles"] is None) == (two[at]["quantiles"] is None)
    over_all = estimated(merged_profiles(whole), [0.5]).where("field = 'id'").first()
    assert (over_all["n_rows"], over_all["greatest"]) == (40_000, "39999")


def test_rows_are_not_shuffled(spark):
    plan = column_profile(frame(spark), ["file"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("partial_hll_sketch_agg") > plan.index("Exchange")


def test_odd_input(spark):
    schema = "`a.b` double, n int, s string, g string"
    odd = spark.createDataFrame([(float("nan"), None, "", "x"), (None, None, None, "x"), (-1.5, None, "é", None)], schema)
    got = {(r["g"], r["field"]): r for r in estimated(column_profile(odd, ["g"])).collect()}
    assert (got["x", "a.b"]["n_nulls"], got["x", "a.b"]["n_distinct"], got["x", "a.b"]["greatest"]) == (1, 1, None)
    assert got["x", "a.b"]["quantiles"] is None and got[None, "a.b"]["quantiles"] == [-1.5] * 3
    assert got["x", "n"]["n_distinct"] == 0 and got["x", "n"]["quantiles"] is None
    assert (got["x", "s"]["n_distinct"], got["x", "s"]["least"]) == (1, "")
    empty = odd.where("n = 1")
    assert column_profile(empty, ["g"]).count() == 0
    assert {(r["n_rows"], r["n_nulls"], r["n_distinct"]) for r in estimated(column_profile(empty, [])).collect()} == {(0, 0, 0)}
    assert merged_profiles(column_profile(empty, ["g"]), ["g"]).count() == 0
    with pytest.raises(ValueError):
        column_profile(spark.sql("select map(1, 2) as m"), [])


def test_exact_figures_are_those_of_percentile(spark, folder):
    rnd = random.Random(1)
    values = lambda: rnd.choice([None, float("nan"), rnd.random(), float(rnd.randrange(5))])
    rows = [(g, values()) for g in ("a", "b", None) for _ in range(rnd.randrange(50, 300))] + [("nulls", None)] * 3 + [("one", 7.0)]
    df, at = spark.createDataFrame(rows, "g string, v double").repartition(5), [0.0, 0.45, 0.55, 1.0]
    found = {r.g: (r.n_distinct, str(r.quantiles)) for r in exact_figures(df, ["g"], "v", at, folder).collect()}
    wanted = df.groupBy("g").agg(F.countDistinct("v").alias("n"), F.percentile("v", F.array(*map(F.lit, at))).alias("q")).collect()
    assert found == {r.g: (r.n, str(r.q)) for r in wanted}
