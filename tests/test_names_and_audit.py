from datetime import datetime, timezone

import pytest
from landed import rows
from pyspark.sql import functions as F

from landfall.functions.audit import stamp
from landfall.functions.names import batch_identity, batch_tokens, target_name


def paths(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "SourceFileName string")


@pytest.mark.parametrize(
    "path, date, hour",
    [
        ("s3a://bucket/erp/erp_loads_15-01-2024_10.xml", "15-01-2024", "10"),
        ("s3a://a_b/c_d/erp_loads_15-01-2024_10.xml", "15-01-2024", "10"),
        ("file:/x/a%20b_c_d+e_f.xml", "d+e", "f"),
        ("file:/x/a_b_c_10xml-5.xml", "c", "1-5"),
        ("file:/x/a_b_c.xml", "c.xml", None),
        ("file:/x/plain.xml", None, None),
    ],
)
def test_tokens(spark, path, date, hour):
    assert rows(paths(spark, path).select(*batch_tokens("SourceFileName"))) == [(date, hour)]


def test_identity_comes_from_one_file(spark):
    df = paths(spark, "x/a_b_20240101_23.xml", "x/a_b_20240102_01.xml", "x/a_b_20240103.xml")
    assert rows(batch_identity(df)) == [("20240102", "01")]


def test_identity_without_names(spark):
    assert rows(batch_identity(paths(spark, "x/a.xml"))) == [(None, None)]
    assert rows(batch_identity(paths(spark, "x/a.xml").where("false"))) == [(None, None)]


def test_target_name(spark):
    assert rows(spark.range(1).select(target_name("loads", F.lit("d"), F.lit("h")))) == [("loads-d-h.parquet",)]


def test_stamp(spark):
    stamped = stamp(spark.range(2), "erp", 2, datetime(2024, 1, 5, 7, 8, 9))
    assert stamped.columns == ["id", "NumRows", "ProcessedDate", "ProcessedTime", "SourceName"]
    assert dict(stamped.dtypes)["NumRows"] == "string"
    assert dict(stamped.dtypes)["ProcessedTime"] == "timestamp"
    text = stamped.withColumn("ProcessedTime", F.col("ProcessedTime").cast("string"))
    assert rows(text)[0] == (0, "2", "05-01-2024", "2024-01-05 07:08:09", "erp")
    aware = stamp(spark.range(1), "erp", 1, datetime(2024, 1, 5, 7, tzinfo=timezone.utc))
    assert aware.select(F.unix_seconds("ProcessedTime")).first()[0] == 1704438000
