import pytest
from landed import put, rows
from pyspark.sql import functions as F

from landfall.sources.csv_aligned import read_aligned

SCHEMA = "Port string, depth int, Since date"


def name(df, *columns):
    return rows(df.select(F.substring_index("SourceFileName", "/", -1).alias("f"), *columns))


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_parts_of_different_layouts(spark, folder, broadcast):
    put(folder, "a.csv", "port,depth,since\nGdynia,14,1926-09-23\n\"Le Havre, Q1\",,\n")
    put(folder, "b.csv", "﻿SINCE, Depth ,\"Port\"\n1900-01-01,12,Ålesund\n")
    put(folder, "c.csv", "depth,note,port\n7,\"say \"\"hi\"\"\",Kočevje\n\ndepth,note,port\n8,x,\"a \"\"b\"\"\"\n")
    put(folder, "d.csv", "port,depth,since\n")
    put(folder, "e.csv", "")
    got, rejects, parts = read_aligned(spark, folder, SCHEMA, broadcast_files=broadcast)
    assert got.columns == ["Port", "depth", "Since", "SourceFileName"]
    assert name(got, "Port", "depth", F.col("Since").cast("string")) == [
        ("a.csv", "Gdynia", 14, "1926-09-23"), ("a.csv", "Le Havre, Q1", None, None), ("b.csv", "Ålesund", 12, "1900-01-01"),
        ("c.csv", "Kočevje", 7, None), ("c.csv", 'a "b"', 8, None),
    ]
    assert rejects.count() == 0
    assert name(parts, "missing_columns", "extra_columns") == [("a.csv", [], []), ("b.csv", [], []), ("c.csv", ["Since"], ["note"]), ("d.csv", [], [])]


def test_lines_that_do_not_fit_are_set_aside(spark, folder):
    put(folder, "a.csv", 'depth,port\n1,a\n2\n3,b,c\nx,d\n4,"open\n5,"e,f"\n')
    got, rejects, _ = read_aligned(spark, folder, SCHEMA)
    assert name(got, "Port", "depth") == [("a.csv", "a", 1), ("a.csv", "e,f", 5)]
    assert name(rejects, "reject_reason", "line") == [
        ("a.csv", "not_of_type", "x,d"), ("a.csv", "too_few_values", "2"), ("a.csv", "too_many_values", "3,b,c"), ("a.csv", "unreadable", '4,"open'),
    ]


def test_large_parts_are_read_in_splits(spark, folder):
    put(folder, "a.csv", "depth,port\n" + "".join(f"{n},p{n}\n" for n in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got, rejects, _ = read_aligned(spark, folder, SCHEMA)
        assert got.rdd.getNumPartitions() > 5
        assert (got.count(), got.agg(F.sum("depth")).first()[0], rejects.count()) == (5000, sum(range(5000)), 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_repeated_names_and_no_files(spark, folder):
    got, rejects, parts = read_aligned(spark, folder, SCHEMA)
    assert got.count() == rejects.count() == parts.count() == 0
    put(folder, "a.csv", "port,Port\nx,y\n")
    with pytest.raises(ValueError, match="repeats"):
        read_aligned(spark, folder, SCHEMA)


def test_other_separators(spark, folder):
    put(folder, "a.csv", "port|depth\na,b|3\n")
    got, _, parts = read_aligned(spark, folder, SCHEMA, separator="|")
    assert name(got, "Port", "depth") == [("a.csv", "a,b", 3)]
    assert name(parts, "missing_columns") == [("a.csv", ["Since"])]
