import pytest
from landed import rows

from landfall.sinks.layer import write_layer


def test_result_and_content(spark, folder):
    result = write_layer(spark.range(10), f"{folder}/t")
    assert (result.status, result.rows, result.path) == (0, 10, f"{folder}/t")
    assert rows(spark.read.parquet(f"{folder}/t")) == rows(spark.range(10))


def test_empty_frame(spark, folder):
    result = write_layer(spark.range(10).where("id < 0"), f"{folder}/t")
    assert (result.status, result.rows) == (0, 0)
    assert spark.read.parquet(f"{folder}/t").columns == ["id"]
    assert write_layer(spark.createDataFrame([], "a int"), f"{folder}/u").rows == 0


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_formats(spark, folder, fmt):
    compression = "gzip" if fmt in ("json", "csv") else "snappy"
    write_layer(spark.range(10), f"{folder}/t", fmt=fmt, compression=compression)
    assert spark.read.format(fmt).schema("id long").load(f"{folder}/t").count() == 10


def test_modes(spark, folder):
    path = f"{folder}/t"
    assert write_layer(spark.range(3), path, mode="errorifexists").rows == 3
    assert write_layer(spark.range(3), path, mode="append").rows == 3
    assert write_layer(spark.range(9), path, mode="ignore").rows == 0
    assert spark.read.parquet(path).count() == 6
    failed = write_layer(spark.range(9), path, mode="errorifexists", raise_errors=False)
    assert failed.status == 1 and failed.rows is None and "PATH_ALREADY_EXISTS" in failed.message
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_layer(spark.range(9), path, mode="errorifexists")
    assert write_layer(spark.range(2), path, mode="overwrite").rows == 2
    assert spark.read.parquet(path).count() == 2


def test_number_of_files(spark, folder):
    df = spark.range(1000, numPartitions=7)
    for name, wanted, options in (("a", 3, {"files": 3}), ("b", 1, {"merge_to": 1}), ("c", 7, {})):
        write_layer(df, f"{folder}/{name}", **options)
        assert len(spark.read.parquet(f"{folder}/{name}").inputFiles()) == wanted


def test_compression_is_snappy(spark, folder):
    write_layer(spark.range(5), f"{folder}/t", merge_to=1)
    assert spark.read.parquet(f"{folder}/t").inputFiles()[0].endswith(".snappy.parquet")
