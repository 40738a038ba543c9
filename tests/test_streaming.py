import os
from datetime import datetime

from landed import put, response, rows

from landfall.plans.loads import loads_spec
from landfall.streaming.incremental import load_stream

RUN_TS = datetime(2024, 1, 15, 10, 30)


def run(spark, spec, folder, **options):
    load_stream(spark, spec, f"{folder}/checkpoint", RUN_TS, **options).awaitTermination()
    return spark.read.option("recursiveFileLookup", True).parquet(spec.target)


def one(n):
    return response(f'[{{"t10_id":{n}}}]')


def test_each_file_is_loaded_once(spark, folder):
    spec = loads_spec(f"{folder}/landing", f"{folder}/bronze", "erp")
    put(spec.landing, "a_b_d_1.xml", one(1))
    assert rows(run(spark, spec, folder), "t10_id", "NumRows") == [("1", "1")]
    put(spec.landing, "a_b_d_2.xml", response('[{"t10_id":2},{"t10_id":3}]', "[]"))
    assert rows(run(spark, spec, folder), "t10_id", "NumRows") == [("1", "1"), ("2", "2"), ("3", "2")]
    assert rows(run(spark, spec, folder), "t10_id") == [("1",), ("2",), ("3",)]
    assert sorted(os.listdir(spec.target)) == [
        "listaCargas-d-1-0000000000.parquet",
        "listaCargas-d-2-0000000001.parquet",
    ]
    rejects = spark.read.option("recursiveFileLookup", True).parquet(spec.rejects_path)
    assert rows(rejects, "reject_reason") == [("empty",)]


def test_file_limit_and_clean(spark, folder):
    """Only loaded files go: not one with a foreign prefix, nor one with a bad name."""
    spec = loads_spec(f"{folder}/landing/in", f"{folder}/bronze", "erp")
    for n in range(3):
        put(spec.landing, f"a_b_d_{n}.xml", one(n))
    put(spec.landing, "a_b_d_9.xml", one(9).replace("ns1:", "ns2:"))
    put(spec.landing, "short.xml", one(8))
    loaded = run(spark, spec, folder, max_files=1, clean=True)
    assert rows(loaded, "t10_id") == [("0",), ("1",), ("2",)]
    assert sorted(os.listdir(spec.landing)) == ["a_b_d_9.xml", "short.xml"]
    run(spark, spec, folder, max_files=1, clean=True)
    assert sorted(os.listdir(spec.landing)) == ["a_b_d_9.xml", "short.xml"]
