"""Time the headline queries and print one JSON line.

describes at sf0.1 (20,000 records of 69 fields, 50 per payload, 2,500 per file) at twice its bytes;
``orders`` gives the same at 7.5 times the records, ``lineitem`` a landing of ten-field records.
registered queries include building theirs. Each is the median of two to seven runs after a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.functions.payload import parse_payload, string_record
from landfall.operators.expand import accepted, transpose, zip_explode
from landfall.plans.batch import expand, load_batch, scan
from landfall.plans.loads import FIELDS, KEEP, PAYLOAD, loads_spec
from landfall.samples.landing import load_records, write_landing
from landfall.samples.queries import QUERIES, table
from landfall.session import session, work_folder

WARM_UP_SECONDS = 3
MEASURED_SECONDS = 4
REGISTERED = [
    "json_parse",
    "zip_explode",
    "expand_records",
    "payload_rejects",
    "batch_identity",
    "distinct_tokens",
    "date_text",
    "audit_stamp",
    "parquet_sink",
    "sized_files_sink",
    "csv_parts_scan",
]


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def median_seconds(run) -> float:
    warm_up = 0.0
    while warm_up < WARM_UP_SECONDS:
        warm_up += timed(run)
    seconds = [timed(run) for _ in range(2)]
    while len(seconds) < 7 and sum(seconds) < MEASURED_SECONDS:
        seconds.append(timed(run))
    return round(statistics.median(seconds), 3)


def wide_records(df: DataFrame, key: str) -> DataFrame:
    """Records with a value for each of the 69 fields."""
    columns = [F.concat(F.lit(f"{f} "), key).alias(f) for f in FIELDS]
    tokens = F.lit("20240115").alias("date_token"), F.lit("10").alias("hour_token")
    return df.select(F.to_json(F.struct(*columns)).alias("record"), *tokens)


def land(spark: SparkSession, records: DataFrame, cpus: int) -> str:
    folder = work_folder(spark, "bench-landing")
    write_landing(records.repartition(cpus), folder)
    return folder


def shapes(spark: SparkSession, landing: str) -> dict:
    """The ways to get from landed XML to rows, into a sink that discards them."""
    spec = loads_spec(landing, "", "bench")

    def expanded(splittable: bool, keep: tuple[str, ...]) -> DataFrame:
        wanted = spec.but(splittable=splittable, keep=keep)
        return accepted(expand(scan(spark, wanted), wanted)).select(*keep, "SourceFileName")

    def zipped() -> DataFrame:
        payloads = scan(spark, spec.but(splittable=False)).select("SourceFileName", PAYLOAD)
        parsed = payloads.select("SourceFileName", parse_payload(PAYLOAD, string_record(FIELDS)).alias("parsed"))
        return zip_explode(transpose(parsed, "parsed", FIELDS), FIELDS).select(*KEEP, "SourceFileName")

    frames = {
        "expand_6": expanded(False, KEEP),
        "expand_6_split": expanded(True, KEEP),
        "expand_69_split": expanded(True, FIELDS),
        "zip_explode_69": zipped(),
    }
    return {name: (lambda df=df: noop(df)) for name, df in frames.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = session(
        {
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.showConsoleProgress": "false",
        },
        name="bench",
    )
    landings = {
        "part": land(spark, wide_records(table(spark, sf_dir, "part"), "p_partkey"), cpus),
        "orders": land(spark, wide_records(table(spark, sf_dir, "orders"), "o_orderkey"), cpus),
        "lineitem": land(spark, load_records(table(spark, sf_dir, "lineitem")), cpus),
    }
    runs = {f"part_{name}": run for name, run in shapes(spark, landings["part"]).items()}
    runs |= {f"orders_{name}": run for name, run in shapes(spark, landings["orders"]).items()}

    def load(landing: str):
        return lambda: load_batch(spark, loads_spec(landing, work_folder(spark, "bronze"), "bench"))

    runs |= {f"{name}_bronze_load": load(landing) for name, landing in landings.items()}
    runs |= {name: (lambda q=QUERIES[name]: noop(q(spark, sf_dir))) for name in REGISTERED}

    wanted = sys.argv[1:] or list(runs)
    seconds = {name: median_seconds(runs[name]) for name in wanted}
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
