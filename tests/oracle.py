"""Run registered queries against their SQL: ``python tests/oracle.py <data folder> [query ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(file)[:-8]} as select * from '{file}'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when the frame and the SQL have the same columns and the same rows, as multisets."""
    expected = con.execute(sql)
    columns = [d[0] for d in expected.description]
    want = bag(columns, expected.fetchall())
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(columns)}"]
    got = bag(df.columns, df.collect())
    if not want:
        return ["the SQL gives no rows"]
    found = [f"missing {n} x {row}" for row, n in list((want - got).items())[:3]]
    return found + [f"extra {n} x {row}" for row, n in list((got - want).items())[:3]]


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from landfall.session import session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(queries())
    conf = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    spark = session({"spark.master": "local[8]", **conf})
    con, failed = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            got, sql = queries()[name](spark, sf_dir), oracle_sql().get(name)
            found = differences(got, con, sql) if sql else [] if got.columns and got.count() >= 0 else ["no columns"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n     ", flush=True)
    sys.exit(failed)
