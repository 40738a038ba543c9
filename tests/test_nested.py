import json
import random
from datetime import datetime

import pytest
from landed import rows
from oracle import connect, differences
from pyspark.sql import functions as F, types as T

from landfall.operators.nested import flatten, rebuild, tree
from landfall.samples import queries

RECORD = "struct<id: string, who: struct<a: int, more: struct<b: string>>, few: array<int>, deep: array<array<string>>, lines: array<struct<p: string, q: array<struct<r: int, s: array<string>>>>>>"


def record_type():
    return T._parse_datatype_string(RECORD)


def random_value(kind, rnd):
    if rnd.random() < 0.2:
        return None
    if isinstance(kind, T.StructType):
        return tuple(random_value(f.dataType, rnd) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return [random_value(kind.elementType, rnd) for _ in range(rnd.randrange(4))]
    return rnd.randrange(9) if isinstance(kind, T.IntegerType) else rnd.choice(["", "x", "é"])


@pytest.mark.parametrize("seed", range(2))
def test_tables_rejoin_to_the_records(spark, folder, seed):
    """Nulls, empty arrays, structs of nulls, arrays of arrays, several levels."""
    kind, rnd = record_type(), random.Random(seed)
    payloads = [(n, None if n % 7 == 6 else [random_value(kind, rnd) for _ in range(rnd.randrange(5))]) for n in range(60)]
    schema = T.StructType().add("file", T.IntegerType()).add("parsed", T.ArrayType(kind))
    parsed = spark.createDataFrame(payloads, schema).repartition(3)
    tables = flatten(parsed, "parsed", f"{folder}/work")
    assert set(tables) == {"root", "root_few", "root_deep", "root_deep_value", "root_lines", "root_lines_q", "root_lines_q_s"}
    built = rebuild(tables, kind).join(tables["root"].select("row_key", "file", "position"), "row_key")
    want = parsed.select("file", F.posexplode("parsed").alias("position", "record"))
    assert want.count() > 60
    assert rows(built, "file", "position", "record") == rows(want, "file", "position", "record")
    for name, one in tables.items():
        assert one.count() == one.select("row_key").distinct().count(), name


def test_columns_of_the_tables(spark, folder):
    parsed = spark.createDataFrame([("f", [("1", (2, None), [3], None, [])])], T.StructType().add("file", T.StringType()).add("parsed", T.ArrayType(record_type())))
    tables = flatten(parsed, "parsed", f"{folder}/work")
    assert tables["root"].columns == [
        "row_key", "position", "file", "present", "who_present", "who_more_present", "id", "who_a", "who_more_b", "few_count", "deep_count", "lines_count",
    ]
    assert rows(tables["root"].drop("row_key")) == [(0, "f", True, True, False, "1", 2, None, 1, None, 0)]
    assert rows(tables["root_few"], "position", "value") == [(0, 3)]
    assert tables["root_few"].select("parent_key").exceptAll(tables["root"].select("row_key")).count() == 0


def test_no_shuffle(spark, folder):
    parsed = spark.createDataFrame([("f", [("1", (2, None), [3], None, [])])], T.StructType().add("file", T.StringType()).add("parsed", T.ArrayType(record_type())))
    for one in flatten(parsed, "parsed", f"{folder}/work").values():
        assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()


def test_clashing_names_are_refused(spark, folder):
    with pytest.raises(ValueError, match="collide"):
        tree(T._parse_datatype_string("struct<a_b: int, a: struct<b: int>>"))
    with pytest.raises(ValueError, match="collide"):
        tree(T._parse_datatype_string("struct<few: array<int>, few_count: int>"))
    parsed = spark.createDataFrame([(1, [(2,)])], "id int, parsed array<struct<id: int>>")
    with pytest.raises(ValueError, match="named as"):
        flatten(parsed, "parsed", f"{folder}/work")


def test_empty_input(spark, folder):
    parsed = spark.createDataFrame([], T.StructType().add("parsed", T.ArrayType(record_type())))
    assert all(one.count() == 0 for one in flatten(parsed, "parsed", f"{folder}/work").values())


def line_items(spark, folder):
    """Every kind of line item, with nulls and with text that JSON escapes."""
    schema = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    day = datetime(2024, 1, 15, 10, 30)
    items = [(k, 10 + k, 20 + k, n, 'N"', "\\é\n", day) for k, n in enumerate([0, 1, 2, 3, 4, 5])]
    items += [(2**62, None, None, n, None, None, None) for n in (3, 4, 5, None)] + [(None, 1, 2, n, "", "O", day) for n in (3, 4)] + items[:2]
    spark.createDataFrame(items, schema).write.parquet(f"{folder}/lineitem.parquet")
    return items


def as_text(order, part, supplier, number, flag, status, day):
    n = None if number is None else number % 3
    stops = [{"at": day and f"{day:%Y-%m-%d}"}, {"at": None}] if n == 0 else [] if n == 1 else None
    line = {"part": part, "tags": [flag, status] if n in (0, 1) else None, "stops": stops}
    customer = {"key": supplier, "name": None} if n in (1, 2) else None
    record = {"id": order, "customer": customer, "lines": [] if n == 2 else [line, line]}
    return json.dumps([record], separators=(",", ":"), ensure_ascii=False)


def test_sample_payloads_are_made_outside_the_parse(spark, folder, monkeypatch):
    """A projection that parses is not compiled, so what else it holds is interpreted."""
    line_items(spark, folder)
    monkeypatch.setattr(queries, "flatten", lambda parsed, column, work: parsed)
    plan = queries.nested_tables(spark, folder)._jdf.queryExecution().executedPlan().toString().splitlines()
    assert any("from_json" in node for node in plan) and any("StructsToJson" in node for node in plan)
    assert not any("from_json" in node and "StructsToJson" in node for node in plan)


def test_sample_payloads(spark, folder):
    items = line_items(spark, folder)
    want = sorted(as_text(*item) for item in items)
    assert sorted(p for (p,) in queries.nested_payloads(spark, folder).collect()) == want


@pytest.mark.parametrize("name", ["nested_parents", "nested_children"])
def test_sample_queries(spark, folder, name):
    """Against the SQL where line numbers are not null, which the SQL compares otherwise."""
    line_items(spark, folder)
    known = f"{folder}/known/lineitem.parquet"
    spark.read.parquet(f"{folder}/lineitem.parquet").where("l_linenumber is not null").write.parquet(known)
    con = connect(folder + "/none")
    con.execute(f"create view lineitem as select * replace (l_shipdate::timestamp as l_shipdate) from '{known}/*.parquet'")
    assert differences(queries.QUERIES[name](spark, f"{folder}/known"), con, queries.ORACLES[name]) == []
