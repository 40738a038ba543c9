import json
from decimal import Decimal

import pytest
from landed import rows
from pyspark.sql import functions as F

from landfall.functions.exact import changed_by_text, expand_exact, inventory
from landfall.functions.payload import string_record
from landfall.operators.expand import expand_records

NUMBERS = {"a": "1.50", "b": "0.1234567890123456789012345", "c": "1e3", "d": "12345678901234567890123456789012345678", "e": "-0.10", "f": "9007199254740993", "g": "7"}


def frame(spark, *payloads):
    return spark.createDataFrame(list(enumerate(payloads)), "n int, payload string")


def test_numbers_keep_their_digits(spark):
    text = "[{" + ",".join(f'"{k}":{v}' for k, v in NUMBERS.items()) + "}]"
    row = expand_exact(frame(spark, text), "payload", {k: "string" for k in NUMBERS}).first()
    for name, number in NUMBERS.items():
        assert Decimal(row[name]) == Decimal(number), name
    typed = expand_exact(frame(spark, text), "payload", {"b": "decimal(38,25)", "d": "decimal(38,0)", "f": "bigint"}).first()
    assert (typed["b"], typed["d"], typed["f"]) == (Decimal(NUMBERS["b"]), Decimal(NUMBERS["d"]), int(NUMBERS["f"]))
    changed = rows(changed_by_text(frame(spark, text), "payload", list(NUMBERS)), "field", "as_text", "exact")
    assert changed == [("b", "0.12345678901234568", NUMBERS["b"])]


def test_values_that_do_not_fit_are_named(spark):
    text = '[{"a":"x","b":1.5,"c":true,"d":null},{"a":3,"b":"4","c":"true"},null,{"a":300}]'
    found = expand_exact(frame(spark, text), "payload", {"a": "tinyint", "b": "decimal(3,1)", "c": "boolean", "d": "int"})
    got = [(r["a"], r["b"], r["c"], r["d"], r["unfit_fields"]) for r in found.orderBy("record_position").collect()]
    assert got == [(None, Decimal("1.5"), True, None, ["a"]), (3, Decimal("4.0"), True, None, []), (None, None, None, None, []), (None, None, None, None, ["a"])]


PAYLOADS = ['[{"a":1},null]', '{"a":"2"}', "[]", ' [ {"a":3} ] ', '[{"a":4}] x', '[{"a":5}],[{"a":6}]', '[{"a":7},', "[1,2]", "5", '"x"', "null", "", "  ", None, "[[{}]]"]


def test_the_same_payloads_are_set_aside(spark):
    df = frame(spark, *PAYLOADS)
    plain, exact = expand_records(df, "payload", string_record(["a"])), expand_exact(df, "payload", {"a": "string"})
    columns = ["n", "a", "record_position", "reject_reason", "rejected_text"]
    assert rows(exact, *columns) == rows(plain, *columns)
    repeated = expand_exact(frame(spark, '[{"a":1,"a":2}]'), "payload", {"a": "int"}).first()
    assert (repeated["a"], repeated["reject_reason"]) == (None, "malformed")


def test_inventory(spark):
    texts = ['[{"a":1,"b":1.25,"c":null},{"a":"x","b":123.5}]', '{"a":2,"d":{"e":1},"f":[1]}', "[null]", '[{"a":1', None, '{"b":12345678901234567890123456789012345678901}']
    got = rows(inventory(frame(spark, *texts), "payload"), "field", "kind", "records", "whole_digits", "scale")
    assert got == sorted(
        [("a", "BIGINT", 2, None, None), ("a", "STRING", 1, None, None), ("b", "DECIMAL", 2, 3, 2), ("b", "DOUBLE", 1, None, None),
         ("c", "VOID", 1, None, None), ("d", "OBJECT", 1, None, None), ("f", "ARRAY", 1, None, None)],
        key=lambda t: tuple((v is not None, str(v)) for v in t),
    )


def test_nested_values_and_odd_names(spark):
    text = json.dumps([{"a b": {"x": [1, 2.5]}, "c.d": 3, "é": [1, 2]}])
    row = expand_exact(frame(spark, text), "payload", {"a b": "string", "c.d": "int", "é": "array<int>"}).first()
    assert (row["a b"], row["c.d"], row["é"]) == ('{"x":[1,2.5]}', 3, [1, 2])
    with pytest.raises(ValueError, match="path"):
        expand_exact(frame(spark, text), "payload", {'a"': "int"})
    with pytest.raises(ValueError, match="collide"):
        expand_exact(frame(spark, text), "payload", {"n": "int"})


def test_one_parse_and_no_python(spark, folder):
    frame(spark, "[]").write.parquet(f"{folder}/p")
    plan = expand_exact(spark.read.parquet(f"{folder}/p"), "payload", {"a": "int", "b": "string"})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan
    assert plan.count("parse_json") + plan.count("parseJson") <= 1


def test_empty_table(spark):
    none = frame(spark, "[]").where(F.lit(False))
    assert expand_exact(none, "payload", {"a": "int"}).count() == inventory(none, "payload").count() == 0
