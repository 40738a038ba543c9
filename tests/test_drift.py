import itertools

import pytest
from landed import rows
from pyspark.sql import functions as F

from landfall.operators.drift import drift, least_type, merged, profile

FILES = [
    ("a", '[{"id":1,"price":1.25,"name":"x","flag":true},{"id":12345,"price":7,"name":null,"flag":false}]'),
    ("b", '[{"id":"7","price":123456.125,"name":5,"extra":{"x":1}},null]'),
    ("b", '{"id":8,"price":1e3,"flag":"yes"}'),
    ("c", '[{"id":null,"name":[1],"flag":1}]'),
    ("d", '[{"id":1'),
    ("e", "[{},null]"),
]
DECLARED = {"id": "BIGINT", "price": "DECIMAL(6,2)", "name": "STRING", "flag": "BOOLEAN"}


def frame(spark):
    return spark.createDataFrame(FILES, "SourceFileName string, payload string").repartition(3)


def test_types_by_file(spark):
    found = profile(frame(spark), "payload").where("field is not null").select("SourceFileName", "field", least_type().alias("t"))
    assert rows(found) == [
        ("a", "flag", "BOOLEAN"), ("a", "id", "BIGINT"), ("a", "name", "STRING"), ("a", "price", "DECIMAL(3,2)"),
        ("b", "extra", "OBJECT"), ("b", "flag", "STRING"), ("b", "id", "STRING"), ("b", "name", "BIGINT"), ("b", "price", "DOUBLE"),
        ("c", "flag", "BIGINT"), ("c", "id", "VOID"), ("c", "name", "ARRAY"),
    ]


def test_drift_rows(spark):
    found = drift(profile(frame(spark), "payload"), DECLARED)
    assert rows(found, "SourceFileName", "field", "change", "declared", "found") == [
        ("b", "extra", "new", None, "OBJECT"),
        ("b", "flag", "type", "BOOLEAN", "STRING"),
        ("b", "id", "type", "BIGINT", "STRING"),
        ("b", "price", "type", "DECIMAL(6,2)", "DOUBLE"),
        ("c", "flag", "type", "BOOLEAN", "BIGINT"),
        ("c", "name", "type", "STRING", "ARRAY"),
        ("c", "price", "missing", "DECIMAL(6,2)", None),
        *[("e", f, "missing", DECLARED[f], None) for f in sorted(DECLARED)],
    ]


def test_profiles_merge_in_any_order(spark):
    whole = merged([profile(frame(spark), "payload")], by=None)
    parts = [profile(frame(spark).where(F.col("SourceFileName") == f), "payload") for f in "abcde"]
    for order in ([0, 1, 2, 3, 4], [4, 2, 0, 3, 1]):
        nested = merged([merged([parts[i] for i in order[:2]]), *[parts[i] for i in order[2:]]], by=None)
        assert rows(nested, *whole.columns) == rows(whole)


def test_the_lattice_is_a_join(spark):
    """Merging any two types gives the same, in either order, as widening one by the other."""
    texts = {"VOID": "null", "BOOLEAN": "true", "BIGINT": "5", "DECIMAL(3,2)": "1.25", "DOUBLE": "1e9", "STRING": '"x"', "OBJECT": "{}", "ARRAY": "[]"}
    pairs = list(itertools.combinations_with_replacement(texts, 2))
    data = [(f"{x}/{y}/{n}", f'[{{"f":{texts[a]}}},{{"f":{texts[b]}}}]') for x, y in pairs for n, (a, b) in enumerate([(x, y), (y, x)])]
    df = spark.createDataFrame(data, "SourceFileName string, payload string")
    got = {r[0]: r[1] for r in profile(df, "payload").where("field = 'f'").select("SourceFileName", least_type()).collect()}
    numbers = ["BIGINT", "DECIMAL(3,2)", "DOUBLE"]
    for x, y in pairs:
        a, b = got[f"{x}/{y}/0"], got[f"{x}/{y}/1"]
        assert a == b
        if x == y or x == "VOID":
            want = y
        elif x in numbers and y in numbers:
            want = max(x, y, key=numbers.index)
        else:
            want = "VARIANT" if {x, y} & {"OBJECT", "ARRAY"} else "STRING"
        assert a == want, (x, y)


def test_nothing_drifts_when_declared_as_found(spark):
    one = profile(frame(spark).where("SourceFileName = 'a'"), "payload")
    assert drift(one, DECLARED).count() == 0
    assert drift(one, {**DECLARED, "price": "DECIMAL(3,2)"}).count() == 0
    assert rows(drift(one, {**DECLARED, "price": "DECIMAL(2,1)"}), "field", "found") == [("price", "DECIMAL(3,2)")]
    assert drift(one.where(F.lit(False)), DECLARED).count() == 0


@pytest.mark.parametrize("kind", ["INT", "DECIMAL", "BIGINT(3,2)", "array<int>"])
def test_types_outside_the_lattice_are_refused(spark, kind):
    with pytest.raises(ValueError, match="lattice"):
        drift(profile(frame(spark), "payload"), {"id": kind})
