import random

import pytest
from landed import rows
from pyspark.sql import functions as F

from landfall.functions.payload import parse_payload, string_record
from landfall.operators.columns import strip_prefix
from landfall.operators.expand import accepted, expand_records, rejected, transpose, zip_explode

RECORD = string_record(["t10_id", "t06_placa", "clientes"])


def frame(spark, *payloads):
    return spark.createDataFrame(list(enumerate(payloads)), "n int, payload string")


def test_normal_payload_and_null_element(spark):
    text = (
        '[{"t10_id":1,"t06_placa":"AAA","clientes":[{"x":1.50}],"extra":9},{"t10_id":"2","t06_placa":null},null]'
    )
    got = accepted(expand_records(frame(spark, text), "payload", RECORD))
    assert got.columns == ["n", "t10_id", "t06_placa", "clientes"]
    assert rows(got) == [(0, None, None, None), (0, "1", "AAA", '[{"x":1.5}]'), (0, "2", None, None)]


def test_single_object_is_one_row(spark):
    got = accepted(expand_records(frame(spark, '{"t10_id":"3","t06_placa":"single"}'), "payload", RECORD))
    assert rows(got, "t10_id", "t06_placa") == [("3", "single")]


@pytest.mark.parametrize(
    "payload, reason",
    [
        ("[]", "empty"),
        ('[{"t10_id":"4"},{"t10_id":', "malformed"),
        ("5", "malformed"),
        ('"x"', "malformed"),
        ("[1,2]", "malformed"),
        ("null", "malformed"),
        ("", "malformed"),
        (None, "missing"),
    ],
)
def test_rejects_keep_the_whole_text(spark, payload, reason):
    expanded = expand_records(frame(spark, payload), "payload", RECORD)
    assert accepted(expanded).count() == 0
    assert rows(rejected(expanded, "n")) == [(0, reason, payload)]


@pytest.mark.parametrize(
    "value, text",
    [
        ("1", "1"),
        ("true", "true"),
        ("1.50", "1.5"),
        ("1e3", "1000.0"),
        ("12345678901234567890123", "12345678901234567890123"),
        ('{"z":1.10}', '{"z":1.1}'),
        ("null", None),
    ],
)
def test_everything_becomes_text(spark, value, text):
    got = accepted(expand_records(frame(spark, f'[{{"t10_id":{value}}}]'), "payload", RECORD))
    assert rows(got, "t10_id") == [(text,)]


def test_duplicate_and_other_case_keys(spark):
    got = accepted(expand_records(frame(spark, '[{"t10_id":1,"t10_id":2,"T06_PLACA":3}]'), "payload", RECORD))
    assert rows(got, "t10_id", "t06_placa") == [("2", None)]


def test_failfast_raises(spark):
    broken = frame(spark, '[{"t10_id":').select(parse_payload("payload", RECORD, "FAILFAST").alias("p"))
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        broken.collect()


def random_payloads(seed, n=300):
    rnd = random.Random(seed)

    def value():
        return rnd.choice(["null", "1", "1.25", '"a"', '"ç & <"', "true", '{"z":[1,2]}'])

    def record():
        if rnd.random() < 0.1:
            return "null"
        fields = [f for f in RECORD.fieldNames() if rnd.random() < 0.8]
        return "{" + ",".join(f'"{f}":{value()}' for f in fields) + "}"

    for _ in range(n):
        text = "[" + ",".join(record() for _ in range(rnd.randrange(0, 6))) + "]"
        kind = rnd.random()
        yield None if kind < 0.05 else text[: rnd.randrange(len(text))] if kind < 0.15 else text


@pytest.mark.parametrize("seed", range(3))
def test_both_shapes_give_the_same_rows(spark, seed):
    df = frame(spark, *random_payloads(seed))
    direct = accepted(expand_records(df, "payload", RECORD))
    parsed = df.select("n", parse_payload("payload", RECORD).alias("p"))
    zipped = zip_explode(transpose(parsed, "p", RECORD.fieldNames()), RECORD.fieldNames())
    assert direct.columns == zipped.columns
    assert direct.exceptAll(zipped).count() == 0
    assert zipped.exceptAll(direct).count() == 0


def test_every_payload_is_accounted_for(spark):
    expanded = expand_records(frame(spark, *random_payloads(7)), "payload", RECORD)
    good = accepted(expanded).select("n").distinct()
    bad = rejected(expanded, "n").select("n")
    assert good.intersect(bad).count() == 0
    assert good.union(bad).distinct().count() == 300
    assert bad.count() == bad.distinct().count()


def test_zip_pads_and_drops_empty(spark):
    df = spark.createDataFrame(
        [(1, [1, 2], ["a"]), (2, [], []), (3, None, None)], "k int, x array<int>, y array<string>"
    )
    assert rows(zip_explode(df, ["x", "y"])) == [(1, 1, "a"), (1, 2, None)]


def test_strip_prefix(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["z.a", "b", "z.c"])
    assert strip_prefix(df).columns == ["a", "b", "c"]
    assert rows(strip_prefix(df)) == [(1, 2, 3)]


def test_strip_prefix_cuts_once_and_refuses_collisions(spark):
    assert strip_prefix(spark.sql("select 1 as `a.b.c`, 2 as `x.d`, 3 as y")).columns == ["b.c", "d", "y"]
    with pytest.raises(ValueError, match="collide"):
        strip_prefix(spark.sql("select 1 as `a.b`, 2 as `x.b`"))


def test_text_after_the_first_value_is_malformed(spark):
    record = string_record(["a"])
    texts = ['[{"a":1}][{"a":2}]', '{"a":1}{"a":2}', '[{"a":1}] rest', '[{"a":1}],[{"a":2}]', '{"a":1},{"a":2}', "null", ""]
    good = ['[{"a":1},null]', ' {"a":1} ', "[]"]
    df = spark.createDataFrame([(t,) for t in texts + good], "p string").select("p", parse_payload("p", record).alias("r"))
    found = {r["p"]: None if r["r"] is None else [None if x is None else x["a"] for x in r["r"]] for r in df.collect()}
    assert [found[t] for t in texts] == [None] * len(texts)
    assert [found[t] for t in good] == [["1", None], ["1"], []]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("pick", [lambda e: e, accepted, lambda e: rejected(e, "n")])
def test_one_parse_and_no_shuffle(spark, folder, pick):
    frame(spark, "[]").write.parquet(f"{folder}/p")
    text = plan(pick(expand_records(spark.read.parquet(f"{folder}/p"), "payload", RECORD)))
    assert text.count("from_json") == 1
    assert "Exchange" not in text


def test_text_is_not_carried_through_the_explode(spark, folder):
    frame(spark, "[]").write.parquet(f"{folder}/p")
    text = plan(expand_records(spark.read.parquet(f"{folder}/p"), "payload", RECORD))
    generate = next(line for line in text.splitlines() if "Generate" in line)
    assert "payload" not in generate
    assert "rejected_text" in generate


ELEMENTS = ['{"a":1,"b":"x,]}"}', ' null', '{"a":{"c":[1,{}]},"b":null}', '\n{"b":"\\\\\\""}', '{"a":"é\\u0041 [","b":2}']
WHOLE = [("1", "x,]}"), (None, None), ('{"c":[1,{}]}', None), (None, '\\"'), ("éA [", "2")]


def test_salvage_of_every_truncation(spark):
    text = "[" + ",".join(ELEMENTS) + "]"
    record = string_record(["a", "b"])
    df = spark.createDataFrame([(n, text[:n]) for n in range(1, len(text) + 1)], "n int, p string").repartition(3)
    found = expand_records(df, "p", record, salvage=True)
    got = {}
    for row in found.orderBy("n", F.col("record_position").asc_nulls_last()).collect():
        got.setdefault(row["n"], []).append((row["a"], row["b"], row["reject_reason"], row["rejected_text"]))
    ends = [1 + sum(len(e) + 1 for e in ELEMENTS[: i + 1]) - 1 for i in range(len(ELEMENTS))]
    for n in range(1, len(text)):
        # A literal is complete only when a comma or bracket follows it, an object with its last brace.
        done = sum(n >= end + (e.strip() == "null") for end, e in zip(ends, ELEMENTS))
        assert [r[:2] for r in got[n][:-1]] == WHOLE[:done]
        reason, tail = got[n][-1][2:]
        start = min(ends[done - 1] + 1, n) if done else 0
        assert (reason, tail) == ("broken_tail" if done else "malformed", text[start:n])
    assert [r[:2] for r in got[len(text)]] == WHOLE


@pytest.mark.parametrize(
    "text, ids, tail",
    [
        ('[{"a":1},{"a":},{"a":3}]', ["1"], '{"a":},{"a":3}]'),
        ('[{"a":1},5,{"a":3}]', ["1"], '5,{"a":3}]'),
        ('[{"a":1},,{"a":3}]', ["1"], ',{"a":3}]'),
        ('[{"a":1}{"a":2}]', ["1"], '{"a":2}]'),
        ('[{"a":1}] rest', ["1"], " rest"),
        ('[{"a":1}][{"a":2}]', ["1"], '[{"a":2}]'),
        ("[{'a':'it'},{'a", ["it"], "{'a"),
    ],
)
def test_salvage_stops_at_the_first_break(spark, text, ids, tail):
    found = expand_records(frame(spark, text), "payload", string_record(["a"]), salvage=True)
    assert rows(accepted(found), "a") == [(i,) for i in ids]
    assert rows(rejected(found, "n")) == [(0, "broken_tail", tail)]


@pytest.mark.parametrize("text, reason", [("[1,2", "malformed"), ('{"a":1', "malformed"), ("", "malformed"), ("x", "malformed"), (None, "missing"), ("[]", "empty")])
def test_nothing_to_salvage(spark, text, reason):
    found = expand_records(frame(spark, text), "payload", string_record(["a"]), salvage=True)
    assert accepted(found).count() == 0
    assert rows(rejected(found, "n")) == [(0, reason, text)]


@pytest.mark.parametrize("seed", range(2))
def test_salvage_changes_no_good_payload(spark, seed):
    df = frame(spark, *random_payloads(seed))
    plain, saved = (expand_records(df, "payload", RECORD, salvage=s) for s in (False, True))
    assert plain.columns == saved.columns
    good = df.join(rejected(plain, "n").select("n"), "n", "left_anti").select("n")
    assert rows(saved.join(good, "n")) == rows(plain.join(good, "n"))
    assert rejected(saved, "n").select("n").exceptAll(rejected(plain, "n").select("n")).count() == 0
