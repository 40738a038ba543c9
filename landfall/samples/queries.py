"""Every operator as a query over the given tables, next to the SQL that must give the same rows."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landfall.functions.audit import stamp
from landfall.functions.exact import changed_by_text, expand_exact, inventory
from landfall.functions.names import batch_identity, file_name, name_token, target_name
from landfall.functions.payload import parse_payload, string_record
from landfall.operators.columns import strip_prefix
from landfall.operators.drift import drift, merged, profile
from landfall.operators.expand import POSITION, accepted, expand_records, transpose, zip_explode
from landfall.operators.nested import flatten
from landfall.operators.profiles import column_profile, estimated, exact_figures, merged_profiles
from landfall.operators.sample import sample_per
from landfall.plans.batch import expand, load_batch, scan
from landfall.plans.loads import KEEP, loads_spec
from landfall.samples.landing import load_records, write_elements, write_landing
from landfall.paths import sizes
from landfall.session import work_folder
from landfall.sinks.cleanup import delete_loaded
from landfall.sinks.layer import write_layer
from landfall.sinks.sizing import resize
from landfall.sinks.versions import AuditFailed, VersionConflict, publish, read_version, restore, versions
from landfall.sources.csv import read_csv
from landfall.sources.csv_aligned import read_aligned
from landfall.sources.xml import EXACT, read_xml
from landfall.streaming.incremental import load_stream
from landfall.streaming.slots import RESULT, slot_report

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
RUN_TS = datetime(2024, 1, 15, 10, 30)


def query(sql: str, name: str = "") -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name or run.__name__] = run
        ORACLES[name or run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_landed: dict[tuple[str, str], str] = {}


def loads_landing(spark: SparkSession, sf_dir: str) -> str:
    """Line items landed as XML, once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        folder = work_folder(spark, "landing")
        write_landing(load_records(table(spark, sf_dir, "lineitem")), folder)
        _landed[key] = folder
    return _landed[key]


def with_file_tokens(loaded: DataFrame) -> DataFrame:
    """Replace the file's path, which differs from run to run, by the tokens of its name."""
    name = file_name("SourceFileName")
    tokens = [name_token(name, 2).alias("file_date"), name_token(name, 3).alias("file_hour")]
    return loaded.select("*", *tokens).drop("SourceFileName")


LOAD_COLUMNS = """
    cast(l_orderkey as varchar) as t10_id,
    strftime(l_shipdate, '%Y-%m-%d') as t10_data_grava,
    'São & <' || l_suppkey || '>' as t10_destino,
    case when l_returnflag <> 'N' then l_returnflag end as t06_placa,
    l_linestatus as t10_situacao,
    cast(l_partkey as varchar) as t06_id,
    strftime(l_shipdate, '%Y') as file_date,
    '10.xml' as file_hour
"""

# Sources.


@query("select l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag from lineitem")
def xml_rowtag_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements without a namespace, one record each, read by Spark's XML source."""
    fields = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag"]
    folder = work_folder(spark, "rowtag")
    payload = F.to_json(F.array(F.struct(*fields))).alias("payload")
    landed = table(spark, sf_dir, "lineitem").select(payload)
    landed.write.format("xml").option("rootTag", "loads").option("rowTag", "load").save(folder)
    scanned = read_xml(spark, folder, "load", "payload string", lineage=False)
    rows = accepted(expand_records(scanned, "payload", string_record(fields)))
    types = ["bigint", "bigint", "int", "double", "string"]
    return rows.select(*[F.col(f).cast(t) for f, t in zip(fields, types)])


def loads_rows(spark: SparkSession, sf_dir: str, splittable: bool) -> DataFrame:
    spec = loads_spec(loads_landing(spark, sf_dir), "", "", splittable=splittable)
    rows = accepted(expand(scan(spark, spec), spec)).select(*KEEP, "SourceFileName")
    return with_file_tokens(rows)


@query(f"select {LOAD_COLUMNS} from lineitem")
def xml_namespaced_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements with a namespace prefix and attributes, one task per file."""
    return loads_rows(spark, sf_dir, splittable=False)


@query(f"select {LOAD_COLUMNS} from lineitem")
def xml_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same elements from files cut into splits."""
    return loads_rows(spark, sf_dir, splittable=True)


@query(
    """
    select l_orderkey as key, l_linenumber as line, '</row><row>' || l_returnflag as note,
           case when l_linenumber % 2 = 0 then l_partkey end as inner_key
    from lineitem
    """
)
def xml_exact_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few documents in many splits, full of what looks like row elements: in comments, CDATA, attributes and inside others."""
    lines = table(spark, sf_dir, "lineitem")
    inner = F.when(F.col("l_linenumber") % 2 == 0, F.format_string("<row><k>%d</k></row>", "l_partkey")).otherwise("<row/>")
    element = F.format_string(
        "<row at='a>b'><!-- <row><key>0</key></row> --><key>%d</key><line>%d</line><note><![CDATA[</row><row>%s]]></note>%s</row><?skip </row>?>",
        "l_orderkey", "l_linenumber", "l_returnflag", inner.alias("inner"),
    )
    folder, size = work_folder(spark, "exact"), "spark.sql.files.maxPartitionBytes"
    write_elements(lines.select(element.alias("element")), folder)
    before = spark.conf.get(size)
    # Splits grow with the landing, up to 4 MB: a document has many, and their number does not outgrow the input.
    landed = sum(sizes(spark, folder, ".xml").values())
    spark.conf.set(size, str(min(2**22, max(2**18, landed // 128))))
    try:
        schema = "key long, line int, note string, row struct<k: long>"
        rows = read_xml(spark, folder, "row", schema, splittable=EXACT, lineage=False)
    finally:
        spark.conf.set(size, before)
    return rows.select("key", "line", "note", F.col("row.k").alias("inner_key"))


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def xml_inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML without a declared schema; only integers need narrowing to their original width."""
    folder = work_folder(spark, "inferred")
    landed = table(spark, sf_dir, "customer")
    landed.write.format("xml").option("rootTag", "customers").option("rowTag", "customer").save(folder)
    return read_xml(spark, folder, "customer", lineage=False).withColumns(
        {"c_nationkey": F.col("c_nationkey").cast("int"), "c_acctbal": F.col("c_acctbal").cast("double")}
    )


@query("select 'lineitem.parquet' as file, count(*) as n from lineitem")
def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select(file_name("_metadata.file_path").alias("file"))
    return lineitem.groupBy("file").agg(F.count("*").alias("n"))


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def csv_parts_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part files that each start with the header."""
    customer = table(spark, sf_dir, "customer")
    folder = work_folder(spark, "csv")
    customer.repartition(4).write.option("header", True).csv(folder)
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return read_csv(spark, folder, schema)


CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def misaligned_customers(spark: SparkSession, sf_dir: str) -> str:
    """Customers in CSV parts of three layouts, one with a line too short for each customer of a nation."""
    customer, folder = table(spark, sf_dir, "customer"), work_folder(spark, "aligned")
    layouts = [
        (0, ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
        (1, ["c_mktsegment", "c_acctbal", "c_name", "c_custkey", "c_nationkey"]),
        (2, ["c_name", "note", "c_custkey", "c_mktsegment"]),
    ]
    for kind, columns in layouts:
        part = customer.where(F.col("c_custkey") % 3 == kind).withColumn("note", F.lit('a "quoted", note'))
        part.select(columns).repartition(2).write.mode("append").option("header", True).option("escape", '"').csv(folder)
    short = customer.where("c_nationkey = 7").select(F.concat(F.lit("short "), "c_custkey").alias("c_name"), F.lit("x").alias("c_custkey"))
    lines = short.select(F.concat_ws(",", "c_name", "c_custkey").alias("c_name,c_custkey,c_acctbal"))
    lines.coalesce(1).write.mode("append").option("header", True).option("sep", "|").csv(folder)
    return folder


@query(
    """
    select c_custkey, c_name, case when c_custkey % 3 < 2 then c_nationkey end as c_nationkey,
           case when c_custkey % 3 < 2 then c_acctbal end as c_acctbal, c_mktsegment
    from customer
    """
)
def csv_aligned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with columns in different order, missing and more than declared."""
    return read_aligned(spark, misaligned_customers(spark, sf_dir), CUSTOMER)[0].drop("SourceFileName")


@query("select 'too_few_values' as reject_reason, 'short ' || c_custkey || ',x' as line from customer where c_nationkey = 7")
def csv_aligned_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_aligned(spark, misaligned_customers(spark, sf_dir), CUSTOMER)[1].select("reject_reason", "line")


# Payloads.


@query("select event_id, json_extract_string(props, '$.k') as k from events")
def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    parsed = parse_payload("props", string_record(["k"]))
    return events.select("event_id", F.explode(parsed).alias("record")).select("event_id", "record.k")


@query(
    """
    select o_orderkey, cast(o_totalprice as varchar) as number, 'true' as flag, '{"z":[1,1.5]}' as nested,
           'second' as repeated, cast(null as varchar) as absent, cast(null as varchar) as other_case,
           '12345678901234567890123' as long_number
    from orders
    """
)
def json_text_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of numbers, flags, nested values and odd keys when every field is text."""
    payload = F.format_string(
        '[{"number":%s,"flag":true,"nested":{"z": [1, 1.50]},"repeated":"first","repeated":"second",'
        '"Other_Case":1,"unknown":2,"long_number":12345678901234567890123}]',
        F.col("o_totalprice").cast("string"),
    )
    names = ["number", "flag", "nested", "repeated", "absent", "other_case", "long_number"]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", payload.alias("payload"))
    return accepted(expand_records(orders, "payload", string_record(names)))


def two_record_payload(first: Column, second: Column) -> Column:
    return F.to_json(F.array(first, second))


def line_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload of two records for every line item."""
    payload = two_record_payload(
        F.struct(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("flag")),
        F.struct(F.col("l_suppkey").alias("id"), F.col("l_linestatus").alias("flag")),
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", payload.alias("payload"))


PAIR = string_record(["id", "flag"])


@query(
    """
    select l_orderkey, 2 as n, l_partkey || ',' || l_suppkey as ids, l_returnflag || ',' || l_linestatus as flags
    from lineitem
    """
)
def json_transpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = line_pairs(spark, sf_dir).select("l_orderkey", parse_payload("payload", PAIR).alias("parsed"))
    return transpose(parsed, "parsed", PAIR.fieldNames()).select(
        "l_orderkey",
        F.size("id").alias("n"),
        F.array_join("id", ",").alias("ids"),
        F.array_join("flag", ",").alias("flags"),
    )


PAIR_ROWS = """
    select l_orderkey, cast(l_partkey as varchar) as id, l_returnflag as flag from lineitem
    union all
    select l_orderkey, cast(l_suppkey as varchar) as id, l_linestatus as flag from lineitem
"""


@query(PAIR_ROWS, "zip_explode")
def zip_explode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = line_pairs(spark, sf_dir).select("l_orderkey", parse_payload("payload", PAIR).alias("parsed"))
    return zip_explode(transpose(parsed, "parsed", PAIR.fieldNames()), PAIR.fieldNames())


@query(
    """
    select o_orderkey, o_custkey as k, o_orderstatus as s from orders
    union all
    select o_orderkey, null as k, o_orderpriority as s from orders
    """
)
def zip_explode_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of different length."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.array("o_custkey").alias("k"), F.array("o_orderstatus", "o_orderpriority").alias("s")
    )
    return zip_explode(orders, ["k", "s"])


@query(PAIR_ROWS, "expand_records")
def expand_record_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(expand_records(line_pairs(spark, sf_dir), "payload", PAIR))


@query(
    """
    select l_orderkey, cast(l_partkey as varchar) as id, 0 as record_position from lineitem
    union all
    select l_orderkey, case when l_returnflag <> 'N' then cast(l_suppkey as varchar) end as id, 1 as record_position
    from lineitem
    """
)
def expand_null_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null element of the array is a row of nulls, not a reject."""
    second = F.when(F.col("l_returnflag") != "N", F.struct(F.col("l_suppkey").alias("id")))
    payload = two_record_payload(F.struct(F.col("l_partkey").alias("id")), second)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", payload.alias("payload"))
    expanded = expand_records(lines, "payload", string_record(["id"]))
    return expanded.where(F.col(POSITION).isNotNull()).select("l_orderkey", "id", POSITION)


@query(
    """
    with payloads as (
        select o_orderkey, o_orderpriority,
               case o_orderpriority
                   when '1-URGENT' then '[]'
                   when '3-MEDIUM' then '[{"id":' || o_orderkey || '},{"id":'
                   when '4-NOT SPECIFIED' then case o_orderstatus when 'P' then '5' when 'F' then '[1,2]' else '' end
                   when '5-LOW' then '{"id":' || o_orderkey || '}'
               end as payload
        from orders)
    select o_orderkey,
           case when o_orderpriority = '5-LOW' then cast(o_orderkey as varchar) end as id,
           case when o_orderpriority = '5-LOW' then 0 end as record_position,
           case o_orderpriority when '1-URGENT' then 'empty' when '2-HIGH' then 'missing' when '5-LOW' then null
                else 'malformed' end as reject_reason,
           case when o_orderpriority <> '5-LOW' then payload end as rejected_text
    from payloads
    """
)
def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good, empty, missing and broken payloads: every one is accounted for."""
    priority, key = F.col("o_orderpriority"), F.col("o_orderkey")
    scalar = F.when(F.col("o_orderstatus") == "P", "5").when(F.col("o_orderstatus") == "F", "[1,2]").otherwise("")
    payload = (
        F.when(priority == "1-URGENT", "[]")
        .when(priority == "3-MEDIUM", F.concat(F.lit('[{"id":'), key, F.lit('},{"id":')))
        .when(priority == "4-NOT SPECIFIED", scalar)
        .when(priority == "5-LOW", F.concat(F.lit('{"id":'), key, F.lit("}")))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", payload.alias("payload"))
    return expand_records(orders, "payload", string_record(["id"]))


SALVAGE = """
    with payloads as (
        select o_orderkey as k, o_orderkey % 6 as kind, '{"id":' || o_orderkey || ',"s":"a,]}[ \\\\" b"}' as one,
               ' {"id":' || o_custkey || ',"s":{"x":[1,{"y":2}]}}' as two, '{"id":null,"s":"' || o_orderstatus || '"}' as three
        from orders
    ), elements as (
        select k, kind, 0 as record_position, cast(k as varchar) as id, 'a,]}[ " b' as s from payloads
        union all select k, kind, 1, cast(o_custkey as varchar), '{"x":[1,{"y":2}]}' from payloads join orders on k = o_orderkey
        union all select k, kind, 2, null, o_orderstatus from payloads join orders on k = o_orderkey
    ), kept as (
        select * from elements where record_position < case kind when 0 then 3 when 1 then 1 when 2 then 2 when 3 then 3 when 4 then 1 else 0 end
    ), tails as (
        select k, case kind when 1 then left(two, 12) when 2 then ' nonsense' when 3 then '' when 4 then '{"id":},' || three || ']'
                   else '[' || left(one, 9) end as tail, if(kind = 5, 'malformed', 'broken_tail') as reason
        from payloads where kind > 0
    )
    select k as o_orderkey, record_position, id, s, cast(null as varchar) as reject_reason, cast(null as varchar) as rejected_text from kept
    union all select k, null, null, null, reason, tail from tails
"""


@query(SALVAGE)
def payload_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads broken in different places: complete elements before the break are rows, the rest is set aside."""
    one = F.format_string('{"id":%d,"s":"a,]}[ \\" b"}', "o_orderkey")
    two = F.format_string(' {"id":%d,"s":{"x":[1,{"y":2}]}}', "o_custkey")
    three = F.format_string('{"id":null,"s":"%s"}', "o_orderstatus")
    kind, opening, comma, closing = F.col("o_orderkey") % 6, F.lit("["), F.lit(","), F.lit("]")
    payload = (
        F.when(kind == 0, F.concat(opening, one, comma, two, comma, three, closing))
        .when(kind == 1, F.concat(opening, one, comma, F.substring(two, 1, 12)))
        .when(kind == 2, F.concat(opening, one, comma, two, F.lit(" nonsense")))
        .when(kind == 3, F.concat(opening, one, comma, two, comma, three))
        .when(kind == 4, F.concat(opening, one, comma, F.lit('{"id":},'), three, closing))
        .otherwise(F.concat(opening, F.substring(one, 1, 9)))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", payload.alias("payload"))
    return expand_records(orders, "payload", string_record(["id", "s"]), salvage=True)


def number_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of more digits than a double has, and a field of several types."""
    mixed = F.when(F.col("o_orderkey") % 3 == 0, "7").when(F.col("o_orderkey") % 3 == 1, '"seven"').otherwise("null")
    payload = F.format_string(
        '[{"id":%d,"price":%d.12345678901234567890,"long":123456789012345678901234567890,"mixed":%s},{"id":%d,"extra":{"x":1}}]',
        "o_orderkey", "o_orderkey", mixed, "o_custkey",
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", payload.alias("payload"))


@query(
    """
    select o_orderkey, o_orderkey as id, (o_orderkey || '.1234567890123456789')::decimal(38, 20)::varchar as price,
           '123456789012345678901234567890' as long, if(o_orderkey % 3 = 0, 7, null)::int as mixed, if(o_orderkey % 3 = 1, 'mixed', '') as unfit,
           0 as record_position
    from orders
    union all
    select o_orderkey, o_custkey, null, null, null, '', 1 from orders
    """
)
def json_exact_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values in their declared types at full precision; what does not fit is named."""
    types = {"id": "bigint", "price": "decimal(38,20)", "long": "string", "mixed": "int"}
    rows = expand_exact(number_payloads(spark, sf_dir), "payload", types)
    unfit = F.array_join("unfit_fields", ",").alias("unfit")
    return rows.select("o_orderkey", "id", F.col("price").cast("string").alias("price"), "long", "mixed", unfit, POSITION)


@query("select o_orderkey, 'price' as field, o_orderkey || '.1234567890123456789' as exact from orders")
def json_changed_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers that reading as text changes."""
    return changed_by_text(number_payloads(spark, sf_dir), "payload", ["id", "price", "long", "mixed"]).select("o_orderkey", "field", "exact")


@query(
    """
    with n as (select count(*) as n, count(*) filter (o_orderkey % 3 = 0) as a, count(*) filter (o_orderkey % 3 = 1) as b,
                      max(length(o_orderkey::varchar))::int as digits from orders)
    select 'id' as field, 'BIGINT' as kind, 2 * n as records, null::int as whole_digits, null::int as scale from n
    union all select 'price', 'DECIMAL', n, digits, 19 from n
    union all select 'long', 'DECIMAL', n, 30, 0 from n
    union all select 'extra', 'OBJECT', n, null, null from n
    union all select 'mixed', 'BIGINT', a, null, null from n
    union all select 'mixed', 'STRING', b, null, null from n
    union all select 'mixed', 'VOID', n - a - b, null, null from n
    """
)
def json_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which types the fields of all payloads have."""
    return inventory(number_payloads(spark, sf_dir), "payload")


@query(
    """
    with f as (select o_orderstatus as file, max(length(o_custkey::varchar)) as digits from orders group by 1)
    select file, 'id' as field, 'type' as change, 'BIGINT' as declared, 'STRING' as found from f where file = 'F'
    union all select file, 'cents', 'type', 'DECIMAL(4,2)', 'DECIMAL(' || digits + 3 || ',3)' from f
    union all select file, 'remark', 'new', null, 'OBJECT' from f where file = 'O'
    union all select file, 'remark', 'new', null, 'VARIANT' from f where file = 'P'
    union all select file, 'gone', 'missing', 'STRING', null from f where file <> 'P'
    """
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields by file that depart from the declared record; two halves of the payloads are profiled apart and merged."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    remark = F.when(status == "O", ',"remark":{"x":1}').when(status == "P", F.when(key % 2 == 0, ',"remark":[1],"gone":"x"').otherwise(',"remark":"y","gone":null'))
    whole = F.when(status == "F", F.concat(F.lit('"'), key.cast("string"), F.lit('"'))).otherwise(key.cast("string"))
    payload = F.concat(F.lit('[{"id":'), whole, F.lit(',"cents":'), F.col("o_custkey").cast("string"), F.lit(".125"), F.coalesce(remark, F.lit("")), F.lit("}]"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", status.alias("file"), payload.alias("payload"))
    halves = [profile(orders.where(half), "payload", by="file") for half in ("o_custkey % 2 = 0", "o_custkey % 2 <> 0")]
    declared = {"id": "BIGINT", "cents": "DECIMAL(4,2)", "gone": "STRING"}
    return drift(merged(halves, by="file"), declared, by="file")


NESTED_RECORD = (
    "array<struct<id: bigint, customer: struct<key: bigint, name: string>, lines: array<struct<part: bigint, tags: array<string>, "
    "stops: array<struct<at: string>>>>>>"
)


def nested_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the JSON text of orders with lines, tags and stops: null and empty arrays, two levels, null structs.

    A line's text is made once for both its places. The payload is exploded from an array of one, so that Spark compiles its
    projection: merged into that of ``from_json`` it would be interpreted value by value.
    """
    number = F.col("l_linenumber") % 3
    both = F.array(F.struct(F.date_format("l_shipdate", "yyyy-MM-dd").alias("at")), F.struct(F.lit(None).cast("string").alias("at")))
    stops = F.when(number == 0, both).when(number == 1, F.slice(both, 1, 0))
    tags = F.when(number != 2, F.array("l_returnflag", "l_linestatus"))
    line = F.to_json(F.struct(F.col("l_partkey").alias("part"), tags.alias("tags"), stops.alias("stops")), {"ignoreNullFields": "false"})
    order, supplier = (F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("l_orderkey", "l_suppkey"))
    customer = F.when(number != 0, F.concat(F.lit('{"key":'), supplier, F.lit(',"name":null}'))).otherwise("null")
    lines = F.when(number == 2, "").otherwise(F.concat_ws(",", "line", "line"))
    payload = F.concat(F.lit('[{"id":'), order, F.lit(',"customer":'), customer, F.lit(',"lines":['), lines, F.lit("]}]"))
    return table(spark, sf_dir, "lineitem").withColumn("line", line).select(F.explode(F.array(payload)).alias("payload"))


def nested_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nested payloads taken apart."""
    parsed = nested_payloads(spark, sf_dir).select(F.from_json("payload", NESTED_RECORD).alias("parsed"))
    return flatten(parsed, "parsed", work_folder(spark, "nested"))


@query(
    """
    select cast(l_orderkey as varchar) as id, l_linenumber % 3 <> 0 as has_customer,
           case when l_linenumber % 3 <> 0 then cast(l_suppkey as varchar) end as customer_key,
           case when l_linenumber % 3 = 2 then 0 else 2 end as lines_count
    from lineitem
    """
)
def nested_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = nested_tables(spark, sf_dir)["root"]
    id, customer = F.col("id").cast("string"), F.col("customer_key").cast("string")
    return root.select(id.alias("id"), F.col("customer_present").alias("has_customer"), customer.alias("customer_key"), "lines_count")


@query(
    """
    with two as (select * from lineitem, range(2) as r(p) where l_linenumber % 3 <> 2), n as (select *, l_linenumber % 3 as n from two)
    select cast(l_orderkey as varchar) as id, cast(p as int) as line_position, cast(l_partkey as varchar) as part,
           'tag' as kind, cast(q as int) as position, case q when 0 then l_returnflag else l_linestatus end as value
    from n, range(2) as s(q)
    union all
    select cast(l_orderkey as varchar), cast(p as int), cast(l_partkey as varchar), 'stop', cast(q as int), case when q = 0 then strftime(l_shipdate, '%Y-%m-%d') end
    from n, range(2) as s(q) where n = 0
    """
)
def nested_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of both levels, joined with their parents by the generated keys."""
    tables = nested_tables(spark, sf_dir)
    root = tables["root"].select(F.col("row_key").alias("parent_key"), "id")
    lines = tables["root_lines"].join(root, "parent_key")
    id, part = (F.col(c).cast("string").alias(c) for c in ("id", "part"))
    lines = lines.select(F.col("row_key").alias("parent_key"), id, F.col("position").alias("line_position"), part)
    tags, stops = tables["root_lines_tags"], tables["root_lines_stops"].withColumnRenamed("at", "value")
    below = [t.select("parent_key", F.lit(kind).alias("kind"), "position", "value") for t, kind in ((tags, "tag"), (stops, "stop"))]
    return lines.join(below[0].union(below[1]), "parent_key").drop("parent_key")


# Columns and names.


@query("select p_partkey as partkey, upper(p_name) as name, p_brand as brand, p_size + 1 as size from part")
def project_rename_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    dotted = part.withColumnsRenamed({c: c.replace("p_", "p.", 1) for c in part.columns})
    return (
        strip_prefix(dotted)
        .drop("type", "retailprice", "not_there")
        .withColumn("name", F.upper("name"))
        .withColumn("size", F.col("size") + F.lit(1))
    )


@query("select o_orderkey, string_split(o_orderpriority, '-')[2] as item from orders")
def split_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = name_token(F.col("o_orderpriority"), 1, "-")
    return table(spark, sf_dir, "orders").select("o_orderkey", item.alias("item"))


@query("select o_orderkey, string_split(o_orderpriority, '-')[6] as item from orders")
def split_item_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A position past the end is null, not an error."""
    item = name_token(F.col("o_orderpriority"), 5, "-")
    return table(spark, sf_dir, "orders").select("o_orderkey", item.alias("item"))


@query("select page_id, regexp_replace(url, '.example', '', 'g') as url from pages")
def regex_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", ".example", "").alias("url"))


@query("select distinct string_split(url, '/')[3] as host, string_split(url, '/')[4] as lang from pages")
def distinct_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    pages = table(spark, sf_dir, "pages")
    return pages.select(name_token(url, 2, "/").alias("host"), name_token(url, 3, "/").alias("lang")).distinct()


@query(
    """
    select strftime(o_orderdate, '%Y%m%d') as date_token, substr(o_orderpriority, 1, 1) as hour_token,
           'loads-' || strftime(o_orderdate, '%Y%m%d') || '-' || substr(o_orderpriority, 1, 1) || '.parquet' as target
    from orders where o_orderstatus <> 'P'
    order by 1 desc, 2 desc limit 1
    """,
    "batch_identity",
)
def batch_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest (date, hour) among files, some of which are not named well."""
    date = F.date_format("o_orderdate", "yyyyMMdd")
    hour = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("_"), F.substring("o_orderpriority", 1, 1)))
    hour = F.coalesce(hour, F.lit(""))
    name = F.concat(F.lit("s3a://a_b/c_d/erp_"), "o_orderkey", F.lit("_"), date, hour, F.lit(".xml"))
    identity = batch_identity(table(spark, sf_dir, "orders").select(name.alias("SourceFileName")))
    return identity.withColumn("target", target_name("loads", F.col("date_token"), F.col("hour_token")))


# Audit columns.


@query('select p_partkey, p_name, cast(count(*) over () as varchar) as "NumRows" from part')
def numrows_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The total, counted from the table's own row counts, as text on every row."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return stamp(part, "part", part.count()).select("p_partkey", "p_name", "NumRows")


@query(
    """
    select l_orderkey, l_linenumber, cast(count(*) over () as varchar) as "NumRows", '15-01-2024' as "ProcessedDate",
           timestamp '2024-01-15 10:30:00' as "ProcessedTime", 'erp' as "SourceName"
    from lineitem
    """
)
def audit_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return comparable(stamp(lineitem, "erp", lineitem.count(), RUN_TS))


@query("select count(*) as rows, count(*) as dated_today, 1 as times, 'orders' as source from orders")
def audit_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the real clock: one processing time for the whole write, and its date as text."""
    orders = table(spark, sf_dir, "orders")
    stamped = stamp(orders, "orders", orders.count())
    today = F.date_format("ProcessedTime", "dd-MM-yyyy") == F.col("ProcessedDate")
    return stamped.agg(
        F.count("*").alias("rows"),
        F.count_if(today).alias("dated_today"),
        F.countDistinct("ProcessedTime").cast("int").alias("times"),
        F.max("SourceName").alias("source"),
    )


@query("select o_orderkey, strftime(o_orderdate, '%d-%m-%Y') as order_date from orders")
def date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.date_format("o_orderdate", "dd-MM-yyyy").alias("order_date"))


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    return df.withColumn("ProcessedTime", F.col("ProcessedTime").cast("timestamp_ntz"))


# Sinks.


@query("select * from orders")
def parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "sink")
    write_layer(table(spark, sf_dir, "orders"), path)
    return spark.read.parquet(path)


@query("select * from customer")
def format_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The format is a parameter."""
    path = work_folder(spark, "sink")
    write_layer(table(spark, sf_dir, "customer"), path, fmt="orc")
    return spark.read.orc(path)


@query("select * from orders")
def overwrite_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "sink")
    for _ in range(2):
        write_layer(table(spark, sf_dir, "orders"), path)
    return spark.read.parquet(path)


@query(
    """
    with n as (select count(*) as n from orders)
    select 'overwrite' as mode, 0 as status, n as written, n as rows from n
    union all select 'append', 0, n, 2 * n from n
    union all select 'ignore', 0, 0, n from n
    union all select 'errorifexists', 1, null, n from n
    """
)
def save_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write of the same rows in each mode: its status, its row count, and the table after it."""
    orders = table(spark, sf_dir, "orders")
    results = []
    for mode in ("overwrite", "append", "ignore", "errorifexists"):
        path = work_folder(spark, "sink")
        write_layer(orders, path)
        second = write_layer(orders, path, mode=mode, raise_errors=False)
        results.append(
            spark.read.parquet(path)
            .agg(F.count("*").alias("rows"))
            .select(
                F.lit(mode).alias("mode"),
                F.lit(second.status).alias("status"),
                F.lit(second.rows).cast("bigint").alias("written"),
                "rows",
            )
        )
    return results[0].unionByName(results[1]).unionByName(results[2]).unionByName(results[3])


@query("select cast(ceil(count(*) / 5000.0) as bigint) as files, count(*) as n from orders")
def sized_files_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many files as the rows need; a batch that fits in one file gets one."""
    orders = table(spark, sf_dir, "orders")
    path = work_folder(spark, "sink")
    write_layer(orders, path, files=math.ceil(orders.count() / 5000))
    return spark.read.parquet(path).select("_metadata.file_path").agg(
        F.countDistinct("file_path").alias("files"), F.count("*").alias("n")
    )


@query(
    """
    select 1 as version, count(*) as rows, sum(o_orderkey)::bigint as keys from orders
    union all select 2, count(*), sum(o_orderkey)::bigint from orders where o_orderstatus <> 'P'
    union all select 3, count(*), sum(o_orderkey)::bigint from orders
    """
)
def atomic_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions, a write that its audit refuses, a write from an old version, and the first version restored."""
    path, orders = work_folder(spark, "versions"), table(spark, sf_dir, "orders")
    publish(orders, path)
    publish(orders.where("o_orderstatus <> 'P'"), path, base=1)

    def no_open_orders(written: DataFrame) -> None:
        if not written.where("o_orderstatus = 'O'").isEmpty():
            raise AuditFailed("open orders")

    for refused in ({"audit": no_open_orders}, {"base": 1}):
        try:
            publish(orders.where("o_orderstatus = 'O'"), path, **refused)
        except (AuditFailed, VersionConflict):
            continue
        raise AssertionError("published what should have been refused")
    restore(spark, path, 1)
    found = [
        read_version(spark, path, v.number).agg(F.lit(v.number).alias("version"), F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"))
        for v in versions(spark, path)
    ]
    return found[0].union(found[1]).union(found[2])


@query("select count(*) as n, sum(o_orderkey)::bigint as keys, 5::bigint as files from orders")
def byte_sized_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skewed files rewritten to files of a fifth of the table's bytes."""
    orders, path, out = table(spark, sf_dir, "orders"), work_folder(spark, "skewed"), work_folder(spark, "resized")
    write_layer(orders.where("o_orderkey % 10 > 0").coalesce(1), path)
    write_layer(orders.where("o_orderkey % 10 = 0").repartition(20), path, mode="append")
    target = sum(sizes(spark, path, ".parquet").values()) // 5
    resize(spark, path, out, target)
    file = F.col("_metadata.file_path").alias("file")
    rows = spark.read.parquet(out).select("o_orderkey", file)
    return rows.agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.countDistinct("file").alias("files"))


@query("select 0 as status, count(*) as n from orders")
def write_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome code and the row count, both from the write itself."""
    orders = table(spark, sf_dir, "orders")
    path = work_folder(spark, "sink")
    result = write_layer(orders, path)
    return spark.read.parquet(path).agg(
        F.lit(result.status).alias("status"), F.any_value(F.lit(result.rows)).cast("bigint").alias("n")
    )


@query("select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 20")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy("o_orderkey").limit(20)


@query(
    """
    with ranked as (
        select o_orderpriority, o_orderkey, row_number() over (partition by o_orderpriority order by md5('{"c0":"' || o_orderkey || '"}'))::int as sample_place
        from orders
    )
    select * from ranked where sample_place <= 10
    """
)
def file_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten orders of each priority, from samples of two halves."""
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey")
    halves = [sample_per(orders.where(half), "o_orderpriority", 10, ["o_orderkey"]) for half in ("o_custkey % 2 = 0", "o_custkey % 2 <> 0")]
    return sample_per(halves[0].union(halves[1]), "o_orderpriority", 10, ["o_orderkey"])


@query(
    """
    with cells as (
        select l_returnflag, field, value from (
            select l_returnflag, l_partkey::double as l_partkey, l_extendedprice::double as l_extendedprice, l_quantity::double as l_quantity from lineitem
        ) unpivot include nulls (value for field in (l_partkey, l_extendedprice, l_quantity))
    )
    select l_returnflag, field, count(*) as n_rows, count(*) - count(value) as n_nulls, min(value) as least, max(value) as greatest,
           true as distinct_near, true as median_near, true as same_merged
    from cells group by all
    """
)
def profile_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles by group, of the whole and merged from halves, with their estimates held against exact figures."""
    fields = ["l_partkey", "l_extendedprice", "l_quantity"]
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", *fields, "l_orderkey")
    whole = estimated(column_profile(items, ["l_returnflag"], fields), [0.5])
    halves = [column_profile(items.where(half), ["l_returnflag"], fields) for half in ("l_orderkey % 2 = 0", "l_orderkey % 2 <> 0")]
    merged = estimated(merged_profiles(halves[0].union(halves[1]), ["l_returnflag"]), [0.5])
    exact = items.select("l_returnflag", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value")) for c in fields])).alias("cell"))
    exact = exact_figures(exact.select("l_returnflag", "cell.*"), ["l_returnflag", "field"], "value", [0.45, 0.55], work_folder(spark, "exact-figures"))
    exact = exact.select("l_returnflag", "field", F.col("n_distinct").alias("n"), F.col("quantiles").alias("middle"))
    key = ["l_returnflag", "field"]
    again = merged.select(*key, *[F.col(c).alias(f"m_{c}") for c in ("n_rows", "n_nulls", "least", "greatest", "n_distinct", "quantiles")])
    exactly = [F.col(c).eqNullSafe(F.col(f"m_{c}")) for c in ("n_rows", "n_nulls", "least", "greatest")]
    near = lambda c: F.abs(F.col(c) - F.col("n")) <= F.greatest(F.lit(1), F.col("n") * 0.08)
    middle = lambda c: F.get(F.col(c), 0).between(F.get("middle", 0), F.get("middle", 1))
    joined = whole.join(again, key).join(exact, key)
    return joined.select(
        *key, "n_rows", "n_nulls", F.col("least").cast("double").alias("least"), F.col("greatest").cast("double").alias("greatest"),
        near("n_distinct").alias("distinct_near"), middle("quantiles").alias("median_near"),
        (near("m_n_distinct") & middle("m_quantiles") & exactly[0] & exactly[1] & exactly[2] & exactly[3]).alias("same_merged"),
    )


# Whole loads.


@query(
    f"""
    select {LOAD_COLUMNS}, cast(count(*) over () as varchar) as "NumRows", '15-01-2024' as "ProcessedDate",
           timestamp '2024-01-15 10:30:00' as "ProcessedTime", 'erp' as "SourceName",
           'listaCargas-' || max(strftime(l_shipdate, '%Y')) over () || '-10.parquet' as batch
    from lineitem
    """
)
def bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing XML to bronze parquet, with audit columns and the batch's name."""
    spec = loads_spec(loads_landing(spark, sf_dir), work_folder(spark, "bronze"), "erp")
    result = load_batch(spark, spec, RUN_TS)
    loaded = comparable(with_file_tokens(spark.read.parquet(result.path)))
    return loaded.withColumn("batch", F.lit(result.path.rsplit("/", 1)[-1]))


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as load records; the year is the file's date token."""
    record = F.to_json(F.struct(F.col("o_orderkey").alias("t10_id"), F.col("o_custkey").alias("t06_id")))
    return table(spark, sf_dir, "orders").select(
        record.alias("record"),
        F.date_format("o_orderdate", "yyyy").alias("date_token"),
        F.lit("10").alias("hour_token"),
        "o_orderstatus",
    )


@query(
    """
    select strftime(o_orderdate, '%Y') as file_date, count(*) filter (o_orderstatus <> 'P') as loaded,
           count(*) filter (o_orderstatus <> 'P') as cleaned, count(*) filter (o_orderstatus = 'P') as still_landed
    from orders group by 1
    """
)
def landing_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are in bronze are deleted; files that arrived meanwhile stay."""
    landing = work_folder(spark, "landing")
    records = order_records(spark, sf_dir)
    write_landing(records.where("o_orderstatus <> 'P'"), landing, prefix="early")
    spec = loads_spec(landing, work_folder(spark, "bronze"), "erp")
    result = load_batch(spark, spec, RUN_TS)
    write_landing(records.where("o_orderstatus = 'P'"), landing, prefix="late")
    files = delete_loaded(spark, result.files, work_folder(spark, "deletions"))

    def per_date(df: DataFrame, rows: Column, name: str) -> DataFrame:
        return with_file_tokens(df).groupBy("file_date").agg(F.sum(rows).alias(name))

    left = expand(scan(spark, spec), spec)
    return (
        per_date(spark.read.parquet(result.path), F.lit(1), "loaded")
        .join(per_date(files.where("outcome = 'deleted'"), F.col("records"), "cleaned"), "file_date")
        .join(per_date(left, F.lit(1), "still_landed"), "file_date")
    )


@query(
    """
    with years as (select strftime(o_orderdate, '%Y') as file_date, o_orderstatus from orders)
    select file_date, count(*) as loaded,
           count(*) filter (o_orderstatus = 'P' or file_date = (select max(file_date) from years)) as cleaned
    from years group by 1
    """
)
def reload_after_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch loads, loses landed files as to a broken clean-up, and loads again: bronze stays, the rest is cleaned."""
    landing, records = work_folder(spark, "landing"), order_records(spark, sf_dir)
    write_landing(records.where("o_orderstatus <> 'P'"), landing, prefix="lost")
    write_landing(records.where("o_orderstatus = 'P'"), landing, prefix="left")
    spec = loads_spec(landing, work_folder(spark, "bronze"), "erp")
    first = load_batch(spark, spec, RUN_TS)
    last = F.split_part(F.lit(first.path.rsplit("/", 1)[-1]), F.lit("-"), F.lit(2))
    name = file_name("SourceFileName")
    early = first.files.where(name.startswith("lost") & (name_token(name, 2) < last))
    delete_loaded(spark, early, work_folder(spark, "lost"))
    second = load_batch(spark, spec, RUN_TS, clean=True)

    def per_date(df: DataFrame, rows: Column, name: str) -> DataFrame:
        return with_file_tokens(df).groupBy("file_date").agg(F.sum(rows).alias(name))

    cleaned = per_date(second.files.where("outcome = 'deleted'"), F.col("records"), "cleaned")
    joined = per_date(spark.read.parquet(first.path), F.lit(1), "loaded").join(cleaned, "file_date", "left")
    return joined.withColumn("cleaned", F.coalesce("cleaned", F.lit(0).cast("long")))


@query(
    """
    select case when o_orderstatus = 'P' then 'bad_file_name' else 'loaded' end as disposition,
           count(*) filter (o_orderstatus <> 'P') as records, count(*) filter (o_orderstatus = 'P') as rejects
    from orders group by 1
    """
)
def file_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every landed file; payloads of badly named files are set aside, not lost."""
    landing = work_folder(spark, "landing")
    records = order_records(spark, sf_dir)
    write_landing(records.where("o_orderstatus <> 'P'"), landing, prefix="good")
    write_landing(records.where("o_orderstatus = 'P'").drop("hour_token"), landing, prefix="bad", per_payload=1)
    result = load_batch(spark, loads_spec(landing, work_folder(spark, "bronze"), "erp"), RUN_TS)
    return result.files.groupBy("disposition").agg(F.sum("records").alias("records"), F.sum("rejects").alias("rejects"))


@query(
    """
    with n as (select count(*) filter (o_orderstatus <> 'P') as early, count(*) filter (o_orderstatus = 'P') as late from orders)
    select 'first' as load, early as rows, 0::bigint as still_landed from n
    union all select 'renamed', 0::bigint, 0::bigint from n
    union all select 'renamed and new', late, 0::bigint from n
    """
)
def resent_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is landed again under other names loads no row and is cleaned; new files beside it load."""
    landing, records = work_folder(spark, "landing"), order_records(spark, sf_dir)
    spec = loads_spec(landing, work_folder(spark, "bronze"), "erp", fingerprints=True, mode="append")
    early, late, told = records.where("o_orderstatus <> 'P'"), records.where("o_orderstatus = 'P'"), []
    for name, drops in (("first", [("early", early)]), ("renamed", [("again", early)]), ("renamed and new", [("oncemore", early), ("late", late)])):
        for prefix, rows in drops:
            write_landing(rows, landing, prefix=prefix)
        result = load_batch(spark, spec, RUN_TS, clean=True)
        left = spark.read.format("binaryFile").load(landing).select("path")
        told.append(left.agg(F.lit(name).alias("load"), F.lit(result.rows).cast("bigint").alias("rows"), F.count("*").alias("still_landed")))
    return told[0].union(told[1]).union(told[2])


@query(f"select {LOAD_COLUMNS}, 'erp' as \"SourceName\" from lineitem")
def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of files, each loaded once by a stream that runs when called."""
    landing, bronze = work_folder(spark, "landing"), work_folder(spark, "bronze")
    spec, checkpoint = loads_spec(landing, bronze, "erp"), work_folder(spark, "stream")
    records = load_records(table(spark, sf_dir, "lineitem"))
    for prefix, drop in (("early", "l_returnflag <> 'N'"), ("late", "l_returnflag = 'N'")):
        write_landing(records.where(drop), landing, prefix=prefix)
        load_stream(spark, spec, checkpoint, RUN_TS).awaitTermination()
    loaded = spark.read.option("recursiveFileLookup", True).parquet(bronze)
    return with_file_tokens(loaded).drop("NumRows", "ProcessedDate", "ProcessedTime")


@query(
    """
    with arrivals as (
        select event_type as entity, date_trunc('hour', ts) as slot,
               ts + case when event_id % 20 = 0 then interval 3 hour else interval 0 hour end as landed_at
        from events
    ),
    clock as (select date_trunc('milliseconds', max(landed_at)) - interval 10 minute as mark from arrivals),
    in_time as (select distinct entity, slot from arrivals where landed_at <= slot + interval 2 hour),
    span as (
        select entity, unnest(generate_series(first, mark, interval 1 hour)) as slot
        from (select entity, min(slot) as first from in_time group by 1), clock
    )
    select entity, slot, 'absent' as status, null::timestamp as landed_at
    from span, clock where slot + interval 2 hour < mark and not exists (from in_time t where t.entity = span.entity and t.slot = span.slot)
    union all
    select entity, slot, 'late', landed_at from arrivals where landed_at > slot + interval 2 hour
    """
)
def missing_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours without an event of a type, and events after their hour's time, by a stream that runs twice."""
    landing, report, checkpoint = work_folder(spark, "arrivals"), work_folder(spark, "slots"), work_folder(spark, "stream")
    delayed = F.col("ts") + F.when(F.col("event_id") % 20 == 0, F.expr("interval 3 hours")).otherwise(F.expr("interval 0 hours"))
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("entity"), F.date_trunc("hour", "ts").cast("timestamp").alias("slot"), delayed.cast("timestamp").alias("landed_at")
    )
    for drop in ("landed_at < '2024-01-16'", "not landed_at < '2024-01-16'"):
        events.where(drop).write.mode("append").parquet(landing)
        arrivals = spark.readStream.schema(events.schema).parquet(landing)
        sink = slot_report(arrivals, grace=timedelta(hours=1)).writeStream.format("parquet").option("path", report)
        sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    told = spark.read.schema(RESULT).parquet(report)
    return told.select("entity", F.col("slot").cast("timestamp_ntz"), "status", F.col("landed_at").cast("timestamp_ntz"))
