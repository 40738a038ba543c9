"""Payload values in their own types, at full precision, and what types a payload's fields really have."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from landfall.functions.payload import parse_payload, reject_reason, string_record

POSITION = "record_position"
REASON = "reject_reason"
REJECTED_TEXT = "rejected_text"
UNFIT = "unfit_fields"
ARRAY = "array<variant>"


def kind(value: Column) -> Column:
    """The type of a variant without its parameters: ``OBJECT``, ``DECIMAL``, ``VOID`` for a JSON null, ..."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def variants(payload: Column) -> Column:
    """A payload's records as variants; null when it is no array of objects and nulls, and no single object.

    The same payloads as ``parse_payload`` are malformed, and besides those in which an object repeats a key: a variant
    has one value for a key. Numbers of up to 38 digits keep all of them; longer ones, and any with an exponent, are doubles.
    """
    whole = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), payload, F.lit("]"))), "$", ARRAY)

    def listed(found: Column) -> Column:
        first = F.get(found, 0)
        is_object = kind(first) == "OBJECT"
        records = F.when(is_object, F.array(first)).when(kind(first) == "ARRAY", F.try_variant_get(first, "$", ARRAY))
        return F.when(F.size(found) == 1, records)

    def only_records(found: Column) -> Column:
        return F.when(F.forall(found, lambda v: v.isNull() | kind(v).isin("OBJECT", "VOID")), found)

    # Through lambdas, so that the text is parsed once.
    records = F.get(F.transform(F.array(whole), listed), 0)
    return F.get(F.transform(F.array(records), only_records), 0)


def path(name: str) -> str:
    """A field of an object as a variant path."""
    if '"' in name or "\\" in name:
        raise ValueError(f"a field named {name} has no path")
    return f'$["{name}"]'


def expand_exact(df: DataFrame, payload: str, types: Mapping[str, str]) -> DataFrame:
    """One row per record with each field in its declared type, and one row per payload without records.

    ``types`` maps fields to types: ``decimal(38,18)``, ``bigint``, ``boolean``, ``string``, ``array<...>``, ``variant``, ... A value
    that its type cannot hold is null, and its field is named in ``unfit_fields``, so no value is lost unseen. A number read
    as a string keeps all its digits. Like ``expand_records``: the payload's text is parsed once and replaced by the
    fields, the record's position, the reason and text of a payload without records; no shuffle, no Python.
    """
    clash = {POSITION, REASON, REJECTED_TEXT, UNFIT, "parsed", "record"} & {*types, *(c for c in df.columns if c != payload)}
    if clash or {c for c in df.columns if c != payload} & set(types):
        raise ValueError(f"columns collide: {sorted(clash or set(df.columns) & set(types))}")
    rest = [c for c in df.columns if c != payload]
    text, record = F.col(payload), F.col("record")
    told = df.select(*rest, text, variants(text).alias("parsed"))
    told = told.select(*rest, text, reject_reason(text, F.col("parsed")).alias(REASON), "parsed")
    rows = told.select(*rest, REASON, F.when(F.col(REASON).isNotNull(), text).alias(REJECTED_TEXT), F.posexplode_outer("parsed").alias(POSITION, "record"))
    values = {f: F.try_variant_get(record, path(f), t) for f, t in types.items()}
    raw = {f: F.try_variant_get(record, path(f), "variant") for f in types}
    unfit = [F.when(values[f].isNull() & raw[f].isNotNull() & (kind(raw[f]) != "VOID"), F.lit(f)) for f in types]
    named = F.when(F.col(POSITION).isNotNull(), F.array_compact(F.array(*unfit))).alias(UNFIT)
    return rows.select(*rest, *[v.alias(f) for f, v in values.items()], named, POSITION, REASON, REJECTED_TEXT)


def changed_by_text(df: DataFrame, payload: str, fields: Sequence[str]) -> DataFrame:
    """``(..., record_position, field, as_text, exact)``: the numbers that reading as text changes, with all their digits."""
    rest = [c for c in df.columns if c != payload]
    record = string_record(fields)
    both = df.select(*rest, F.arrays_zip(parse_payload(payload, record).alias("texts"), variants(F.col(payload)).alias("exact")).alias("both"))
    rows = both.select(*rest, F.posexplode("both").alias(POSITION, "one"))
    value = {f: F.try_variant_get(F.col("one.exact"), path(f), "variant") for f in fields}
    pairs = [
        F.struct(F.lit(f).alias("field"), F.col("one.texts")[f].alias("as_text"), F.try_variant_get(F.col("one.exact"), path(f), "string").alias("exact"), kind(value[f]).alias("kind"))
        for f in fields
    ]
    told = rows.select(*rest, POSITION, F.inline(F.array(*pairs)))
    return told.filter(F.col("kind").isin("DECIMAL", "BIGINT", "DOUBLE") & ~F.col("as_text").eqNullSafe(F.col("exact"))).drop("kind")


def inventory(df: DataFrame, payload: str) -> DataFrame:
    """``(field, kind, records, whole_digits, scale)``: which types a payload's fields have, declared or not.

    ``kind`` is the JSON value's type, ``VOID`` for null; a field of several kinds has a row for each. For decimals the digits
    before and after the point that hold all values are given. Malformed payloads do not count. Counts are partial sums
    before the shuffle, whose rows are fields, not records.
    """
    records = df.select(F.explode(variants(F.col(payload))).alias("record"))
    fields = records.select(F.explode(F.try_variant_get("record", "$", "map<string, variant>")).alias("field", "value"))
    shape = F.schema_of_variant("value")
    told = fields.select("field", F.regexp_extract(shape, "^[A-Z]+", 0).alias("kind"), F.regexp_extract(shape, r"^DECIMAL\((\d+),", 1).alias("p"), F.regexp_extract(shape, r"^DECIMAL\(\d+,(\d+)\)", 1).alias("s"))
    digits, scale = F.expr("try_cast(p as int) - try_cast(s as int)"), F.expr("try_cast(s as int)")
    return told.groupBy("field", "kind").agg(F.count("*").alias("records"), F.max(digits).alias("whole_digits"), F.max(scale).alias("scale"))
