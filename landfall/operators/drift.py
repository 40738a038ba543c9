"""Which types payload fields have, file by file, merged over batches and compared with what is declared.

A profile counts the values of each field by kind. Counts add up and digits take their maximum, so profiles of files, tasks and
batches merge in any order. A field's type is the least one of a lattice that holds all values counted:
``VOID`` below everything; ``BIGINT``, ``DECIMAL(p,s)`` and ``DOUBLE`` in that order; numbers, ``BOOLEAN`` and ``STRING``
together are ``STRING``; and ``VARIANT`` holds objects or arrays beside anything else.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landfall.functions.exact import variants

FIELD = "field"
#: Counted kinds, by what a variant calls them.
KINDS = {"nulls": "VOID", "booleans": "BOOLEAN", "whole": "BIGINT", "decimals": "DECIMAL", "doubles": "DOUBLE", "strings": "STRING", "objects": "OBJECT", "arrays": "ARRAY"}
DIGITS = ("whole_digits", "scale")
NEW, MISSING, TYPE = "new", "missing", "type"


def profile(df: DataFrame, payload: str, by: str = "SourceFileName") -> DataFrame:
    """A row per ``by`` and field with counts by kind and digits; ``field`` null counts the records themselves.

    Malformed payloads have no records. Values are summed up within tasks before the shuffle, whose rows are fields.
    """
    records = df.select(by, F.explode(variants(F.col(payload))).alias("record"))
    fields = F.try_variant_get("record", "$", "map<string, variant>")
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))
    entries = F.map_entries(F.coalesce(fields, empty))
    own = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("value")))
    values = records.select(by, F.inline(F.concat(own, entries))).select(by, F.col("key").alias(FIELD), F.col("value"))
    shape = F.schema_of_variant("value")
    kind, text = F.regexp_extract(shape, "^[A-Z]+", 0), F.try_variant_get("value", "$", "string")
    whole = F.when(kind.isin("BIGINT", "DECIMAL"), F.length(F.regexp_extract(text, r"^-?0*(\d*)", 1)))
    scale = F.when(kind == "DECIMAL", F.length(F.regexp_extract(text, r"\.(\d+)$", 1))).when(kind == "BIGINT", F.lit(0))
    told = values.select(by, FIELD, kind.alias("kind"), whole.alias("whole_digits"), scale.alias("scale"))
    counts = [F.count_if(F.col("kind") == name).alias(c) for c, name in KINDS.items()]
    known = list(KINDS.values())
    other = F.count_if(F.col(FIELD).isNotNull() & ~F.col("kind").isin(known)).alias("others")
    return told.groupBy(by, FIELD).agg(F.count("*").alias("records"), *counts, other, *[F.max(d).alias(d) for d in DIGITS])


def merged(profiles: list[DataFrame], by: str | None = "SourceFileName") -> DataFrame:
    """One profile of several; without ``by``, of all files together."""
    union = reduce(DataFrame.unionByName, profiles)
    keys = [by, FIELD] if by else [FIELD]
    sums = [F.sum(c).alias(c) for c in ("records", *KINDS, "others")]
    return union.groupBy(*keys).agg(*sums, *[F.max(d).alias(d) for d in DIGITS])


def least_type() -> Column:
    """The type of a profile's row."""
    some = lambda *names: reduce(Column.__or__, [F.col(n) > 0 for n in names])
    digits, scale = F.coalesce("whole_digits", F.lit(0)), F.coalesce("scale", F.lit(0))
    precision = F.greatest(F.lit(1), digits + scale)
    numbers, scalars = ("whole", "decimals", "doubles"), ("booleans", "whole", "decimals", "doubles", "strings")
    exact = F.when(precision <= 38, F.format_string("DECIMAL(%d,%d)", precision, scale)).otherwise("DOUBLE")
    return (
        F.when(some("others") | (some("objects", "arrays") & some(*scalars)) | (some("objects") & some("arrays")), "VARIANT")
        .when(some("objects"), "OBJECT")
        .when(some("arrays"), "ARRAY")
        .when(some("strings") | (some("booleans") & some(*numbers)), "STRING")
        .when(some("booleans"), "BOOLEAN")
        .when(some("doubles"), "DOUBLE")
        .when(some("decimals"), exact)
        .when(some("whole"), "BIGINT")
        .otherwise("VOID")
    )


def declared_profile(spark: SparkSession, declared: Mapping[str, str]) -> DataFrame:
    """The declared fields as a profile of one value each, so that comparing is merging."""
    rows = []
    for name, kind in declared.items():
        match = re.fullmatch(r"([A-Z]+)(?:\((\d+),(\d+)\))?", kind.upper().replace(" ", ""))
        column = next((c for c, k in KINDS.items() if match and k == match[1]), None)
        if column is None and not (match and match[1] == "VARIANT") or (column == "decimals") != bool(match and match[2]):
            raise ValueError(f"{kind} of {name} is no type of the lattice")
        digits = (int(match[2]) - int(match[3]), int(match[3])) if match[2] else (0, 0) if column == "whole" else (None, None)
        rows.append((name, *[int(c == column) for c in KINDS], int(column is None), *digits))
    schema = f"{FIELD} string, {', '.join(f'{c} long' for c in KINDS)}, others long, whole_digits int, scale int"
    return spark.createDataFrame(rows, schema)


def drift(found: DataFrame, declared: Mapping[str, str], by: str = "SourceFileName") -> DataFrame:
    """``(by, field, change, declared, found)``: where a file's fields depart from the declared record.

    ``new``: a field that is not declared. ``missing``: a declared field that no record of the file has. ``type``: values that
    the declared type does not hold; ``found`` is then the least type that holds them. Nulls fit any type. Files without
    records have no rows. The declared record is broadcast: it is a list of fields.
    """
    spark = found.sparkSession
    wanted = declared_profile(spark, declared)
    kinds = wanted.select(FIELD, least_type().alias("declared"))
    fields = found.filter(F.col(FIELD).isNotNull())
    have = fields.withColumn("found", least_type()).join(F.broadcast(kinds), FIELD, "left")
    added = wanted.select(FIELD, *[F.col(c).alias(f"own_{c}") for c in (*KINDS, "others", *DIGITS)])
    both = have.filter("declared is not null").join(F.broadcast(added), FIELD)
    sums = {c: F.col(c) + F.col(f"own_{c}") for c in (*KINDS, "others")}
    most = {d: F.greatest(d, f"own_{d}") for d in DIGITS}
    wider = both.withColumns({**sums, **most}).filter(least_type() != F.col("declared"))
    new = have.filter("declared is null").select(by, FIELD, F.lit(NEW).alias("change"), "declared", "found")
    changed = wider.select(by, FIELD, F.lit(TYPE).alias("change"), "declared", "found")
    files = found.filter(F.col(FIELD).isNull()).select(by)
    fixed = [F.struct(F.lit(n).alias(FIELD), F.lit(k.upper().replace(" ", "")).alias("declared")) for n, k in declared.items()]
    due = files.select(by, F.inline(F.array(*fixed))) if fixed else files.select(by, F.lit("").alias(FIELD), F.lit("").alias("declared")).limit(0)
    absent = due.join(fields.select(by, FIELD), [by, FIELD], "left_anti")
    return new.union(changed).union(absent.select(by, FIELD, F.lit(MISSING).alias("change"), "declared", F.lit(None).cast("string").alias("found")))
