"""From payload text to one row per record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from landfall.functions.payload import BROKEN_TAIL, MALFORMED, parse_payload, reject_reason
from landfall.functions.salvage import salvaged
from landfall.session import importable

REASON = "reject_reason"
REJECTED_TEXT = "rejected_text"
POSITION = "record_position"


def expand_records(
    df: DataFrame, payload: str, record: T.StructType, known_reason: str | None = None, salvage: bool = False
) -> DataFrame:
    """One row per record of the payload, and one row for each payload that has none.

    Replaces ``payload`` by the record's fields, the record's position in its payload, and, for a
    payload without rows, the reason and the whole text. A null element of the array is a row of
    nulls. ``known_reason`` names a column that already rules out a row (say, a broken document);
    its payload is not parsed.

    One parse, no shuffle. Reason and text are settled before the explode, so neither the parsed
    array nor a good payload's text is copied onto the rows it produces.

    With ``salvage`` a malformed payload gives the records before its break, and one row for the rest of it, with reason
    ``broken_tail`` and that text; if nothing comes before the break it is malformed as a whole. Only malformed payloads
    pass through Python.
    """
    rest = [c for c in df.columns if c not in (payload, known_reason)]
    known = F.col(known_reason) if known_reason else F.lit(None).cast("string")
    text, parsed = F.col(payload), F.col("parsed")
    parse = parse_payload(F.when(known.isNull(), text), record)
    if salvage:
        importable(df.sparkSession)
        judged = df.select(*rest, text, known.alias("known"), parse.alias("parsed"))
        judged = judged.select(*rest, text, F.coalesce("known", reject_reason(text, parsed)).alias(REASON), parsed)
        return _salvage(judged, rest, text, record)
    return (
        df.select(*rest, text, known.alias("known"), parse.alias("parsed"))
        .select(*rest, text, F.coalesce("known", reject_reason(text, parsed)).alias(REASON), parsed)
        .select(*rest, REASON, F.when(F.col(REASON).isNotNull(), text).alias(REJECTED_TEXT), parsed)
        .select(*rest, REASON, REJECTED_TEXT, F.posexplode_outer(parsed).alias(POSITION, "record"))
        .select(*rest, "record.*", POSITION, REASON, REJECTED_TEXT)
    )


def _salvage(judged: DataFrame, rest: Sequence[str], text: Column, record: T.StructType) -> DataFrame:
    left, reason = F.col("left"), F.col(REASON)
    found = judged.select("*", salvaged(F.when(reason == MALFORMED, text), record).alias("left"))
    rescued = F.coalesce(F.size(left["records"]) > 0, F.lit(False))
    told = found.select(
        *rest,
        F.when(rescued, F.lit(BROKEN_TAIL)).otherwise(reason).alias(REASON),
        F.when(rescued, left["tail"]).when(reason.isNotNull(), text).alias(REJECTED_TEXT),
        F.when(rescued, left["records"]).otherwise(F.col("parsed")).alias("parsed"),
    )
    one = F.transform("parsed", lambda r, i: F.struct(i.alias(POSITION), r.alias("record")))
    none = F.array(F.struct(F.lit(None).cast("int").alias(POSITION), F.lit(None).cast(record).alias("record")))
    rows = F.concat(F.coalesce(one, F.slice(none, 1, 0)), F.slice(none, F.lit(1), F.when(reason.isNotNull(), 1).otherwise(0)))
    set_aside = F.col(POSITION).isNull()
    return told.select(*rest, REASON, REJECTED_TEXT, F.inline(rows)).select(
        *rest,
        "record.*",
        POSITION,
        F.when(set_aside, reason).alias(REASON),
        F.when(set_aside, F.col(REJECTED_TEXT)).alias(REJECTED_TEXT),
    )


# Both sides are told apart by the position, which exists only after the explode. A filter on the
# reason would be pushed below it and parse every payload again to find the reason.


def accepted(expanded: DataFrame) -> DataFrame:
    """The record rows of an expanded frame."""
    return expanded.where(F.col(POSITION).isNotNull()).drop(REASON, REJECTED_TEXT, POSITION)


def rejected(expanded: DataFrame, *keys: str) -> DataFrame:
    """The set-aside payloads of an expanded frame: keys, reason and whole text."""
    return expanded.where(F.col(POSITION).isNull()).select(*keys, REASON, REJECTED_TEXT)


def transpose(df: DataFrame, parsed: str, fields: Sequence[str]) -> DataFrame:
    """Replace an array of structs by one array per field."""
    rest = [c for c in df.columns if c != parsed]
    return df.select(*rest, *[F.col(parsed)[f].alias(f) for f in fields])


def zip_explode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn parallel array columns into rows, one per position; shorter arrays are padded with null.

    The columns keep their names; the others repeat. Rows whose arrays are all null or empty are
    dropped. For payloads prefer :func:`expand_records`: it gives the same rows, parses only the
    wanted fields and accounts for payloads without rows.
    """
    rest = [c for c in df.columns if c not in columns]
    zipped = df.select(*rest, F.explode(F.arrays_zip(*columns)).alias("zipped"))
    return zipped.select(*rest, *[F.col("zipped")[c].alias(c) for c in columns])
