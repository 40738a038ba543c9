"""JSON payloads: parsing with a declared record, and the reason a payload yields no rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F, types as T

# Reject reasons.
MISSING = "missing"
MALFORMED = "malformed"
BROKEN_TAIL = "broken_tail"  # the records before are kept
EMPTY = "empty"
CORRUPT_XML = "corrupt_xml"
BAD_FILE_NAME = "bad_file_name"

BLANK = r"[ \t\n\r]"  # what JSON counts as white space


def string_record(fields: Iterable[str]) -> T.StructType:
    """A record whose fields are all nullable text: numbers and dates arrive as text and stay text."""
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])


def parse_payload(payload: Column | str, record: T.StructType, mode: str = "PERMISSIVE") -> Column:
    """Parse text holding a JSON array of ``record`` objects (or one object) into an array of structs.

    Declare only the wanted fields: Spark parses every declared one, even when it is dropped later.
    ``from_json`` ignores what follows the first value of a text. Here the text is parsed inside brackets of its
    own, where anything that follows breaks the JSON or counts as one more value: either way the result is null.
    """
    payload = F.col(payload) if isinstance(payload, str) else payload
    # Nearly every payload shows in its first byte which it is; others cost a look at their leading blanks.
    odd = ~payload.startswith("{")
    listed = payload.startswith("[") | (odd & payload.rlike(rf"\A{BLANK}*(?:\[|null{BLANK}*\z)"))
    blank = odd & payload.rlike(rf"\A{BLANK}*\z")
    inside = F.when(listed, F.concat(F.lit("["), payload, F.lit("]"))).when(blank, payload)
    inside = inside.otherwise(F.concat(F.lit("[["), payload, F.lit("]]")))
    values = F.from_json(inside, T.ArrayType(T.ArrayType(record)), {"mode": mode})

    def only(found: Column) -> Column:
        first = F.get(found["values"], 0)
        return F.when((F.size(found["values"]) == 1) & (found["listed"] | (F.size(first) == 1)), first)

    # Through a lambda, so that the text is parsed once however often its value is looked at.
    return F.get(F.transform(F.array(F.struct(values.alias("values"), listed.alias("listed"))), only), 0)


def reject_reason(payload: Column, parsed: Column) -> Column:
    """Why a payload yields no rows; null when it yields some."""
    return (
        F.when(payload.isNull(), F.lit(MISSING))
        .when(parsed.isNull(), F.lit(MALFORMED))
        .when(F.size(parsed) == 0, F.lit(EMPTY))
    )
