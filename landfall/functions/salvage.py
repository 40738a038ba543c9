"""What is left of a broken payload: its complete elements before the break, and the tail."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from landfall.functions.payload import BLANK

#: Whole strings, in either quotes, are passed over; a quote alone opens a string that never ends.
TOKEN = re.compile(r"\"(?:[^\"\\]|\\.)*\"|'(?:[^'\\]|\\.)*'|[\[\]{},\"']", re.DOTALL)
PLACES = T.ArrayType(T.IntegerType())
ELEMENTS = T.StructType().add("starts", PLACES).add("ends", PLACES).add("stop", T.IntegerType())


def complete_elements(text: str) -> tuple[list[int], list[int], int]:
    """Where the elements of a JSON array start and end, by depth and quotes, up to the first that is not complete.

    The last number is where the good part stops: after the array, or after the last complete element and its comma.
    """
    starts, ends = [], []
    start = len(text) - len(text.lstrip(" \t\n\r"))
    if text[start : start + 1] != "[":
        return starts, ends, 0
    stop = start = start + 1
    depth, closed = 0, -1  # closed: where an element ended that has braces or brackets of its own
    for token in TOKEN.finditer(text, start):
        what, at = token[0], token.start()
        if closed >= 0 and text[closed:at].strip(" \t\n\r"):
            return starts, ends, stop
        if what in "[{":
            if closed >= 0:
                return starts, ends, stop
            depth += 1
        elif what in "]}" and depth:
            depth -= 1
            if depth == 0:
                starts.append(start)
                ends.append(token.end())
                stop = closed = token.end()
        elif what == "," and depth == 0 or what == "]":
            if closed < 0 and (what == "," or text[start:at].strip(" \t\n\r") or starts):
                starts.append(start)
                ends.append(at)
            stop = start = token.end()
            closed = -1
            if what == "]":
                return starts, ends, stop
        elif depth == 0 and (closed >= 0 or what in "}\"'"):
            return starts, ends, stop
    return starts, ends, stop


@F.pandas_udf(ELEMENTS)
def _elements(texts: pd.Series) -> pd.DataFrame:
    found = [(None, None, None) if text is None else complete_elements(text) for text in texts]
    return pd.DataFrame(found, columns=["starts", "ends", "stop"]).astype({"stop": "Int32"})


def salvaged(payload: Column, record: T.StructType) -> Column:
    """Of a malformed payload, ``records`` before the break and the ``tail`` from there on; null for a null payload.

    Elements are found by depth and quotes, then parsed one by one: the first that is no ``record`` (or null) breaks the
    array, whatever follows. The tail begins with it, or with what stands in place of a comma or the closing bracket; it
    is empty when only that bracket lacks.
    """
    found = _elements(payload)
    spans = F.arrays_zip(found["starts"].alias("start"), found["ends"].alias("end"))
    # An element in brackets of its own is null as a whole if it is broken, and an array of one null if it is null.
    parsed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), _one(payload, s, record).alias("one")))

    def settle(packed: Column) -> Column:
        values, stop = packed["parsed"], packed["stop"]
        whole = F.transform(values, lambda v: v["one"].isNotNull() & (F.size(v["one"]) == 1))
        good = F.when(F.array_contains(whole, False), F.array_position(whole, False) - 1).otherwise(F.size(values)).cast("int")
        at = F.coalesce(F.get(values, good)["start"], stop)
        records = F.transform(F.slice(values, F.lit(1), good), lambda v: F.get(v["one"], 0))
        return F.struct(records.alias("records"), F.substring(payload, at + 1, F.length(payload)).alias("tail"))

    packed = F.array(F.struct(parsed.alias("parsed"), found["stop"].alias("stop")))
    return F.when(payload.isNotNull(), F.get(F.transform(packed, settle), 0))


def _one(payload: Column, span: Column, record: T.StructType) -> Column:
    text = F.substring(payload, span["start"] + 1, span["end"] - span["start"])
    blank = text.rlike(rf"\A{BLANK}*\z")
    return F.when(~blank, F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(record)))
