"""File-name tokens and the batch identity they carry."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# The layout of landed file names, ``<a>_<b>_<date>_<hour>.xml``, and of batch names.
SEPARATOR = "_"
DATE_POSITION = 2
HOUR_POSITION = 3
STRIP_FROM_HOUR = ".xml"  # a regular expression, replaced wherever it matches
TARGET_FORMAT = "%s-%s-%s.parquet"


def file_name(path: Column | str) -> Column:
    """The last part of a path, with percent-encoding undone (a ``+`` in a path is a plus sign)."""
    path = F.col(path) if isinstance(path, str) else path
    return F.try_url_decode(F.replace(F.substring_index(path, "/", -1), F.lit("+"), F.lit("%2B")))


def name_token(name: Column, position: int, separator: str = SEPARATOR) -> Column:
    """The token at a 0-based position; null when the name has fewer."""
    return F.get(F.split(name, re.escape(separator)), position)


def batch_tokens(path: Column | str) -> tuple[Column, Column]:
    """The (date, hour) tokens of a landed file. Folders above the file do not count."""
    name = file_name(path)
    hour = F.regexp_replace(name_token(name, HOUR_POSITION), STRIP_FROM_HOUR, "")
    return name_token(name, DATE_POSITION).alias("date_token"), hour.alias("hour_token")


def latest_identity(path: Column | str, date_format: str | None = None) -> Column:
    """Aggregate: the latest (date, hour) pair; null when no file name carries both.

    A single maximum over the pair, so date and hour always come from the same file. With ``date_format``
    dates compare as dates, before any that do not parse; without it, and among equal ones, tokens
    compare as text.
    """
    date, hour = batch_tokens(path)
    pair = F.struct(date, hour)
    when = F.to_date(F.try_to_timestamp(date, F.lit(date_format))) if date_format else F.lit(None).cast("date")
    order = F.struct(F.coalesce(when, F.lit("0001-01-01").cast("date")), date, hour)
    return F.max_by(pair, F.when(date.isNotNull() & hour.isNotNull(), order))


def batch_identity(df: DataFrame, path: str = "SourceFileName", date_format: str | None = None) -> DataFrame:
    """One row with a batch's latest (date, hour)."""
    return df.agg(latest_identity(path, date_format).alias("latest")).select("latest.date_token", "latest.hour_token")


def target_name(entity: str, date: Column, hour: Column) -> Column:
    """The batch's folder name."""
    return F.format_string(TARGET_FORMAT, F.lit(entity), date, hour)
