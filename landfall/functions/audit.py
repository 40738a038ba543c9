"""Audit columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

# Fixed value: the text form of the processing date.
DATE_FORMAT = "dd-MM-yyyy"


def stamp(df: DataFrame, source: str, rows: int, run_ts: datetime | None = None) -> DataFrame:
    """Append NumRows, ProcessedDate, ProcessedTime and SourceName.

    ``rows`` is the batch total, repeated as text on every row. It is a literal, so nothing is
    counted or shuffled here. ``run_ts`` replaces the clock to make a run repeatable; without an
    offset it is wall-clock time of the session's time zone.
    """
    now = F.current_timestamp() if run_ts is None else F.lit(run_ts.isoformat(" ")).cast("timestamp")
    return df.withColumns(
        {
            "NumRows": F.lit(rows).cast("string"),
            "ProcessedDate": F.date_format(now, DATE_FORMAT),
            "ProcessedTime": now,
            "SourceName": F.lit(source),
        }
    )
