"""Which (date, hour) slots of an entity did not land in time, and what landed after its time."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from landfall.functions.names import batch_tokens, file_name, name_token
from landfall.session import importable

#: What the binary file source gives.
FILES = "path string, modificationTime timestamp, length long, content binary"
ABSENT, LATE = "absent", "late"
RESULT = "entity string, slot timestamp, status string, landed_at timestamp"
#: Rows of absent slots handed on at a time; an entity silent for years has many.
CHUNK = 10_000


def landed_slots(spark: SparkSession, folder: str, slot_format: str, entity_position: int = 0, max_files: int = 10_000) -> DataFrame:
    """Stream of ``(entity, slot, landed_at)`` from the names and times of landed files; their content is not read.

    The slot is read by ``slot_format`` from the date token followed by the hour token. Files whose name has no such slot are left out.
    """
    names = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", max_files).load(folder)
    date, hour = batch_tokens("path")
    slot = F.try_to_timestamp(F.concat(date, hour), F.lit(slot_format))
    entity = name_token(file_name("path"), entity_position)
    return names.select(entity.alias("entity"), slot.alias("slot"), F.col("modificationTime").alias("landed_at")).where("slot is not null")


def slot_report(arrivals: DataFrame, every: timedelta = timedelta(hours=1), grace: timedelta = timedelta(0), delay: str = "10 minutes") -> DataFrame:
    """Stream of ``(entity, slot, status, landed_at)`` from a stream of ``(entity, slot, landed_at)``.

    A slot is due ``grace`` after its end. It is ``absent`` if nothing of it had landed by then, reported once, when the watermark on
    ``landed_at`` (its maximum over all entities less ``delay``) is past that time. Expected are all slots from the entity's first one
    that landed in time. Every arrival after its slot's time is a row of status ``late``, whether or not the slot is reported absent.
    The rows do not depend on how arrivals fall into micro-batches, as long as none arrives more than ``delay`` out of
    order; Spark leaves such ones out. Slots are cut down to a multiple of ``every``.

    State is kept per entity: the next slot to decide, and those that landed in time and are not decided yet, so it
    holds as many slots as fit between watermark and newest arrival. Each task passes on a slot that landed in time once per Arrow batch, so
    an entity with very many files sends few rows. A null entity is an entity of its own; null slots and times are left out.
    """
    step, wait = int(every.total_seconds()), int(every.total_seconds() + grace.total_seconds())
    if step < 1 or wait < step:
        raise ValueError("slots last a second at least, and grace is not negative")
    importable(arrivals.sparkSession)

    def once(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            in_time = ~batch["late"]
            first = batch[in_time].sort_values("landed_at").drop_duplicates(["entity", "slot"], keep="last")
            yield pd.concat([first, batch[~in_time]])

    seconds = F.floor(F.unix_micros("slot") / F.lit(step * 1_000_000)) * F.lit(step)
    known = arrivals.where("slot is not null and landed_at is not null").select(
        F.col("entity").cast("string").alias("entity"), seconds.cast("long").alias("slot"), F.col("landed_at").cast("timestamp").alias("landed_at")
    )
    known = known.withColumn("late", F.unix_micros("landed_at") > (F.col("slot") + F.lit(wait)) * F.lit(1_000_000))
    known = known.mapInPandas(once, known.schema).withWatermark("landed_at", delay)

    def rows(entity: str | None, slots: list[int], status: str, landed_at) -> pd.DataFrame:
        frame = pd.DataFrame({"entity": pd.Series([entity] * len(slots), dtype=object), "slot": pd.to_datetime(slots, unit="s"), "status": status})
        return frame.assign(landed_at=landed_at)

    def judge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        following, seen = state.get if state.exists else (None, [])
        seen = set(seen)
        for batch in batches:
            after = batch[batch["late"]]
            if len(after):
                yield rows(key[0], after["slot"].tolist(), LATE, after["landed_at"].tolist())
            seen.update(int(s) for s in batch.loc[~batch["late"], "slot"] if following is None or s >= following)
        if following is None and not seen:
            return
        watermark = state.getCurrentWatermarkMs()
        at = min(seen) if following is None else following
        absent: list[int] = []
        while (at + wait) * 1000 < watermark:
            following = at + step
            if at in seen:
                seen.remove(at)
            else:
                absent.append(at)
                if len(absent) == CHUNK:
                    yield rows(key[0], absent, ABSENT, pd.NaT)
                    absent = []
            at = following
        if absent:
            yield rows(key[0], absent, ABSENT, pd.NaT)
        state.update((following, sorted(seen)))
        state.setTimeoutTimestamp(max((at + wait) * 1000, watermark + 1))

    return known.groupBy("entity").applyInPandasWithState(
        judge, RESULT, "following long, seen array<long>", "append", GroupStateTimeout.EventTimeTimeout
    )
