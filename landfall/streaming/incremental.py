"""Loading landed files as they arrive, each exactly once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from landfall.paths import remove
from landfall.plans.batch import load_frame, proven, scan
from landfall.plans.spec import LoadSpec
from landfall.session import work_folder
from landfall.sinks.cleanup import delete_loaded


def load_stream(
    spark: SparkSession,
    spec: LoadSpec,
    checkpoint: str,
    run_ts: datetime | None = None,
    max_files: int = 10_000,
    clean: bool = False,
) -> StreamingQuery:
    """Start a query that loads what has landed since the last run, then stops.

    Every micro-batch becomes its own bronze folder, named after its files and its number, so a
    replayed micro-batch overwrites itself, whatever the spec's mode. ``max_files`` bounds a micro-batch;
    it paces the run and leaves nothing out. ``clean`` deletes, per micro-batch, the files proven to be loaded;
    files without a row element or with a bad name stay.
    """

    def load(batch: DataFrame, number: int) -> None:
        work = work_folder(batch.sparkSession, f"stream-{number}")
        try:
            once = spec.but(mode="overwrite")
            _, path, rejects_path = load_frame(batch, once, work, run_ts, suffix=f"-{number:010d}")
            files = proven(batch.sparkSession, once, work, path, rejects_path)
            if clean:
                delete_loaded(batch.sparkSession, files, f"{work}/deletions")
        finally:
            remove(batch.sparkSession, work)

    return (
        scan(spark, spec, stream=True, maxFilesPerTrigger=str(max_files))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
