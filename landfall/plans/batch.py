"""Loading a landed batch into bronze."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, DataFrameReader, Row, SparkSession, functions as F

from landfall.functions.audit import stamp
from landfall.functions.names import batch_tokens, latest_identity, target_name
from landfall.functions.payload import BAD_FILE_NAME, CORRUPT_XML
from landfall.operators.expand import accepted, expand_records, rejected
from landfall.operators.reconcile import LOADED, MISMATCH, RESENT, file_counts, reconcile
from landfall.operators.resent import MARKS, fingerprints, read_ledger, resent
from landfall.paths import exists, remove
from landfall.plans.spec import LoadSpec
from landfall.session import work_folder
from landfall.sinks.cleanup import DELETED, delete_loaded
from landfall.sinks.layer import WriteResult, write_layer
from landfall.sources.listing import list_files
from landfall.sources.xml import CORRUPT, listed_files, read_xml

UNNAMED = "unnamed"  # the reject folder of a batch without a single well-named file


class TargetConflict(RuntimeError):
    """Overwriting the target would drop rows of files that are not part of the batch."""


class LoadMismatch(RuntimeError):
    """The written tables do not hold what was read from landing."""


@dataclass(frozen=True)
class LoadResult:
    """What a load did. ``path`` is empty when there was nothing to load.

    ``status`` is 0, or 1 for a load that failed and was asked not to raise; ``message`` then says why. ``unread`` counts the
    landed files without any row element. ``files`` has one row per landed file that was read: its counts, disposition and
    clean-up outcome.
    """

    status: int
    rows: int
    rejects: int
    path: str
    rejects_path: str
    deleted: int
    files: DataFrame | None
    unread: int = 0
    message: str = ""


def scan(spark: SparkSession, spec: LoadSpec, stream: bool = False, work: str = "", **options: str) -> DataFrame:
    """The landed payloads with their source file and, for broken elements, the element's text."""
    schema = f"`{spec.payload}` string, {CORRUPT} string"
    options = {**spec.read_options, **options}
    return read_xml(
        spark, spec.landing, spec.row_tag, schema, splittable=spec.splittable, stream=stream, work=work, **options
    )


def expand(scanned: DataFrame, spec: LoadSpec) -> DataFrame:
    """Record rows and set-aside payloads of a scan, in one frame and one pass."""
    date, hour = batch_tokens("SourceFileName")
    reason = F.when(date.isNull() | hour.isNull(), BAD_FILE_NAME).when(F.col(CORRUPT).isNotNull(), CORRUPT_XML)
    payloads = scanned.select(
        "SourceFileName",
        "SourceFileTime",
        F.coalesce(CORRUPT, spec.payload).alias(spec.payload),
        reason.alias("known_reason"),
    )
    return expand_records(payloads, spec.payload, spec.record, "known_reason", spec.salvage)


def load_frame(
    scanned: DataFrame, spec: LoadSpec, work: str, run_ts: datetime | None = None, suffix: str = ""
) -> tuple[Row, str, str]:
    """Stage a scan and write its bronze and reject tables; returns totals and the two paths.

    The XML is parsed once, into a staged table with the few kept columns. Everything the audit
    columns need is counted there, and bronze is a columnar copy of it: no second parse, and a lost
    executor costs a part of the copy.
    """
    spark = scanned.sparkSession
    write_layer(expand(scanned, spec), f"{work}/staged")
    staged = spark.read.parquet(f"{work}/staged")
    if spec.fingerprints:
        write_layer(fingerprints(staged), f"{work}/prints")
        prints = spark.read.parquet(f"{work}/prints")
        write_layer(resent(prints, read_ledger(spark, spec.fingerprints_path)), f"{work}/resent")
        staged = staged.join(spark.read.parquet(f"{work}/resent"), "SourceFileName", "left_anti").select(staged.columns)

    write_layer(file_counts(staged), f"{work}/counts")
    counts = spark.read.parquet(f"{work}/counts")
    totals = counts.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("rejects"), F.lit(0)).alias("rejects"),
        latest_identity("SourceFileName", spec.date_format).alias("latest"),
    )
    date, hour = F.col("latest.date_token"), F.concat("latest.hour_token", F.lit(suffix))
    name = F.when(F.col("latest").isNotNull(), target_name(spec.entity, date, hour))
    totals = totals.select("records", "rejects", name.alias("name")).first()
    path = f"{spec.target.rstrip('/')}/{totals.name}" if totals.name else ""
    rejects_path = f"{spec.rejects_path}/{totals.name or UNNAMED + suffix}" if totals.rejects else ""

    if path:
        bronze = accepted(staged).select(*spec.columns, "SourceFileName")
        bronze, there = _lacking(bronze, path, read_bronze(spark, spec), spec.mode, f"{work}/in-bronze")
        if bronze is not None:
            bronze = stamp(bronze, spec.source_name, totals.records, run_ts)
            written = write_layer(bronze, path, spec.fmt, spec.mode, spec.compression, merge_to=spec.files)
            _require_all(written, totals.records - there, spec.mode)
    if rejects_path:
        rejects = rejected(staged, "SourceFileName")
        rejects, there = _lacking(rejects, rejects_path, spark.read.format("parquet"), spec.mode, f"{work}/in-rejects")
        if rejects is not None:
            written = write_layer(rejects, rejects_path, mode=spec.mode)
            _require_all(written, totals.rejects - there, spec.mode)
    return totals, path, rejects_path


def _require_all(written: WriteResult, rows: int, mode: str) -> None:
    if written.rows != rows and mode != "ignore":
        raise LoadMismatch(f"{written.rows} of {rows} rows were written to {written.path}")


def proven(
    spark: SparkSession, spec: LoadSpec, work: str, path: str, rejects_path: str, listing: DataFrame | None = None
) -> DataFrame:
    """The dispositions of a load's files; raises ``LoadMismatch`` if a table does not hold what was read."""
    counts = spark.read.parquet(f"{work}/counts")
    nothing = counts.select("SourceFileName").where(F.lit(False))
    write_layer(
        reconcile(
            nothing if listing is None else listing,
            counts,
            read_bronze(spark, spec).load(path) if path else nothing,
            spark.read.parquet(rejects_path) if rejects_path else nothing,
        ),
        f"{work}/dispositions",
    )
    files = spark.read.parquet(f"{work}/dispositions")
    if spec.fingerprints:
        loaded = files.where(F.col("disposition") == LOADED).select("SourceFileName")
        new = spark.read.parquet(f"{work}/prints").join(loaded, "SourceFileName", "left_semi")
        ledger = read_ledger(spark, spec.fingerprints_path).select("SourceFileName", *MARKS)
        new = new.join(ledger, ["SourceFileName", *MARKS], "left_anti").select("SourceFileName", *MARKS, F.lit(path).alias("batch"))
        again = spark.read.parquet(f"{work}/resent").select("SourceFileName", "SourceFileTime")
        none = F.lit(0).cast("bigint")
        files = files.union(again.select("*", none.alias("records"), none.alias("rejects"), F.lit(RESENT).alias("disposition")))
    wrong = files.where(F.col("disposition") == MISMATCH).count()
    if wrong:
        raise LoadMismatch(f"{wrong} landed files are not fully in {path or rejects_path}")
    if spec.fingerprints:
        write_layer(new, spec.fingerprints_path, mode="append")
    return files


def load_batch(
    spark: SparkSession,
    spec: LoadSpec,
    run_ts: datetime | None = None,
    clean: bool = False,
    report_unread: bool = False,
    raise_errors: bool = True,
) -> LoadResult:
    """Load everything landed now; with ``clean``, then delete the files proven to be loaded.

    Errors leave landing untouched and propagate, or, without ``raise_errors``, make the result's status 1. Files that arrive during the run are neither
    loaded nor deleted, and a file that holds no row element is never deleted. ``report_unread``
    adds the latter to the result as ``no_records``; it costs a second listing of landing and, as
    Spark scans files, a task for every few of them. A load can be repeated at any point: files the
    target already holds are not written twice, and an interrupted clean-up is finished first.
    """
    work = work_folder(spark, "load")
    listing = list_files(spark, spec.landing, **spec.read_options) if report_unread else None
    try:
        deleted = _finish_clean_up(spark, spec, work, clean)
        scanned = scan(spark, spec, work=f"{work}/scan")
        totals, path, rejects_path = load_frame(scanned, spec, work, run_ts)
        files = proven(spark, spec, work, path, rejects_path, listing)
        if clean:
            write_layer(files, spec.ledger_path)
            files = delete_loaded(spark, files, f"{work}/deletions")
            deleted += files.where(F.col("outcome") == DELETED).count()
            remove(spark, spec.ledger_path)
        unread = listed_files(scanned) - _read_files(spark, spec, work)
    except Exception as error:
        remove(spark, work)
        if raise_errors:
            raise
        return LoadResult(1, 0, 0, "", "", 0, None, message=f"{type(error).__name__}: {error}")
    for table in ("scan", "staged", "in-bronze", "in-rejects"):
        remove(spark, f"{work}/{table}")
    return LoadResult(0, totals.records, totals.rejects, path, rejects_path, deleted, files, unread)


def _read_files(spark: SparkSession, spec: LoadSpec, work: str) -> int:
    """How many files had a row element, from the staged counts."""
    again = spark.read.parquet(f"{work}/resent").count() if spec.fingerprints else 0
    return spark.read.parquet(f"{work}/counts").count() + again


def _finish_clean_up(spark: SparkSession, spec: LoadSpec, work: str, clean: bool) -> int:
    """Delete what an interrupted clean-up left, by its ledger of proven files; returns how many.

    The ledger stands from before the first deletion until after the last, so what it names is in bronze, in
    whichever folder, and must not be loaded again. A file that changed since then is kept, and loaded.
    """
    if not exists(spark, f"{spec.ledger_path}/_SUCCESS"):
        return 0
    if not clean:
        raise TargetConflict(f"a clean-up was interrupted; load with clean=True to finish it by {spec.ledger_path}")
    left = delete_loaded(spark, spark.read.parquet(spec.ledger_path), f"{work}/finished")
    deleted = left.where(F.col("outcome") == DELETED).count()
    remove(spark, spec.ledger_path)
    return deleted


def read_bronze(spark: SparkSession, spec: LoadSpec) -> DataFrameReader:
    """A reader for the spec's bronze tables."""
    return spark.read.format(spec.fmt).schema(spec.bronze_schema)


def _digest(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Per file, by partial sums: how many rows, and a sum of their hashes that does not depend on their order."""
    values = [c for column in columns for c in (F.col(column), F.col(column).isNull())]
    total = F.sum(F.xxhash64(*values).cast("decimal(20,0)"))
    return rows.groupBy("SourceFileName").agg(F.struct(F.count("*").alias("rows"), total.alias("hashes")).alias(name))


def _lacking(rows: DataFrame, path: str, reader: DataFrameReader, mode: str, work: str) -> tuple[DataFrame | None, int]:
    """What to write of ``rows`` to ``path``, and how many of them need no writing as they are there.

    A batch may overwrite its own earlier run, not rows whose landed files are already gone: when the folder holds
    other files, it stays as it is if it has all of this batch (``None``), and is a ``TargetConflict`` if it lacks any.
    Appending leaves out files that are there with the same rows; a file there with other rows is a ``TargetConflict``.
    """
    spark = rows.sparkSession
    if mode not in ("overwrite", "append") or not exists(spark, path):
        return rows, 0
    own, there = _digest(rows, rows.columns, "own"), _digest(reader.load(path), rows.columns, "there")
    state = F.when(F.col("own").isNull(), "other").when(F.col("there").isNull(), "new")
    state = state.when(F.col("own") == F.col("there"), "same").otherwise("differs").alias("state")
    write_layer(own.join(there, "SourceFileName", "full").select("SourceFileName", "own.rows", state), work)
    files = spark.read.parquet(work)
    found = {r["state"]: r for r in files.groupBy("state").agg(F.count("*").alias("files"), F.sum("rows").alias("rows")).collect()}
    if mode == "overwrite":
        if "other" not in found:
            return rows, 0
        if "new" in found or "differs" in found:
            others = found["other"]["files"]
            raise TargetConflict(f"{path} holds rows of {others} files outside this batch; load with mode='append'")
        return None, 0
    if "differs" in found:
        raise TargetConflict(f"{path} holds {found['differs']['files']} files of this batch with other rows")
    if "same" not in found:
        return rows, 0
    return rows.join(files.where("state = 'same'"), "SourceFileName", "left_anti").select(rows.columns), found["same"]["rows"]
