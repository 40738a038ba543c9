"""Tables in versions: written aside, audited, then published by one rename.

Below a table's folder, ``data/<id>`` holds the files of one write and ``versions/<number>`` a manifest that names it with its row
count and hash. The table is what the highest manifest names. A manifest is written under another name and renamed to the
next number, which a file system does as a whole or not at all and refuses if the number is taken. So a failure at
any step leaves the version before readable, and of two writers one gets a ``VersionConflict``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.paths import children, qualified, read_text, remove, rename, write_text
from landfall.sinks.layer import write_layer


class VersionConflict(RuntimeError):
    """Another writer published first."""


class AuditFailed(RuntimeError):
    """The written files do not hold what was to be published."""


@dataclass(frozen=True)
class Version:
    """One published state of a table."""

    number: int
    data: str
    rows: int
    digest: str
    schema: str
    fmt: str
    note: str = ""


def digest(df: DataFrame) -> DataFrame:
    """One row with the count of rows and a sum of their hashes, which do not depend on their order or files."""
    values = [c for name in df.columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    total = F.sum(F.xxhash64(*values).cast("decimal(20,0)")) if values else F.lit(0)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(total.cast("string"), F.lit("0")).alias("hashes"))


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The published versions, oldest first."""
    numbers = sorted(int(name) for name in children(spark, f"{path}/versions") if name.isdigit())
    return [Version(**json.loads(read_text(spark, f"{path}/versions/{n:012d}"))) for n in numbers]


def current(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The version readers see, or the one asked for; None if there is none."""
    names = [int(name) for name in children(spark, f"{path}/versions") if name.isdigit()]
    wanted = max(names, default=None) if number is None else number if number in names else None
    return None if wanted is None else Version(**json.loads(read_text(spark, f"{path}/versions/{wanted:012d}")))


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as of a version, by default the last. What is published later does not change a frame already made."""
    version = current(spark, path, number)
    if version is None:
        raise FileNotFoundError(f"{path} has no version {'' if number is None else number}".rstrip())
    return spark.read.format(version.fmt).schema(version.schema).load(f"{path}/{version.data}")


def _publish(spark: SparkSession, path: str, base: int, version: dict) -> Version:
    made = Version(number=base + 1, **version)
    draft = f"{path}/versions/draft-{uuid.uuid4().hex}"
    write_text(spark, draft, json.dumps(asdict(made)))
    if not rename(spark, draft, f"{path}/versions/{made.number:012d}"):
        remove(spark, draft)
        raise VersionConflict(f"version {made.number} of {path} was published by another writer")
    return made


def publish(
    df: DataFrame,
    path: str,
    audit: Callable[[DataFrame], None] | None = None,
    base: int | None = None,
    fmt: str = "parquet",
    compression: str = "snappy",
    files: int | None = None,
    note: str = "",
) -> Version:
    """Write ``df`` aside, check it, and make it the table.

    The files are read back and must hold as many rows with the same sum of hashes as the write counted; ``audit`` gets the
    frame read back and raises to refuse it. ``base`` is the version ``df`` was made from (0: none): if another has been published
    since, this is a ``VersionConflict``; by default it is the last one when the write begins. Refused and interrupted
    writes leave files that no version names, until ``vacuum``.
    """
    spark, path = df.sparkSession, qualified(df.sparkSession, path)
    last = current(spark, path)
    at = last.number if last else 0
    if base is not None and base != at:
        raise VersionConflict(f"{path} is at version {at}, not {base}")
    data = f"data/{uuid.uuid4().hex}"
    written = write_layer(df, f"{path}/{data}", fmt, mode="errorifexists", compression=compression, files=files)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    back = spark.read.format(fmt).schema(schema).load(f"{path}/{data}")
    found = digest(back).first()
    if found["rows"] != written.rows:
        raise AuditFailed(f"{found['rows']} of {written.rows} rows are in {path}/{data}")
    if audit is not None:
        audit(back)
    return _publish(spark, path, at, {"data": data, "rows": written.rows, "digest": found["hashes"], "schema": schema, "fmt": fmt, "note": note})


def restore(spark: SparkSession, path: str, number: int) -> Version:
    """Publish an earlier version's files as the newest version; nothing is copied."""
    path = qualified(spark, path)
    earlier, last = current(spark, path, number), current(spark, path)
    if earlier is None:
        raise FileNotFoundError(f"{path} has no version {number}")
    values = {k: v for k, v in asdict(earlier).items() if k != "number"}
    return _publish(spark, path, last.number, values | {"note": f"restored {number}"})


def verify(spark: SparkSession, path: str, number: int | None = None) -> None:
    """Raise ``AuditFailed`` unless a version's files still hold what was published."""
    version = current(spark, path, number)
    found = digest(read_version(spark, path, number)).first()
    if (found["rows"], found["hashes"]) != (version.rows, version.digest):
        raise AuditFailed(f"version {version.number} of {path} has changed since it was published")


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove all but the last ``keep`` versions, then files no version left names; returns what was removed.

    Not while a writer is at work: its files are not named yet. Manifests go first, so no version is left without files.
    """
    if keep < 1:
        raise ValueError("the last version stays")
    path = qualified(spark, path)
    known = versions(spark, path)
    gone = [f"versions/{v.number:012d}" for v in known[:-keep]] + [f"versions/{n}" for n in children(spark, f"{path}/versions") if n.startswith("draft-")]
    named = {v.data for v in known[-keep:]}
    gone += [f"data/{name}" for name in children(spark, f"{path}/data") if f"data/{name}" not in named]
    for name in gone:
        remove(spark, f"{path}/{name}")
    return gone
