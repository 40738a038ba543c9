"""Deleting landed files that are proven to be loaded."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from urllib.parse import unquote, urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.operators.reconcile import LOADED, RESENT

CHANGED = "changed"
DELETED = "deleted"
GONE = "already_gone"
KEPT = "kept"
FILES_PER_TASK = 1000
S3A = "spark.hadoop.fs.s3a"
S3_SCHEMES = ("s3", "s3a", "s3n")


def store_options(conf: Mapping[str, str | None]) -> dict:
    """The pyarrow spelling of ``fs.s3a`` settings; only those that are set."""
    endpoint = conf.get(f"{S3A}.endpoint")
    ssl = conf.get(f"{S3A}.connection.ssl.enabled") or "true"
    options = {
        "access_key": conf.get(f"{S3A}.access.key"),
        "secret_key": conf.get(f"{S3A}.secret.key"),
        "endpoint_override": endpoint.split("://")[-1] if endpoint else None,
        "scheme": "https" if ssl == "true" else "http",
        "region": conf.get(f"{S3A}.endpoint.region") or ("us-east-1" if endpoint else None),
    }
    return {k: v for k, v in options.items() if v}


def session_store_options(spark: SparkSession) -> dict:
    """The same, from a session."""
    names = ["endpoint", "access.key", "secret.key", "connection.ssl.enabled", "endpoint.region"]
    return store_options({f"{S3A}.{n}": spark.conf.get(f"{S3A}.{n}", None) for n in names})


def open_store(scheme: str, host: str, s3: dict) -> fs.FileSystem:
    """The file system behind a path's scheme and host."""
    if scheme in S3_SCHEMES:
        return fs.S3FileSystem(**s3)
    if scheme in ("", "file"):
        return fs.LocalFileSystem()
    return fs.FileSystem.from_uri(f"{scheme}://{host}/")[0]


def path_in_store(uri: str) -> str:
    """The path within its file system, of a file as Spark's file metadata spells it."""
    parts = urlsplit(uri)
    return (parts.netloc if parts.scheme in S3_SCHEMES else "") + unquote(parts.path)


def same_time(a_ms: int, b_ms: int) -> bool:
    """Whether two change times agree; where a store gives one in whole seconds, to the second."""
    if a_ms % 1000 and b_ms % 1000:
        return a_ms == b_ms
    return a_ms // 1000 == b_ms // 1000


def _deleter(s3: dict):
    def delete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stores: dict[tuple[str, str], fs.FileSystem] = {}

        def outcome(uri: str, loaded_ms: int) -> str:
            key = urlsplit(uri)[:2]
            if key not in stores:
                stores[key] = open_store(*key, s3)
            path = path_in_store(uri)
            info = stores[key].get_file_info(path)
            if info.type == fs.FileType.NotFound:
                return GONE
            if not same_time(info.mtime_ns // 1_000_000, loaded_ms):
                return CHANGED
            stores[key].delete_file(path)
            return DELETED

        for batch in batches:
            outcomes = [outcome(u, t) for u, t in zip(batch["SourceFileName"], batch["loaded_ms"])]
            yield pd.DataFrame({"SourceFileName": batch["SourceFileName"], "outcome": outcomes})

    return delete


def delete_loaded(spark: SparkSession, dispositions: DataFrame, log_path: str) -> DataFrame:
    """Delete the files whose disposition is ``loaded`` or ``resent`` and return every file with its outcome.

    Deletions run in tasks, spread over the cluster, and are logged to ``log_path``. A file that
    changed since it was read is kept (``changed``). A retried task finds its files
    ``already_gone``. Files with any other disposition are ``kept``.
    """
    loaded = dispositions.where(F.col("disposition").isin(LOADED, RESENT)).select(
        "SourceFileName", F.unix_millis("SourceFileTime").alias("loaded_ms")
    )
    tasks = math.ceil(loaded.count() / FILES_PER_TASK) or 1
    delete = _deleter(session_store_options(spark))
    deletions = loaded.repartition(tasks).mapInPandas(delete, "SourceFileName string, outcome string")
    deletions.write.mode("overwrite").parquet(log_path)
    return dispositions.join(spark.read.parquet(log_path), "SourceFileName", "left").withColumn(
        "outcome", F.coalesce("outcome", F.lit(KEPT))
    )
