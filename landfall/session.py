"""Session settings, object-store settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

from landfall.paths import qualified

# The environment names existing deployments already set.
ENDPOINT_VARIABLE = "HOST_MINIO"
ACCESS_KEY_VARIABLE = "AWS_ACESS_KEY"
SECRET_KEY_VARIABLE = "AWS_SECRET_KEY"

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def session(conf: Mapping[str, str] | None = None, name: str = "landfall", log_level: str = "ERROR") -> SparkSession:
    """Start (or reuse) a session. The caller owns it: nothing in this package stops a session."""
    spark = SparkSession.builder.config(map={**DEFAULTS, **(conf or {})}).appName(name).getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def object_store_conf(endpoint: str, access_key: str, secret_key: str, ssl: bool = False) -> dict[str, str]:
    """Settings that let ``s3a://`` paths reach an S3-compatible store."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def object_store_conf_from_env(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """The same settings, taken from the environment; raises ``KeyError`` for a missing name."""
    return object_store_conf(env[ENDPOINT_VARIABLE], env[ACCESS_KEY_VARIABLE], env[SECRET_KEY_VARIABLE])


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did; on a cluster it is installed or shipped as usual."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for staged tables, below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one machine, may fall back to a
    temporary folder; it is then remembered in the setting so one session uses one root.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = spark.conf.get("spark.landfall.local.root", None)
        if not root:
            root = tempfile.mkdtemp(prefix="run-")
            spark.conf.set("spark.landfall.local.root", root)
    return qualified(spark, f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}")
