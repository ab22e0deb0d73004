"""Sessions that suit the engine, and the package's place on the Python workers' path."""

from __future__ import annotations

import atexit
import os
import tempfile
import tomllib
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings of a new session; what a cluster sets itself stays.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.ui.enabled": "false",
}


def session(app: str = "lexarium", master: str | None = None, **conf: str) -> SparkSession:
    """The active session, or a new one with DEFAULTS and conf (dots written as __)."""
    builder = SparkSession.builder.appName(app).config(map=DEFAULTS | {k.replace("__", "."): str(v) for k, v in conf.items()})
    if master:
        builder = builder.master(master)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Lets Python workers that see this installation import it; others get it by --py-files."""
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see: in ``spark.checkpoint.dir``; where that is unset in the warehouse, or, in local mode only, in a
    temporary folder. It is deleted when the process ends."""
    master = spark.sparkContext.master
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base and master.startswith("local") and not master.startswith("local-cluster"):
        base = f"file://{tempfile.gettempdir()}/lexarium-shared"
    path = f"{(base or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # the session may have been stopped
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def config(path: str) -> dict:
    """A TOML file of settings; an absent one is empty."""
    try:
        with open(path, "rb") as f:
            return tomllib.load(f)
    except FileNotFoundError:
        return {}
