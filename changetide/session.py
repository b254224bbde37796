"""Session helpers: time zone contract and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

APP_FOLDER = "changetide"


def build_session(app: str = "changetide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; `conf` keys use `_` for `.`."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Dates and hours of events are UTC ones and follow the session zone, so it has to be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone}")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder of the cluster.

    The folder comes from `spark.checkpoint.dir`. Only a local session without that setting gets a
    folder of its own; on a cluster a machine-local one would be lost with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="changetide-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{APP_FOLDER}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, folder: str) -> None:
    """Remove a folder made by `scratch_dir`, as one drops a temporary table."""
    if f"/{APP_FOLDER}/" not in folder:
        raise ValueError(f"not a scratch folder: {folder}")
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
