"""Session defaults and the shared folder used for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Streaming state lives on disk, so its size is not bound by executor memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}

#: Folder by application, for local sessions without a shared one.
_LOCAL: dict[str, str] = {}


def get_session(app: str = "gridpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; `conf` entries (dots as `__`) win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, named by `spark.checkpoint.dir`.

    A local session that names none (a unit test) gets one folder for its lifetime;
    on a cluster the setting is required, as a folder of one machine is not shared.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local["):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="gridpulse-")
    return _LOCAL[context.applicationId]


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created or removed."""
    return f"{shared_dir(spark)}/gridpulse/{label}-{uuid.uuid4().hex}"


def run_database(spark: SparkSession, label: str) -> str:
    """A fresh database whose managed tables live below the shared folder."""
    name = f"gp_{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{run_dir(spark, label)}'")
    return name


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read back, with its lineage cut.

    The files outlive any executor, so a lost one costs no recomputation.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_dir(df.sparkSession)}/gridpulse")
    return df.checkpoint()
