"""Session defaults and the shared folder long jobs write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "crowdlane", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and a UTC clock.

    Shuffle partitions are left to the caller: adaptive execution coalesces
    small ones, so a cluster should start from a high number.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is absent and the
    session is local, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="crowdlane-")
    raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again.

    For rows that several parts of one plan need and that are dear to compute: the
    table cuts the lineage, and lost executors lose nothing of it.
    """
    path = f"{shared_dir(df.sparkSession)}/crowdlane/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
