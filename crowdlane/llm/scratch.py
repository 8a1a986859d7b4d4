"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import os
import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from crowdlane.session import shared_dir

_shipped: set[str] = set()


def _small_batches(spark: SparkSession) -> None:
    """Arrow batches of 1,000 rows in this session: texts are long, and each task holds a batch or two."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 1000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def store(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again.

    This cuts the lineage and keeps costly rows from being computed twice. The
    files are in the folder that all executors share, so nothing is lost with one.
    """
    _small_batches(df.sparkSession)
    path = f"{shared_dir(df.sparkSession)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Deletes the files of a frame that :func:`store` returned and that no other frame needs."""
    jvm = df.sparkSession._jvm
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, where their Python would not find it by itself."""
    root = pathlib.Path(__file__).resolve().parents[2]
    known = [pathlib.Path(p or ".").resolve() for p in ["", *os.environ.get("PYTHONPATH", "").split(os.pathsep)]]
    sc = spark.sparkContext
    if root in known or sc.applicationId in _shipped:
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='crowdlane-')}/crowdlane", "zip", root, "crowdlane")
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
