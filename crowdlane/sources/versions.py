"""A Parquet table in buckets, of which each batch rewrites only those it touches.

Folders are ``data/bucket=<name>/version=<batch>``; a bucket's newest version holds all its
rows. A batch writes its versions, then a commit file named by its number. A batch that runs
again overwrites its own versions and reads what it read before, so nothing is doubled; readers
take committed versions only, so they never see half a batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


class Versions:
    """``schema`` is that of the rows, without bucket and version."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def _path(self, *parts: str) -> tuple[JavaObject, JavaObject]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, *parts: str) -> list[str]:
        fs, path = self._path(*parts)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def commits(self) -> list[int]:
        """Numbers of the batches that are complete, ascending."""
        return sorted(int(n) for n in self._names("commits") if n.isdigit())

    def note(self, version: int) -> dict:
        """What the batch left beside its rows."""
        text = self.spark.read.text(f"{self.root}/commits/{version}", wholetext=True).first()
        return json.loads(text[0]) if text else {}

    def _of(self, bucket: str) -> list[int]:
        return sorted(int(n.removeprefix("version=")) for n in self._names("data", f"bucket={bucket}") if n.startswith("version="))

    def buckets(self) -> list[str]:
        return sorted(n.removeprefix("bucket=") for n in self._names("data") if n.startswith("bucket="))

    def read(self, upto: int | None = None, buckets: Iterable[str] | None = None) -> DataFrame:
        """The rows as of batch ``upto`` (the last complete one), of some buckets or of all."""
        done = self.commits()
        if upto is None:
            upto = done[-1] if done else -1
        paths = []
        for bucket in self.buckets() if buckets is None else sorted(buckets):
            known = [v for v in self._of(bucket) if v <= upto]
            if known:
                paths.append(f"{self.root}/data/bucket={bucket}/version={known[-1]}")
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, rows: DataFrame, version: int) -> None:
        """Write ``rows``, which have a column ``bucket``, as this version of their buckets.

        Adaptive execution sizes the writers, so a large bucket is written by several tasks.
        """
        (
            rows.select("bucket", F.lit(version).alias("version"), *self.schema.names)
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket", "version")
            .parquet(f"{self.root}/data")
        )

    def commit(self, version: int, **note: int) -> None:
        fs, path = self._path("commits", str(version))
        part = self._path("commits", f"_{version}")[1]
        out = fs.create(part, True)
        out.write(json.dumps(note).encode())
        out.close()
        fs.delete(path, False)
        fs.rename(part, path)

    def retire(self, version: int, buckets: Iterable[str], keep: int = 2) -> None:
        """Delete versions of touched buckets but the newest ``keep`` up to ``version``: a batch that
        runs again, and a reader that began before it, still find theirs."""
        for bucket in buckets:
            for old in [v for v in self._of(bucket) if v <= version][:-keep]:
                fs, path = self._path("data", f"bucket={bucket}", f"version={old}")
                fs.delete(path, True)
