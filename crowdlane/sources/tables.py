"""Reading and writing the base tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from crowdlane import schema
from crowdlane.functions import clock

TABLES: dict[str, str] = {
    "events": schema.EVENTS,
    "venue_locations": schema.VENUES,
    "traffic_measurements": schema.MEASUREMENTS,
}


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """One base table under ``root`` with its declared schema, so nothing is inferred."""
    return spark.read.schema(TABLES[name]).format(fmt).load(f"{root}/{name}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    name: str,
    key: str,
    bounds: tuple[int, int],
    partitions: int = 64,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A base table from a database, split over ``partitions`` ranges of a numeric key."""
    return spark.read.jdbc(
        url,
        name,
        column=key,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=dict(properties or {}),
    )


def load_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    return {name: read_table(spark, root, name, fmt) for name in TABLES}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make frames reachable by name from ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def stamp_measurements(df: DataFrame) -> DataFrame:
    """Fill the derived columns of new measurement rows.

    Day and hour come from the timestamp; ``baseline_type`` only stays on baseline
    rows; the source defaults to tomtom and the flag to false; a fractional delay
    is rounded half away from zero, as an integer column does on insert.
    """
    flag = F.coalesce("is_baseline", F.lit(False))
    return df.withColumns(
        {
            "is_baseline": flag,
            "baseline_type": F.when(flag, F.col("baseline_type")),
            "data_source": F.coalesce("data_source", F.lit("tomtom")),
            "delay_minutes": F.round(F.col("delay_minutes").cast("double")).cast("int"),
            "day_of_week": clock.day_of_week("measurement_time"),
            "hour_of_day": F.hour("measurement_time"),
        }
    )


def conform(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a base table in their types; missing ones are NULL, others go.

    A value that does not fit its declared type is an error, as it is on insert.
    """
    declared = StructType.fromDDL(TABLES[name])
    return df.select(
        [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in declared]
    )


def append_measurements(df: DataFrame, path: str, as_of: str | None = None) -> None:
    """Append stamped rows in the declared types, partitioned by day so that date filters prune files.

    Rows without ``created_at`` get ``as_of``. Adaptive execution sizes the writers: a busy
    day is not funnelled through one task, a quiet one does not make many files.
    """
    rows = conform(stamp_measurements(df), "traffic_measurements")
    if as_of is not None:
        rows = rows.withColumn("created_at", F.coalesce("created_at", clock.moment(as_of)))
    (
        rows.withColumn("measurement_date", F.to_date("measurement_time"))
        .hint("rebalance", "measurement_date")
        .write.mode("append")
        .partitionBy("measurement_date")
        .parquet(path)
    )


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Write a report frame (summary, top list, distribution) as json, csv or parquet."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
