"""Run-log lines of the baseline collector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

LINE_TIME = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d+)?) \|"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def parse_log(lines: DataFrame) -> DataFrame:
    """Columns of each non-blank line; ``status`` is Collected or the stated reason for no run."""

    def number(pattern: str):
        return F.regexp_extract("line", pattern, 1).try_cast("int")

    stamp = F.regexp_extract("line", LINE_TIME, 1)
    collected = F.col("line").contains("| Measurements:")
    return (
        lines.filter(stamp != "")
        .select(
            stamp.try_cast("timestamp_ntz").alias("run_time"),
            number(r"\| Group:? (\d+)").alias("venue_group"),
            F.nullif(F.regexp_extract("line", r"\| Time: (\d{2}:\d{2})", 1), F.lit("")).alias("time_slot"),
            number(r"\| Venues: (\d+)/").alias("venues_done"),
            number(r"\| Venues: \d+/(\d+)").alias("venues_total"),
            number(r"\| Measurements: (\d+)").alias("measurements"),
            number(r"\| API calls: (\d+)").alias("api_calls"),
            F.when(collected, "Collected").otherwise(F.regexp_extract("line", r"\| ([^|]*)$", 1)).alias("status"),
        )
    )


def collection_log(lines: DataFrame) -> DataFrame:
    """Runs, rows and calls per day."""
    return (
        parse_log(lines)
        .groupBy(F.to_date("run_time").alias("run_date"))
        .agg(
            F.count("*").alias("log_lines"),
            F.count(F.when(F.col("status") == "Collected", 1)).alias("runs"),
            F.coalesce(F.sum("measurements"), F.lit(0)).alias("measurements"),
            F.coalesce(F.sum("api_calls"), F.lit(0)).alias("api_calls"),
            F.max("venues_total").alias("max_venues"),
        )
    )
