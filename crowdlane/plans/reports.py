"""Frames behind the dashboards and text reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from crowdlane.functions import levels
from crowdlane.operators.filters import numeric_coerce


def impact_breakdown(analysed: DataFrame) -> DataFrame:
    """Levels with their share and categories with their mean increase, from one pass.

    Events shrink to (level, category) cells, which then count towards both sides;
    ``part`` tells them apart, ``value`` is the percentage or the mean.
    """
    cells = analysed.groupBy("impact_level", "category").agg(
        F.count("*").alias("n"), F.sum("delay_increase").alias("s"), F.count("delay_increase").alias("c")
    )
    sides = cells.select(
        "n",
        "s",
        "c",
        F.explode(
            F.array(
                F.struct(F.lit("level").alias("part"), F.col("impact_level").alias("label")),
                F.struct(F.lit("category").alias("part"), F.col("category").alias("label")),
            )
        ).alias("side"),
    )
    grouped = sides.groupBy("side.part", "side.label").agg(
        F.sum("n").alias("event_count"),
        F.coalesce(F.try_divide(F.sum("s"), F.sum("c")), F.lit(0.0)).alias("mean"),
    )
    share = F.col("event_count") * 100.0 / F.sum("event_count").over(Window.partitionBy("part"))
    return grouped.select(
        "part", "label", "event_count", F.when(F.col("part") == "level", share).otherwise(F.col("mean")).alias("value")
    )


def category_mean_increase(analysed: DataFrame) -> DataFrame:
    """Mean delay increase per category; a category without any counts as 0."""
    return (
        analysed.groupBy("category")
        .agg(
            F.count("*").alias("event_count"),
            F.coalesce(F.avg("delay_increase"), F.lit(0.0)).alias("avg_delay_increase"),
        )
        .orderBy(F.desc("avg_delay_increase"), "category")
    )


def top_increases(analysed: DataFrame, k: int = 10) -> DataFrame:
    return (
        analysed.filter("delay_increase IS NOT NULL")
        .orderBy(F.desc("delay_increase"), "event_id")
        .limit(k)
        .select("event_id", "event_name", "category", "venue_name", "delay_increase", "impact_level")
    )


def top_categories(analysed: DataFrame) -> DataFrame:
    """Categories by mean increase with the advice of the report and whether they count as high impact."""
    return category_mean_increase(analysed).select(
        "category",
        "avg_delay_increase",
        levels.recommendation("avg_delay_increase").alias("recommendation"),
        (F.col("avg_delay_increase") > 2).alias("high_impact"),
    )


def dashboard_kpis(detail: DataFrame) -> DataFrame:
    """The four headline figures as one row."""
    return detail.agg(
        F.count(F.when(F.col("event_measurements") > 0, 1)).alias("events_analyzed"),
        F.avg("impact_above_baseline").alias("avg_impact"),
        F.count(F.when((F.col("baseline_measurements") > 0) & (F.col("event_measurements") > 0), 1)).alias(
            "events_with_baseline"
        ),
        F.count(F.when(F.col("impact_level").isin("high", "severe"), 1)).alias("high_impact_events"),
    )


def value_distribution(detail: DataFrame, column: str, skip: str | None = None) -> DataFrame:
    """Events per value of a label column, most frequent first."""
    df = detail if skip is None else detail.filter(F.col(column) != skip)
    return (
        df.groupBy(F.col(column).alias("label"))
        .agg(F.count("*").alias("event_count"))
        .orderBy(F.desc("event_count"), "label")
    )


def quality_distribution(detail: DataFrame) -> DataFrame:
    """Data quality of events with traffic, and severity of all events, in one frame and one pass."""
    cells = detail.groupBy("data_quality", "impact_level").agg(F.count("*").alias("n"))
    sides = cells.select(
        "n",
        F.explode(
            F.array(
                F.struct(F.lit("data_quality").alias("kind"), F.col("data_quality").alias("label")),
                F.struct(F.lit("impact_level").alias("kind"), F.col("impact_level").alias("label")),
            )
        ).alias("side"),
    )
    return (
        sides.filter("side.label <> 'no_event_data'")
        .groupBy("side.label", "side.kind")
        .agg(F.sum("n").alias("event_count"))
        .orderBy("kind", F.desc("event_count"), "label")
    )


def impact_bins(report: DataFrame) -> DataFrame:
    """Events per severity bin of the static report; unbinned rows are left out."""
    binned = report.withColumn("bin", levels.impact_level("impact_minutes", "bins")).filter("bin IS NOT NULL")
    return value_distribution(binned, "bin")


def map_and_timeline_points(detail: DataFrame) -> DataFrame:
    """Position, date, impact and marker size per event of an already filtered detail frame."""
    return numeric_coerce(detail).select(
        "event_id",
        "event_name",
        "venue_name",
        "category",
        "event_start_date",
        "latitude",
        "longitude",
        "impact_minutes",
        F.col("impact_above_baseline").alias("marker_size"),
        "impact_level",
    )

