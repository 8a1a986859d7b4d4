"""Positions in an order, top lists and recent rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

DIGIT = 16


def with_position(df: DataFrame, key: str) -> DataFrame:
    """1-based position of each row in the order of a unique integer ``key``, and the row total.

    A key of 64 bits is read as four digits of ``DIGIT`` bits. Rows are counted by all digits but the last,
    and these counts by fewer digits; each count is accumulated among its siblings, and rows are ranked only
    among those that agree in all but the last digit. Keys being unique, no window holds more than
    65,536 rows however the keys are spread, and the table is never sorted as a whole. The cells depend on
    the key alone, so a task that runs again sees the same ones. Rows without a key have no position and go.
    """
    coarser = lambda c: F.shiftright(c, DIGIT)
    placed = df.where(F.col(key).isNotNull()).withColumn("_cell", coarser(F.col(key).cast("bigint")))
    cells = placed.groupBy("_cell").agg(F.count("*").alias("_n"))
    ranges = cells.groupBy(coarser("_cell").alias("_range")).agg(F.sum("_n").alias("_n"))
    tops = ranges.groupBy(coarser("_range").alias("_top")).agg(F.sum("_n").alias("_n"))

    def before(window) -> Column:
        return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    tops = tops.select(
        "_top",
        before(Window.orderBy("_top")).alias("_tops_before"),
        F.sum("_n").over(Window.partitionBy()).alias("row_total"),
    )
    ranges = ranges.withColumn("_top", coarser("_range"))
    ranges = ranges.withColumn("_ranges_before", before(Window.partitionBy("_top").orderBy("_range"))).drop("_n")
    cells = cells.withColumn("_range", coarser("_cell"))
    cells = cells.withColumn("_cells_before", before(Window.partitionBy("_range").orderBy("_cell"))).drop("_n")
    offsets = cells.join(ranges.join(tops, "_top"), "_range").select(
        "_cell", F.expr("_tops_before + _ranges_before + _cells_before").alias("_before"), "row_total"
    )
    rank = F.row_number().over(Window.partitionBy("_cell").orderBy(key))
    return placed.join(offsets, "_cell").withColumn("position", F.col("_before") + rank).drop("_cell", "_before")


def venue_groups(venues: DataFrame, groups: int = 4) -> DataFrame:
    """Venues ordered by id in rotation groups of ``total // groups``; the last takes the rest."""
    size = F.floor(F.col("row_total") / groups)
    group = F.when(size == 0, groups).otherwise(F.least(F.floor((F.col("position") - 1) / size) + 1, F.lit(groups)))
    return with_position(venues.select("venue_id", "venue_name"), "venue_id").select(
        "venue_id", "venue_name", "position", group.cast("int").alias("venue_group")
    )


def top_impact_events(impact: DataFrame, k: int = 10, level: str = "impact_level") -> DataFrame:
    """The k events with the largest impact, for display."""
    return (
        impact.filter("impact_above_baseline IS NOT NULL")
        .orderBy(F.desc("impact_above_baseline"), "event_id")
        .limit(k)
        .select(
            "event_id",
            "event_name",
            "venue_name",
            "category",
            F.date_format("event_start_date", "yyyy-MM-dd").alias("event_date"),
            F.round("impact_above_baseline", 1).alias("impact_minutes"),
            level,
        )
    )


def recent_events(events: DataFrame, k: int = 10) -> DataFrame:
    return events.orderBy(F.desc_nulls_last("updated_at"), "event_id").limit(k)


def recent_measurements(meas: DataFrame, k: int = 100) -> DataFrame:
    """The latest k measurements of every venue.

    The rank filter is pushed below the shuffle, so at most k rows per venue leave
    a map task.
    """
    latest = Window.partitionBy("venue_id").orderBy(F.desc("measurement_time"), F.desc("measurement_id"))
    return (
        meas.filter("venue_id IS NOT NULL")
        .select(
            "venue_id",
            "measurement_id",
            "measurement_time",
            "traffic_level",
            "delay_minutes",
            "avg_speed_mph",
            "distance_miles",
        )
        .withColumn("recency", F.row_number().over(latest))
        .filter(F.col("recency") <= k)
    )
