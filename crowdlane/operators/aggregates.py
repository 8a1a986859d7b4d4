"""Counts, coverage and usage reports over the base tables.

Facts are aggregated by key before they meet a dimension, so a join moves one row
per key instead of every measurement. "Now" is always the ``as_of`` argument.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crowdlane.functions import clock
from crowdlane.operators.skew import splittable

SOURCES = ["google_maps", "tomtom"]


def _is(c: str, value: bool) -> Column:
    return F.col(c) == F.lit(value)


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def floor_percent(part: Column, whole: Column) -> Column:
    """Whole percent, rounded down; 0 of nothing is 0."""
    return F.when(whole > 0, F.floor(part * 100 / whole)).otherwise(F.lit(0)).cast("bigint")


def traffic_summary_by_venue(venues: DataFrame, meas: DataFrame) -> DataFrame:
    """Measurement count, delay and first/last time of every venue, also those with none."""
    per_venue = (
        meas.filter("venue_id IS NOT NULL")
        .groupBy("venue_id")
        .agg(
            F.count("measurement_id").alias("n"),
            F.avg("delay_minutes").alias("avg_delay_minutes"),
            F.max("delay_minutes").alias("max_delay_minutes"),
            F.min("measurement_time").alias("first_measurement"),
            F.max("measurement_time").alias("last_measurement"),
        )
    )
    return (
        venues.select("venue_id", "venue_name")
        .join(per_venue, "venue_id", "left")
        .select(
            "venue_id",
            "venue_name",
            F.coalesce("n", F.lit(0)).alias("measurement_count"),
            "avg_delay_minutes",
            "max_delay_minutes",
            "first_measurement",
            "last_measurement",
        )
    )


def top_venues_by_measurements(venues: DataFrame, meas: DataFrame, k: int = 10) -> DataFrame:
    return (
        traffic_summary_by_venue(venues, meas)
        .select("venue_id", "venue_name", "measurement_count", "avg_delay_minutes")
        .orderBy(F.desc("measurement_count"), "venue_id")
        .limit(k)
    )


def api_usage_by_day(meas: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Calls per day and source since ``days`` days before the day of ``as_of``."""
    since = F.date_sub(F.to_date(clock.moment(as_of)), days).cast("timestamp_ntz")
    return (
        clock.measured_since(meas, since)
        .groupBy(F.to_date("measurement_time").alias("date"), "data_source")
        .agg(
            F.count("*").alias("api_calls"),
            _count_if(_is("is_baseline", True)).alias("baseline_calls"),
            _count_if(F.col("event_id").isNotNull()).alias("event_calls"),
            F.min("measurement_time").alias("first_call"),
            F.max("measurement_time").alias("last_call"),
        )
        .withColumns(
            {
                f"{s}_calls": F.when(F.col("data_source") == s, F.col("api_calls")).otherwise(F.lit(0))
                for s in SOURCES
            }
        )
        .orderBy(F.desc("date"), "data_source")
    )


def usage_7day_pivot(meas: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Calls per day and provider over the last days, and one total line with the daily mean.

    Calls of providers without a column, or of none, are ``other_calls``; totals and mean count every call.
    Days without calls have no line; the mean divides by ``days``. The total line
    has no date.
    """
    since = F.date_sub(F.to_date(clock.moment(as_of)), days).cast("timestamp_ntz")
    known = [F.count_if(F.col("data_source") == s).alias(s) for s in SOURCES]
    per_line = (
        clock.measured_since(meas, since)
        .withColumn("date", F.to_date("measurement_time"))
        .rollup("date")
        .agg(F.grouping("date").alias("_total"), *known, F.count(F.lit(1)).alias("total_calls"))
    )
    return (
        per_line.filter("_total = 1 OR date IS NOT NULL")
        .select(
            "date",
            *SOURCES,
            (F.col("total_calls") - F.col("google_maps") - F.col("tomtom")).alias("other_calls"),
            "total_calls",
            F.when(F.col("_total") == 1, F.col("total_calls") / float(days)).alias("avg_per_day"),
        )
        .orderBy(F.desc_nulls_last("date"))
    )


def activity_sums() -> list[Column]:
    """Sums of measurements that later sums can be made of."""
    return [
        F.count("*").alias("n"),
        _count_if(_is("is_baseline", True)).alias("n_baseline"),
        F.sum("delay_minutes").alias("sum_delay"),
        F.count("delay_minutes").alias("n_delay"),
        F.min("measurement_time").alias("first_time"),
        F.max("measurement_time").alias("last_time"),
    ]


def activity_by_hour(cells: DataFrame) -> DataFrame:
    """Activity per hour and source from ``cells`` per (collection_hour, data_source, venue_id, event_id)."""
    return cells.groupBy("collection_hour", "data_source").agg(
        F.sum("n").alias("measurements"),
        F.sum("n_baseline").alias("baseline_count"),
        F.sum(F.when(F.col("event_id").isNotNull(), F.col("n")).otherwise(0)).alias("event_count"),
        F.countDistinct("venue_id").alias("venues_measured"),
        F.countDistinct("event_id").alias("events_measured"),
        F.try_divide(F.sum("sum_delay").cast("double"), F.sum("n_delay")).alias("avg_delay"),
        F.min("first_time").alias("first_measurement"),
        F.max("last_time").alias("last_measurement"),
    )


def hourly_activity(meas: DataFrame) -> DataFrame:
    """Collection activity per hour and source.

    Both distinct counts are exact and come from a first grouping by (hour, source,
    venue, event): a crowded hour is spread over its venues and events before it
    becomes one row.
    """
    hour = clock.start_of_hour("measurement_time").alias("collection_hour")
    return activity_by_hour(meas.groupBy(hour, "data_source", "venue_id", "event_id").agg(*activity_sums()))


def recent_collection_activity(meas: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    since = clock.moment(as_of) - F.make_interval(hours=F.lit(hours))
    return hourly_activity(clock.measured_since(meas, since, after=True)).orderBy(
        F.desc("collection_hour"), "data_source"
    )


def collection_status_summary(events: DataFrame, venues: DataFrame, meas: DataFrame, as_of: str) -> DataFrame:
    """One row of totals over the three tables.

    The fact table is read once: a first grouping by (event, venue, baseline flag)
    makes the two distinct counts cheap, and the other tables enter as scalar
    subqueries, so nothing is joined.
    """
    day_ago = clock.moment(as_of) - F.make_interval(hours=F.lit(24))
    recent = F.col("measurement_time") > day_ago
    baseline = _is("is_baseline", True)
    linked = F.col("event_id").isNotNull()
    fine = meas.groupBy("event_id", "venue_id", "is_baseline").agg(
        F.count("*").alias("n"),
        _count_if(recent).alias("n_recent"),
        _count_if(F.col("data_source") == "google_maps").alias("n_google"),
        _count_if(F.col("data_source") == "tomtom").alias("n_tomtom"),
        F.max("measurement_time").alias("last_time"),
    )

    def total(c: str, cond: Column | None = None) -> Column:
        value = F.col(c) if cond is None else F.when(cond, F.col(c))
        return F.coalesce(F.sum(value), F.lit(0))

    facts = fine.agg(
        total("n").alias("total_measurements"),
        total("n", linked).alias("event_measurements"),
        F.countDistinct("event_id").alias("events_with_traffic"),
        total("n", baseline).alias("baseline_measurements"),
        F.countDistinct(F.when(baseline, F.col("venue_id"))).alias("venues_with_baseline"),
        total("n_recent").alias("measurements_last_24h"),
        total("n_recent", baseline).alias("baseline_last_24h"),
        total("n_recent", linked).alias("event_traffic_last_24h"),
        total("n_google").alias("google_maps_calls"),
        total("n_tomtom").alias("tomtom_calls"),
        F.max("last_time").alias("last_measurement"),
        F.max(F.when(baseline, F.col("last_time"))).alias("last_baseline_collection"),
        F.max(F.when(linked, F.col("last_time"))).alias("last_event_collection"),
    )
    return facts.withColumns(
        {
            "total_events": events.agg(F.count("*")).scalar(),
            "events_with_time": events.agg(F.count("start_sec")).scalar(),
            "total_venues": venues.agg(F.count("*")).scalar(),
        }
    )


def collection_schedule_validation(events: DataFrame, meas: DataFrame, as_of: str) -> DataFrame:
    """Collection window and coverage of events within a day of ``as_of``."""
    today = F.to_date(clock.moment(as_of))
    start = clock.start_ts()
    soon = events.filter(
        F.col("start_sec").isNotNull()
        & F.col("event_start_date").between(F.date_sub(today, 1), F.date_add(today, 1))
    ).select("event_id", "event_name", start.alias("event_datetime"))
    # the few upcoming events restrict the facts before these are counted
    rows = (
        meas.filter("event_id IS NOT NULL")
        .join(soon.select("event_id"), "event_id", "left_semi")
        .groupBy("event_id")
        .agg(
            F.count("measurement_id").alias("n"),
            F.min("measurement_time").alias("first_measurement"),
            F.max("measurement_time").alias("last_measurement"),
        )
    )
    n = F.coalesce("n", F.lit(0))
    reach = F.make_interval(hours=F.lit(2))
    return (
        soon.join(rows, "event_id", "left")
        .select(
            "event_id",
            "event_name",
            "event_datetime",
            (F.col("event_datetime") - reach).alias("collection_window_start"),
            (F.col("event_datetime") + reach).alias("collection_window_end"),
            n.alias("actual_measurements"),
            "first_measurement",
            "last_measurement",
            F.when(n == 0, "No data collected")
            .when(n < 9, "Incomplete collection")
            .otherwise("Good coverage")
            .alias("collection_status"),
            clock.hours_between(clock.moment(as_of), F.col("event_datetime")).alias("hours_until_event"),
        )
        .orderBy("event_datetime", "event_id")
    )


def events_missing_traffic(events: DataFrame, venues: DataFrame, meas: DataFrame, as_of: str) -> DataFrame:
    """Timed events of known venues without any linked measurement, and the likely reason."""
    days = F.date_diff("event_start_date", F.to_date(clock.moment(as_of)))
    own = events.filter("start_sec IS NOT NULL").drop("venue_name")
    linked = meas.filter("event_id IS NOT NULL").select("event_id").distinct()
    return (
        own.join(linked, "event_id", "left_anti")
        .join(venues.select("venue_id", "venue_name"), "venue_id")
        .select(
            "event_id",
            "event_name",
            "event_start_date",
            "start_sec",
            "category",
            "venue_name",
            days.alias("days_until_event"),
            F.when(days < 0, "past").when(days == 0, "today").otherwise("future").alias("event_status"),
            F.lit(0).cast("bigint").alias("traffic_measurements"),
            F.when(days > 7, "Too far in future")
            .when(days < -7, "Event already passed")
            .when(days.between(-2, 0), "Should have data - check collector")
            .otherwise("Collection pending")
            .alias("missing_reason"),
        )
        .orderBy("event_start_date", "start_sec", "event_id")
    )


def event_statistics(events: DataFrame) -> DataFrame:
    """One row: totals, shares and mean costs of the event table."""
    total = F.col("total_events")
    counted = events.agg(
        F.count("*").alias("total_events"),
        _count_if(_is("is_multi_day", True)).alias("multi_day_events"),
        F.count("start_sec").alias("events_with_times"),
        _count_if(F.col("cost_description").isNotNull() & (F.col("cost_description") != "")).alias(
            "events_with_cost"
        ),
        _count_if(F.col("cost_min") == 0).alias("free_events"),
        _count_if(F.col("sponsor").isNotNull() & (F.col("sponsor") != "")).alias("events_with_sponsors"),
        F.avg("cost_min").alias("avg_cost_min"),
        F.avg("cost_max").alias("avg_cost_max"),
    )
    return counted.withColumns(
        {
            f"{name}_pct": floor_percent(F.col(name), total)
            for name in ("multi_day_events", "events_with_times", "events_with_cost", "events_with_sponsors")
        }
    )


def category_counts(events: DataFrame) -> DataFrame:
    """Events per category, those without one included, and how many have a start time."""
    return (
        events.groupBy("category")
        .agg(F.count("*").alias("event_count"), F.count("start_sec").alias("with_time"))
        .orderBy(F.desc("event_count"), F.asc_nulls_last("category"))
    )


def top_event_venues(events: DataFrame, k: int = 10) -> DataFrame:
    """Venue names with the most events."""
    return (
        events.filter("venue_name IS NOT NULL")
        .groupBy("venue_name")
        .agg(F.count("*").alias("event_count"))
        .orderBy(F.desc("event_count"), "venue_name")
        .limit(k)
    )


def dow_hour_distribution(meas: DataFrame) -> DataFrame:
    """Rows per weekday and rows per hour in one frame (``dimension`` tells which).

    Both come from one pass: facts shrink to (day, hour) cells first.
    """
    cells = meas.groupBy("day_of_week", "hour_of_day").agg(F.count("*").alias("n"))
    sides = cells.select(
        "n",
        F.explode(
            F.array(
                F.struct(F.lit("day_of_week").alias("dimension"), F.col("day_of_week").alias("value")),
                F.struct(F.lit("hour_of_day").alias("dimension"), F.col("hour_of_day").alias("value")),
            )
        ).alias("s"),
    )
    return (
        sides.filter("s.value IS NOT NULL")
        .groupBy("s.dimension", "s.value")
        .agg(F.sum("n").alias("measurement_count"))
        .withColumn("day_name", F.when(F.col("dimension") == "day_of_week", clock.day_name("value")))
        .orderBy("dimension", "value")
    )


def event_avg_delay_by_venue(events: DataFrame, venues: DataFrame, meas: DataFrame) -> DataFrame:
    """Mean delay of all measurements at the venue of each event, worst first.

    Grouping the raw join would weigh every event by its venue's rows; the mean per
    venue is the same number.
    """
    per_venue = (
        meas.filter("venue_id IS NOT NULL").groupBy("venue_id").agg(F.avg("delay_minutes").alias("avg_delay"))
    )
    sited = venues.select("venue_id").join(per_venue, "venue_id")
    return (
        events.select("event_id", "event_name", "venue_id")
        .join(splittable(sited, "venue_id"), "venue_id")
        .select("event_id", "event_name", "avg_delay")
        .orderBy(F.desc_nulls_last("avg_delay"), "event_id")
    )


def time_coverage(events: DataFrame) -> DataFrame:
    """One row: events, those with a time, those with an attendance, and floor percents."""
    return (
        events.agg(
            F.count("*").alias("total"),
            F.count("start_sec").alias("with_time"),
            F.count("expected_attendance").alias("with_attendance"),
        )
        .withColumn("with_time_pct", floor_percent(F.col("with_time"), F.col("total")))
        .withColumn("with_attendance_pct", floor_percent(F.col("with_attendance"), F.col("total")))
    )
