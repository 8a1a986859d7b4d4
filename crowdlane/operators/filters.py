"""Selections and lookups on events, venues and impact rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from crowdlane.functions import clock
from crowdlane.operators import impact

ALL = "All"


def events_by_date_range(events: DataFrame, first: date | str, last: date | str) -> DataFrame:
    """Events starting between two days, both included."""
    lo, hi = F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")
    return events.filter(F.col("event_start_date").between(lo, hi)).orderBy("event_start_date", "event_id")


def events_by_category(events: DataFrame, category: str) -> DataFrame:
    return events.filter(F.col("category") == category).orderBy("event_start_date", "event_id")


def multi_day_events(events: DataFrame) -> DataFrame:
    return events.filter("is_multi_day = true").orderBy(F.desc("event_start_date"), "event_id")


def events_multi_day(events: DataFrame) -> DataFrame:
    """Events flagged multi-day whose dates differ, with their length in days."""
    return events.filter("is_multi_day = true AND event_start_date <> event_end_date").select(
        "event_id",
        "event_name",
        "venue_name",
        "event_start_date",
        "event_end_date",
        "start_sec",
        "end_sec",
        "category",
        "venue_id",
        (F.date_diff("event_end_date", "event_start_date") + 1).alias("duration_days"),
    )


def events_single_day(events: DataFrame) -> DataFrame:
    """Events not flagged multi-day or with equal dates; unknown on both counts drops the row."""
    return events.filter("is_multi_day = false OR event_start_date = event_end_date").select(
        "event_id",
        "event_name",
        "venue_name",
        F.col("event_start_date").alias("event_date"),
        F.col("start_sec").alias("event_sec"),
        "category",
        "venue_id",
        "created_at",
        "updated_at",
    )


def venue_by_name(venues: DataFrame, name: str) -> DataFrame:
    return venues.filter(F.col("venue_name") == name)


def all_venues(venues: DataFrame) -> DataFrame:
    return venues.orderBy("venue_name")


def events_with_venues(events: DataFrame, venues: DataFrame) -> DataFrame:
    """Events with the name and coordinates of their venue."""
    own = [c for c in events.columns if c not in ("venue_name", "latitude", "longitude")]
    return events.select(own).join(venues.select("venue_id", "venue_name", "latitude", "longitude"), "venue_id")


def events_today_with_time(events: DataFrame, venues: DataFrame, as_of: str) -> DataFrame:
    """Events starting on the day of ``as_of`` at a known time, with their venue."""
    today = events.filter(
        (F.col("event_start_date") == F.to_date(clock.moment(as_of))) & F.col("start_sec").isNotNull()
    )
    return (
        events_with_venues(today, venues)
        .select(
            "event_id",
            "event_name",
            "event_start_date",
            "start_sec",
            "category",
            "venue_id",
            "venue_name",
            "latitude",
            "longitude",
        )
        .orderBy("start_sec", "event_id")
    )


def dashboard_filter(
    detail: DataFrame,
    as_of: str,
    category: str = ALL,
    impact_level: str = ALL,
    data_quality: str = ALL,
) -> DataFrame:
    """Impact rows of the current month that meet the chosen values."""
    df = events_of_month(detail, as_of, category)
    for column, wanted in (("impact_level", impact_level), ("data_quality", data_quality)):
        if wanted != ALL:
            df = df.filter(F.col(column) == wanted)
    return df


def events_of_month(events: DataFrame, as_of: str, category: str = ALL) -> DataFrame:
    """Rows of the current month, of one category if chosen: what a dashboard can say of events before any fact is read."""
    month = F.trunc(F.to_date(clock.moment(as_of)), "month")
    # bounds on the bare column, so that partitions and row groups can be skipped
    df = events.filter((F.col("event_start_date") >= month) & (F.col("event_start_date") < F.add_months(month, 1)))
    return df if category == ALL else df.filter(F.col("category") == category)


def facts_of_events(meas: DataFrame, events: DataFrame) -> DataFrame:
    """Measurements that the impact of ``events`` depends on: linked to one of them, or baseline at one of their venues.

    Both are semi-joins with the few keys left of the events, so the facts are reduced
    before they are added up and shuffled. A baseline row that carries an event counts at its venue; a row
    passes one of the two branches only.
    """
    base = F.coalesce((F.col("is_baseline") == F.lit(True)) & F.col("venue_id").isNotNull(), F.lit(False))
    ids = events.select("event_id").distinct()
    places = events.filter("venue_id IS NOT NULL").select(F.col("venue_id").alias("_at")).distinct()
    at_venue = meas.filter(base).join(places, F.col("venue_id") == F.col("_at"), "left_semi")
    elsewhere = meas.filter(base & F.col("event_id").isNotNull()).join(
        places, F.col("venue_id") == F.col("_at"), "left_anti"
    )
    linked = meas.filter(~base & F.col("event_id").isNotNull()).unionByName(elsewhere)
    return at_venue.unionByName(linked.join(ids, "event_id", "left_semi").select(meas.columns))


def dashboard(
    events: DataFrame,
    venues: DataFrame,
    meas: DataFrame,
    as_of: str,
    category: str = ALL,
    impact_level: str = ALL,
    data_quality: str = ALL,
) -> DataFrame:
    """:func:`dashboard_filter` of the impact detail, worked out for the events of the month alone."""
    shown = events_of_month(events, as_of, category)
    rows = impact.event_traffic_with_baseline(shown, venues, facts_of_events(meas, shown))
    return dashboard_filter(impact.event_impact_detail(rows), as_of, category, impact_level, data_quality)


def numeric_coerce(detail: DataFrame) -> DataFrame:
    """Numbers for display: unreadable values become NULL, counts and impact never negative or NULL."""
    return detail.withColumns(
        {
            "impact_minutes": F.col("impact_above_baseline").try_cast("double"),
            "measurement_count": F.greatest(
                F.coalesce(F.col("event_measurements").try_cast("double"), F.lit(0.0)), F.lit(0.0)
            ),
            "impact_above_baseline": F.greatest(
                F.coalesce(F.col("impact_above_baseline").try_cast("double"), F.lit(0.0)), F.lit(0.0)
            ),
        }
    )


def speed_comparison(detail: DataFrame) -> DataFrame:
    """Events with both an event and a baseline speed."""
    return detail.filter("event_avg_speed IS NOT NULL AND baseline_avg_speed IS NOT NULL").select(
        "event_id", "event_name", "event_avg_speed", "baseline_avg_speed"
    )
