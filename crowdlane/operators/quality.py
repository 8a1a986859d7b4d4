"""Quality checks and repairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from crowdlane.functions import clock
from crowdlane.operators.upserts import EVENT_KEY, VENUE_KEY

# Usual start time (seconds after midnight) and attendance per category.
DEFAULT_START = {
    "Sports": 68400,
    "Sports - Baseball": 66900,
    "Sports - Basketball": 68400,
    "Music": 72000,
    "Festival": 36000,
    "Arts & Culture": 68400,
    "Theater": 70200,
    "Food & Drink": 64800,
    "Market": 32400,
    "General": 64800,
}
DEFAULT_ATTENDANCE = {
    "Sports": 5000,
    "Sports - Baseball": 6000,
    "Sports - Basketball": 15000,
    "Music": 3000,
    "Festival": 10000,
    "Arts & Culture": 500,
    "Theater": 800,
    "Food & Drink": 1000,
    "Market": 2000,
    "General": 500,
}


def _issues(df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """(issue, count, impact) of several checks from one pass over ``df``."""
    counted = df.agg(*[F.count(F.when(cond, 1)).alias(f"c{i}") for i, (_, _, cond) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(F.lit(issue).alias("issue"), F.col(f"c{i}").alias("count"), F.lit(impact).alias("impact"))
            for i, (issue, impact, _) in enumerate(checks)
        ]
    )
    return counted.select(F.inline(rows))


def data_quality_check(events: DataFrame, venues: DataFrame, meas: DataFrame) -> DataFrame:
    """Seven known problems with their row counts; one pass per table."""
    baseline = F.col("is_baseline") == F.lit(True)
    not_baseline = F.col("is_baseline") == F.lit(False)
    of_events = _issues(
        events,
        [
            (
                "Events without times",
                "Events need event_start_time for collection",
                F.col("start_sec").isNull(),
            ),
            ("Events without venue", "Events need venue_id for geocoding", F.col("venue_id").isNull()),
        ],
    )
    of_venues = _issues(
        venues,
        [
            (
                "Venues without coordinates",
                "Venues need lat/lng for traffic collection",
                F.col("latitude").isNull() | F.col("longitude").isNull(),
            )
        ],
    )
    of_rows = _issues(
        meas,
        [
            (
                "Traffic without event or baseline flag",
                "Measurements should have event_id OR is_baseline=TRUE",
                F.col("event_id").isNull() & not_baseline,
            ),
            ("Traffic missing day_of_week", "Should be auto-calculated", F.col("day_of_week").isNull()),
            ("Traffic missing hour_of_day", "Should be auto-calculated", F.col("hour_of_day").isNull()),
            (
                "Baseline without baseline_type",
                "Baseline should have type (weekly/monthly)",
                baseline & F.col("baseline_type").isNull(),
            ),
        ],
    )
    return of_events.unionByName(of_venues).unionByName(of_rows).orderBy(F.desc("count"), "issue")


def key_violations(events: DataFrame, venues: DataFrame) -> DataFrame:
    """Unique keys that occur more than once; keys with a NULL part cannot clash."""

    def repeated(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
        text = F.concat_ws(" | ", *[F.col(k).cast("string") for k in key])
        return (
            df.filter(" AND ".join(f"{k} IS NOT NULL" for k in key))
            .groupBy(*key)
            .agg(F.count("*").alias("row_count"))
            .filter("row_count > 1")
            .select(F.lit(table).alias("table_name"), text.alias("key_value"), "row_count")
        )

    return repeated(events, "events", EVENT_KEY).unionByName(repeated(venues, "venue_locations", VENUE_KEY))


def orphan_rows(events: DataFrame, venues: DataFrame, meas: DataFrame) -> DataFrame:
    """Rows whose reference to an event or a venue leads nowhere.

    References are reduced to their distinct values before the anti join, and the
    orphans are counted per value.
    """

    def orphans(df: DataFrame, ref: str, parent: DataFrame, name: str) -> DataFrame:
        return (
            df.filter(F.col(ref).isNotNull())
            .groupBy(ref)
            .agg(F.count("*").alias("row_count"))
            .join(parent.select(ref), ref, "left_anti")
            .select(F.lit(name).alias("reference"), F.col(ref).alias("missing_id"), "row_count")
        )

    return (
        orphans(events, "venue_id", venues, "events.venue_id")
        .unionByName(orphans(meas, "event_id", events, "traffic_measurements.event_id"))
        .unionByName(orphans(meas, "venue_id", venues, "traffic_measurements.venue_id"))
    )


def backfill_time_metadata(meas: DataFrame) -> DataFrame:
    """Weekday and hour taken from the timestamp where either is missing."""
    missing = F.col("day_of_week").isNull() | F.col("hour_of_day").isNull()
    return meas.withColumns(
        {
            "day_of_week": F.when(missing, clock.day_of_week("measurement_time")).otherwise(F.col("day_of_week")),
            "hour_of_day": F.when(missing, F.hour("measurement_time")).otherwise(F.col("hour_of_day")),
        }
    )


def time_metadata_gaps(meas: DataFrame) -> DataFrame:
    """One row: rows lacking metadata, rows repaired, rows still lacking it."""
    missing = F.col("day_of_week").isNull() | F.col("hour_of_day").isNull()
    no_time = F.col("measurement_time").isNull()
    return meas.agg(
        F.count(F.when(missing, 1)).alias("missing_before"),
        F.count(F.when(missing & ~no_time, 1)).alias("repaired"),
        F.count(F.when(missing & no_time, 1)).alias("missing_after"),
    )


def _lookup(values: Mapping[str, int], key: str) -> Column:
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.when(F.col(key).isNotNull(), F.try_element_at(table, F.col(key)))


def fill_estimated_defaults(events: DataFrame) -> DataFrame:
    """Usual start time and attendance of the category where missing; exact category names only.

    The lookups are ten fixed entries each, so they are map literals, not joins.
    """
    return events.withColumns(
        {
            "start_sec": F.coalesce("start_sec", _lookup(DEFAULT_START, "category")),
            "expected_attendance": F.coalesce("expected_attendance", _lookup(DEFAULT_ATTENDANCE, "category")),
        }
    )


def baseline_type_backfill(meas: DataFrame) -> DataFrame:
    """Type weekly on every baseline row, none elsewhere; baseline rows get day and hour anew."""
    flag = F.col("is_baseline") == F.lit(True)
    return meas.withColumns(
        {
            "baseline_type": F.when(flag, "weekly"),
            "day_of_week": F.when(flag, clock.day_of_week("measurement_time")).otherwise(F.col("day_of_week")),
            "hour_of_day": F.when(flag, F.hour("measurement_time")).otherwise(F.col("hour_of_day")),
        }
    )


def baseline_with_event(meas: DataFrame) -> DataFrame:
    """Rows flagged baseline that also name an event, counted per venue."""
    return (
        meas.filter((F.col("is_baseline") == F.lit(True)) & F.col("event_id").isNotNull())
        .groupBy("venue_id")
        .agg(F.count("*").alias("row_count"))
    )
