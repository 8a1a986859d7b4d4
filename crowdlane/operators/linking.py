"""Events and traffic measurements of the same venue, matched by time.

The common shape is an interval join: same venue, measurement within two hours of
the event start. It is planned as an equi join on (venue, two-hour bin) with the
exact bounds as residual filter, so a venue's history is spread over many keys and
adaptive execution can split a bin that is still too large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from crowdlane.functions import clock
from crowdlane.functions.clock import MICROS, WINDOW_SECONDS
from crowdlane.operators.skew import splittable


def event_points(events: DataFrame, *carry: str | Column, default_sec: int | None = None) -> DataFrame:
    """Events that can be matched: (venue_id, start_us, carried columns).

    Events without start time are left out unless ``default_sec`` stands in for it.
    """
    sec = F.col("start_sec") if default_sec is None else F.coalesce("start_sec", F.lit(default_sec))
    return events.select("venue_id", clock.start_micros(sec=sec).alias("start_us"), *carry).filter(
        F.col("venue_id").isNotNull() & F.col("start_us").isNotNull()
    )


def start_points(events: DataFrame) -> DataFrame:
    """Distinct (venue_id, start_us) of the events.

    What happens around a start is the same for all events that share it, so it is
    worked out once and joined back: a pile of events at one place and time is not
    multiplied with the measurements there.
    """
    return event_points(events).distinct()


def window_pairs(
    points: DataFrame,
    meas: DataFrame,
    meas_cols: Sequence[str],
    seconds: int = WINDOW_SECONDS,
    instant: Column | None = None,
) -> DataFrame:
    """Every (point, measurement) pair at one venue within ``seconds``, bounds included.

    A point is repeated for the three bins its window touches and a measurement
    has one bin, so each pair appears once. Adds ``t_us``, the measurement instant,
    which is that of ``measurement_time`` unless ``instant`` gives microseconds.
    """
    reach = F.lit(seconds * MICROS)
    spread = points.withColumn(
        "_bin",
        F.explode(
            F.sequence(
                clock.time_bin(F.col("start_us") - reach, seconds), clock.time_bin(F.col("start_us") + reach, seconds)
            )
        ),
    )
    t_us = clock.micros("measurement_time") if instant is None else instant
    binned = meas.filter(F.col("venue_id").isNotNull() & t_us.isNotNull()).select(
        "venue_id", *meas_cols, t_us.alias("t_us"), clock.time_bin(t_us, seconds).alias("_bin")
    )
    return (
        spread.join(binned, ["venue_id", "_bin"])
        .filter(F.col("t_us").between(F.col("start_us") - reach, F.col("start_us") + reach))
        .drop("_bin")
    )


def hours_from_start() -> Column:
    return (F.col("t_us") - F.col("start_us")) / F.lit(3600.0 * MICROS)


def event_traffic_data(events: DataFrame, venues: DataFrame, meas: DataFrame) -> DataFrame:
    """Events with the measurements of their venue in the two-hour window."""
    located = events.join(venues.select("venue_id", F.col("venue_name").alias("_venue_name")), "venue_id")
    points = event_points(
        located,
        "event_id",
        "event_name",
        "event_start_date",
        "start_sec",
        "category",
        F.col("_venue_name").alias("venue_name"),
    )
    cols = [
        "measurement_id",
        "measurement_time",
        "traffic_level",
        "delay_minutes",
        "avg_speed_mph",
        "typical_speed_mph",
    ]
    return window_pairs(points, meas, cols).select(
        "event_id",
        "event_name",
        "event_start_date",
        "start_sec",
        "category",
        "venue_id",
        "venue_name",
        *cols,
        hours_from_start().alias("hours_from_event"),
    )


def events_with_traffic(
    events: DataFrame, meas: DataFrame, seconds: int = WINDOW_SECONDS, limit: int | None = None
) -> DataFrame:
    """Events with at least one measurement of any kind in their window, newest first; at most ``limit`` of them.

    No pairs are formed. Measurements shrink to the first and last instant per
    (venue, bin); the bin of the start lies wholly inside the window, the earlier
    one matters by its last instant and the later one by its first.
    """
    reach = F.lit(seconds * MICROS)
    t_us = clock.micros("measurement_time")
    edges = (
        meas.filter(F.col("venue_id").isNotNull())
        .select("venue_id", t_us.alias("t_us"), clock.time_bin(t_us, seconds).alias("_bin"))
        .groupBy("venue_id", "_bin")
        .agg(F.min("t_us").alias("first_us"), F.max("t_us").alias("last_us"))
    )
    points = event_points(events, "event_id", "event_start_date").withColumn(
        "_shift", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    )
    near = points.withColumn("_bin", clock.time_bin(F.col("start_us"), seconds) + F.col("_shift"))
    hit = (
        (F.col("_shift") == 0)
        | ((F.col("_shift") < 0) & (F.col("last_us") >= F.col("start_us") - reach))
        | ((F.col("_shift") > 0) & (F.col("first_us") <= F.col("start_us") + reach))
    )
    found = (
        near.join(splittable(edges, "venue_id", "_bin"), ["venue_id", "_bin"])
        .filter(hit)
        .groupBy("event_id", "event_start_date")
        .agg(F.lit(True).alias("has_traffic"))
        .drop("has_traffic")
        .orderBy(F.desc("event_start_date"), "event_id")
    )
    return found if limit is None else found.limit(limit)


def traffic_for_event(events: DataFrame, venues: DataFrame, meas: DataFrame) -> DataFrame:
    """The measurements around every event as flat rows in time order.

    An event without start time is taken to start at midnight. Rows stay flat: a
    nested list would gather a busy event in one row.
    """
    located = events.join(venues.select("venue_id", F.col("venue_name").alias("_venue_name")), "venue_id")
    points = event_points(
        located, "event_id", "event_name", "category", F.col("_venue_name").alias("venue_name"), default_sec=0
    )
    cols = [
        "measurement_id",
        "measurement_time",
        "traffic_level",
        "avg_speed_mph",
        "typical_speed_mph",
        "delay_minutes",
        "distance_miles",
    ]
    return (
        window_pairs(points, meas, cols)
        .select(
            "event_id",
            "event_name",
            "category",
            "venue_name",
            F.timestamp_add("MICROSECOND", F.col("start_us"), F.lit("1970-01-01").cast("timestamp_ntz")).alias(
                "event_datetime"
            ),
            *cols,
        )
    )


def nearest_point(meas: DataFrame, points: DataFrame, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Nearest point of the venue within ``seconds`` for each measurement, as column ``nearest``.

    ``points`` has venue_id, start_us and ``point``, the value to return; ties in
    distance go to the smallest ``point``. No pairs leave a task: points shrink to
    one row per (venue, bin) holding the bin's own distinct starts (at most one per
    second of the bin), the latest start of the bin before and the earliest of the
    bin after. Those are the only candidates, and each measurement picks among them
    in its own row. The right side is unique on the join key, so a crowded bin of
    measurements can be split freely.
    """
    starts = points.groupBy("venue_id", "start_us").agg(F.min("point").alias("point"))
    candidate = F.struct("start_us", "point")
    by_bin = (
        starts.select("venue_id", candidate.alias("c"), clock.time_bin(F.col("start_us"), seconds).alias("_home"))
        .withColumn("_shift", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
        .groupBy("venue_id", (F.col("_home") + F.col("_shift")).alias("_bin"))
        .agg(
            F.collect_list(F.when(F.col("_shift") == 0, F.col("c"))).alias("_own"),
            F.max(F.when(F.col("_shift") == 1, F.col("c"))).alias("_before"),
            F.min(F.when(F.col("_shift") == -1, F.col("c"))).alias("_after"),
        )
        .select(
            "venue_id", "_bin", F.array_compact(F.concat("_own", F.array("_before", "_after"))).alias("_candidates")
        )
    )
    t_us = clock.micros("measurement_time")
    distances = F.transform(
        F.filter("_candidates", lambda c: F.abs(c["start_us"] - F.col("_t_us")) <= seconds * MICROS),
        lambda c: F.struct(F.abs(c["start_us"] - F.col("_t_us")).alias("distance_us"), c["point"].alias("point")),
    )
    return (
        meas.withColumn("_t_us", t_us)
        .withColumn("_bin", clock.time_bin(F.col("_t_us"), seconds))
        .join(splittable(by_bin, "venue_id", "_bin"), ["venue_id", "_bin"], "left")
        .withColumn("nearest", F.array_min(distances)["point"])
        .drop("_t_us", "_bin", "_candidates")
    )


def unlinked_event_rows(meas: DataFrame) -> DataFrame:
    """Rows meant for an event but without one; a NULL baseline flag does not count as false."""
    return meas.filter(F.col("event_id").isNull() & (F.col("is_baseline") == F.lit(False)))


def match_events(meas: DataFrame, events: DataFrame, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """The closest event of each unlinked row that has one: the back-fill report.

    Beside the event's columns come its start, ``event_datetime``, and the row's ``hours_from_event``.
    """
    start = clock.start_ts().alias("event_datetime")
    points = event_points(events, F.struct("event_id", "event_name", start).alias("point"))
    return (
        nearest_point(unlinked_event_rows(meas).drop("event_id"), points, seconds)
        .filter(F.col("nearest").isNotNull())
        .select("*", "nearest.*")
        .drop("nearest")
        .withColumn("hours_from_event", clock.hours_between(F.col("event_datetime"), F.col("measurement_time")))
    )


def link_measurements(meas: DataFrame, events: DataFrame, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """All measurements, with ``event_id`` filled where a nearest event exists.

    Rows that are not candidates pass by untouched and are not shuffled. The flag
    of candidates is written as the constant it is, so a later filter on baseline
    rows drops their whole branch from the plan.
    """
    points = event_points(events, F.col("event_id").alias("point"))
    others = meas.filter(
        F.col("event_id").isNotNull() | F.col("is_baseline").isNull() | (F.col("is_baseline") == F.lit(True))
    )
    linked = (
        nearest_point(unlinked_event_rows(meas), points, seconds)
        .withColumns({"event_id": F.col("nearest"), "is_baseline": F.lit(False)})
        .select(meas.columns)
    )
    return others.unionByName(linked)


def occurrences(events: DataFrame) -> DataFrame:
    """One row per day of an event; single-day rows are kept, reversed ranges have no days.

    Multi-day needs the flag and a later end; an event that is neither single-day
    (flag false or equal dates) nor multi-day in this sense yields nothing.
    """
    multi = (F.col("is_multi_day") == F.lit(True)) & (F.col("event_end_date") > F.col("event_start_date"))
    single = (F.col("is_multi_day") == F.lit(False)) | (F.col("event_end_date") == F.col("event_start_date"))
    days = F.when(single, F.array("event_start_date")).when(
        multi, F.sequence("event_start_date", "event_end_date")
    )
    return events.withColumn("occurrence_date", F.explode(days)).withColumn(
        "is_primary_day", F.col("occurrence_date") == F.col("event_start_date")
    )


def event_occurrences(events: DataFrame) -> DataFrame:
    return occurrences(events).select("event_id", "occurrence_date", "start_sec", "is_primary_day")


def multi_day_window_match(events: DataFrame, meas: DataFrame) -> DataFrame:
    """Measurements on any day of an event whose time of day is within two hours of its start.

    The window ends at midnight: it does not wrap to the other end of the day.
    """
    days = F.when(
        F.col("event_end_date") >= F.col("event_start_date"), F.sequence("event_start_date", "event_end_date")
    )
    points = (
        events.withColumn("occurrence_date", F.explode(days))
        .select(
            "venue_id",
            "event_id",
            "occurrence_date",
            clock.start_micros("occurrence_date").alias("start_us"),
        )
        .filter(F.col("venue_id").isNotNull() & F.col("start_us").isNotNull())
    )
    return (
        window_pairs(points, meas, ["measurement_id", "measurement_time", "delay_minutes"])
        .filter(F.to_date("measurement_time") == F.col("occurrence_date"))
        .select(
            "event_id",
            "venue_id",
            "occurrence_date",
            "measurement_id",
            "measurement_time",
            "delay_minutes",
            hours_from_start().alias("hours_from_start"),
        )
    )


def before_during_after(events: DataFrame, venues: DataFrame, meas: DataFrame, keep_partial: bool = False) -> DataFrame:
    """Mean delay before (more than 15 minutes), during and after the start, inside the window.

    ``impact_minutes`` is after minus before; events lacking either are dropped
    unless ``keep_partial``.
    """
    offset = F.col("t_us") - F.col("start_us")
    edge = 15 * 60 * MICROS

    def mean(where: Column) -> Column:
        return F.avg(F.when(where, F.col("delay_minutes")))

    per_start = (
        window_pairs(start_points(events), meas, ["delay_minutes"])
        .groupBy("venue_id", "start_us")
        .agg(
            mean(offset < -edge).alias("avg_delay_before"),
            mean(F.abs(offset) <= edge).alias("avg_delay_during"),
            mean(offset > edge).alias("avg_delay_after"),
            F.count("*").alias("measurements"),
        )
        .withColumn("impact_minutes", F.col("avg_delay_after") - F.col("avg_delay_before"))
    )
    if not keep_partial:
        per_start = per_start.filter("impact_minutes IS NOT NULL")
    # venue columns join the few starts, so the events themselves are joined once
    sited = per_start.join(venues.select("venue_id", "venue_name", "latitude", "longitude"), "venue_id")
    return (
        event_points(events, "event_id", "event_name", "event_start_date", "category")
        .join(splittable(sited, "venue_id", "start_us"), ["venue_id", "start_us"])
        .drop("start_us")
    )
