"""What traffic at a venue is like without an event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crowdlane.functions import clock
from crowdlane.functions.levels import traffic_level
from crowdlane.operators.skew import splittable

DAYS, HOURS = 7, 24
DAY_SLOT = DAYS * HOURS
HOUR_SLOT = DAY_SLOT + DAYS
VENUE_SLOT = HOUR_SLOT + HOURS


def baseline_cells(meas: DataFrame) -> DataFrame:
    """Baseline rows summed per venue, weekday and hour."""
    return (
        meas.filter((F.col("is_baseline") == F.lit(True)) & F.col("venue_id").isNotNull())
        .groupBy("venue_id", "day_of_week", "hour_of_day")
        .agg(
            F.count("*").alias("n"),
            F.sum("delay_minutes").alias("sum_delay"),
            F.count("delay_minutes").alias("n_delay"),
            F.sum("avg_speed_mph").alias("sum_speed"),
            F.count("avg_speed_mph").alias("n_speed"),
        )
    )


def baseline_profile(meas: DataFrame) -> DataFrame:
    """One row per venue: a map of at most 200 sums, addressed by slot.

    Slots 0-167 are weekday and hour, 168-174 weekday, 175-198 hour, 199 the whole
    venue. Facts are aggregated once to cells; all coarser levels come from the
    cells, and one join by venue then serves every lookup of an event.
    """
    dow, hour = F.col("day_of_week"), F.col("hour_of_day")
    cells = baseline_cells(meas)
    levels = cells.groupingSets(
        [
            [cells.venue_id, cells.day_of_week, cells.hour_of_day],
            [cells.venue_id, cells.day_of_week],
            [cells.venue_id, cells.hour_of_day],
            [cells.venue_id],
        ],
        "venue_id",
        "day_of_week",
        "hour_of_day",
    ).agg(
        F.grouping_id().alias("_level"),
        *[F.sum(c).alias(c) for c in ("n", "sum_delay", "n_delay", "sum_speed", "n_speed")],
    )
    day_ok, hour_ok = dow.between(0, DAYS - 1), hour.between(0, HOURS - 1)
    slot = (
        F.when((F.col("_level") == 0) & day_ok & hour_ok, dow * HOURS + hour)
        .when((F.col("_level") == 1) & day_ok, dow + DAY_SLOT)
        .when((F.col("_level") == 2) & hour_ok, hour + HOUR_SLOT)
        .when(F.col("_level") == 3, F.lit(VENUE_SLOT))
    )
    sums = F.struct("n", "sum_delay", "n_delay", "sum_speed", "n_speed")
    return (
        levels.select("venue_id", slot.cast("int").alias("slot"), sums.alias("sums"))
        .filter("slot IS NOT NULL")
        .groupBy("venue_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("slot", "sums"))).alias("profile"))
    )


#: the four sums that can serve as baseline of a row, best first
SLOTS = ["exact", "same_hour", "same_day", "whole_venue"]


def slots(dow: Column, hour: Column) -> dict[str, Column]:
    """Where the SLOTS of a weekday and hour are in a profile."""
    places = [dow * HOURS + hour, hour + HOUR_SLOT, dow + DAY_SLOT, F.lit(VENUE_SLOT)]
    return dict(zip(SLOTS, places, strict=True))


def with_slots(df: DataFrame, dow: Column, hour: Column) -> DataFrame:
    """Replace ``profile`` by the SLOTS of the row.

    They become columns of their own, so that each is looked up once however often
    it is mentioned later.
    """
    return df.withColumns(
        {name: F.try_element_at("profile", slot) for name, slot in slots(dow, hour).items()}
    ).drop("profile")


def mean_delay(slot: Column) -> Column:
    return F.try_divide(slot["sum_delay"].cast("double"), slot["n_delay"])


def mean_speed(slot: Column) -> Column:
    return F.try_divide(slot["sum_speed"].cast("double"), slot["n_speed"])


def best_tier() -> Column:
    """Struct (tier, delay, speed) of the best baseline among the slots; NULL without any.

    Order: same weekday and hour, same hour, same weekday, whole venue; the first
    with a mean delay wins.
    """

    def tier(name: str, slot: str) -> Column:
        s = F.col(slot)
        return F.when(
            s["n_delay"] > 0,
            F.struct(F.lit(name).alias("tier"), mean_delay(s).alias("delay"), mean_speed(s).alias("speed")),
        )

    return F.coalesce(
        tier("exact_match", "exact"),
        tier("same_hour", "same_hour"),
        tier("same_day", "same_day"),
        tier("venue_average", "whole_venue"),
    )


def baseline_match_tiers(events: DataFrame, meas: DataFrame) -> DataFrame:
    """Best available baseline of each event that has a start time, with the tier's name."""
    timed = (
        events.filter(F.col("start_sec").isNotNull() & F.col("venue_id").isNotNull())
        .select("event_id", "venue_id", "event_start_date", "start_sec")
        .join(splittable(baseline_profile(meas), "venue_id"), "venue_id", "left")
    )
    return (
        with_slots(timed, clock.day_of_week("event_start_date"), clock.hour_of("start_sec"))
        .select("event_id", "venue_id", best_tier().alias("_best"))
        .select(
            "event_id",
            "venue_id",
            F.coalesce("_best.tier", F.lit("none")).alias("baseline_tier"),
            F.col("_best.delay").alias("baseline_delay"),
            F.col("_best.speed").alias("baseline_speed"),
        )
    )


def venue_baseline_patterns(venues: DataFrame, meas: DataFrame) -> DataFrame:
    """Weekly baseline by venue, weekday and hour, with its typical level."""
    cells = baseline_cells(meas.filter(F.col("baseline_type") == "weekly"))
    return (
        venues.select("venue_id", "venue_name")
        .join(cells, "venue_id")
        .select(
            "venue_id",
            "venue_name",
            "day_of_week",
            clock.day_name("day_of_week").alias("day_name"),
            "hour_of_day",
            F.col("n").alias("measurement_count"),
            F.try_divide(F.col("sum_delay").cast("double"), "n_delay").alias("avg_delay"),
            F.try_divide(F.col("sum_speed").cast("double"), "n_speed").alias("avg_speed"),
        )
        .withColumn("typical_traffic_level", traffic_level("avg_delay", "pattern"))
        .orderBy("venue_name", F.asc_nulls_last("day_of_week"), F.asc_nulls_last("hour_of_day"))
    )


def venues_missing_baseline(venues: DataFrame, meas: DataFrame, as_of: str) -> DataFrame:
    """Baseline coverage of every venue and what is lacking.

    Distinct days and hours come from the cells, at most 7 x 24 per venue, instead
    of a distinct count over the facts.
    """
    cells = (
        meas.filter((F.col("is_baseline") == F.lit(True)) & F.col("venue_id").isNotNull())
        .groupBy("venue_id", "day_of_week", "hour_of_day")
        .agg(F.count("measurement_id").alias("n"), F.max("measurement_time").alias("last_time"))
    )
    cover = cells.groupBy("venue_id").agg(
        F.sum("n").alias("n"),
        F.size(F.collect_set("day_of_week")).alias("days_covered"),
        F.size(F.collect_set("hour_of_day")).alias("hours_covered"),
        F.max("last_time").alias("last_baseline_collection"),
    )
    days_since = clock.whole_days_between(F.col("last_baseline_collection"), clock.moment(as_of))
    return (
        venues.select("venue_id", "venue_name")
        .join(cover, "venue_id", "left")
        .select(
            "venue_id",
            "venue_name",
            F.coalesce("n", F.lit(0)).alias("total_baseline_measurements"),
            F.coalesce("days_covered", F.lit(0)).alias("days_covered"),
            F.coalesce("hours_covered", F.lit(0)).alias("hours_covered"),
            "last_baseline_collection",
            days_since.cast("bigint").alias("days_since_baseline"),
        )
        .withColumn(
            "baseline_status",
            F.when(F.col("total_baseline_measurements") == 0, "No baseline data")
            .when(F.col("days_covered") < 7, "Incomplete day coverage")
            .when(F.col("hours_covered") < 6, "Incomplete hour coverage")
            .when(F.col("days_since_baseline") > 30, "Baseline data outdated")
            .otherwise("Good coverage"),
        )
        .orderBy("total_baseline_measurements", "venue_name")
    )
