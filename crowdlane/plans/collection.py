"""Planning rules: what to measure, when, and how much of the budget it takes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from crowdlane.functions import clock
from crowdlane.functions.clock import col
from crowdlane.operators.ranking import venue_groups

# An event is major when its category contains one of these.
MAJOR_CATEGORIES = [
    "Sports", "Sports/Fitness", "Festival", "Festivals & Special Events", "Music", "Concerts & Music",
]
MAJOR_DIRECTIONS = ["North", "South", "East", "West"]
MINOR_DIRECTIONS = ["North", "South"]

# Daily baseline slots, minutes after midnight.
BASELINE_SLOTS = [420, 720, 1020, 1140, 1260, 1380]

# Traffic patterns in the order they are tried.
CATEGORY_PATTERNS = [
    "Sports", "Sports/Fitness", "Music", "Festival", "Festivals & Special Events", "Theatre",
    "Arts & Culture", "Food, Wine & Beer", "General",
]

COST_PER_CALL = 0.007
MONTHLY_CREDIT = 200.0
DAILY_LIMIT = 2500
TOLERANCE = 15


def is_major(category: Column | str) -> Column:
    """Category holds a major name, ignoring case; a missing category is minor."""
    low = F.lower(col(category))
    hit = reduce(lambda a, b: a | b, [low.contains(name.lower()) for name in MAJOR_CATEGORIES])
    return F.coalesce(hit, F.lit(False))


def collection_plan(events: DataFrame) -> DataFrame:
    """How traffic is to be collected for each event."""
    collect, major = F.col("start_sec").isNotNull(), is_major("category")
    kind = F.concat(
        F.when(major, "major").otherwise("minor"),
        F.when(F.coalesce("is_multi_day", F.lit(False)), "_multi_day").otherwise("_single_day"),
    )
    directions = F.when(major, F.array(*[F.lit(d) for d in MAJOR_DIRECTIONS])).otherwise(
        F.array(*[F.lit(d) for d in MINOR_DIRECTIONS])
    )
    return events.select(
        "event_id",
        "event_name",
        "category",
        "event_start_date",
        "start_sec",
        collect.alias("collect"),
        F.when(~collect, "No event time available").alias("reason"),
        F.when(collect, kind).alias("plan_type"),
        F.when(collect, True).alias("collect_before"),
        F.when(collect, major).alias("collect_after"),
        F.when(collect, 1).alias("hours_before"),
        F.when(collect & major, 1).alias("hours_after"),
        F.when(collect, F.size(directions)).alias("num_directions"),
        F.when(collect, directions).alias("directions"),
        F.when(collect, F.when(major, 8).otherwise(2)).otherwise(0).alias("estimated_calls"),
    )


def monthly_call_estimate(events: DataFrame) -> DataFrame:
    """Calls per plan type and one total line (no type) with cost and remaining credit."""
    lines = (
        collection_plan(events)
        .groupBy("plan_type")
        .agg(F.count("*").alias("n"), F.sum("estimated_calls").alias("calls"))
        .rollup("plan_type")
        .agg(
            F.grouping("plan_type").alias("_total"),
            F.coalesce(F.sum("calls"), F.lit(0)).alias("calls"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("events_processed"),
            F.coalesce(F.sum(F.when(F.col("plan_type").isNull(), F.col("n"))), F.lit(0)).alias("events_skipped"),
        )
    )
    # inside the total line every plan type reads NULL, so skipped rows are taken from the detail
    skipped = F.when(
        F.col("_total") == 1, events.agg(F.count(F.when(F.col("start_sec").isNull(), 1))).scalar()
    ).otherwise(F.lit(0))
    cost = F.round(F.col("calls") * COST_PER_CALL, 2)
    return (
        lines.filter("_total = 1 OR plan_type IS NOT NULL")
        .select(
            "plan_type",
            "calls",
            "events_processed",
            skipped.alias("events_skipped"),
            cost.alias("estimated_cost"),
            F.when(F.col("_total") == 1, F.round(MONTHLY_CREDIT - cost, 2)).alias("remaining_credit"),
        )
        .orderBy(F.asc_nulls_last("plan_type"))
    )


def baseline_week_group(ts: Column | str, groups: int = 4) -> Column:
    """Rotation group of a date: by quarter of the month, or the two-group calendar (weeks 2 and 4)."""
    day = F.dayofmonth(col(ts))
    if groups == 2:
        return F.when(day.between(8, 14), 1).when(day.between(22, 30), 2)
    return F.least(F.floor((day - 1) / 7) + 1, F.lit(4)).cast("int")


def baseline_slot(ts: Column | str) -> Column:
    """The daily slot (minutes after midnight) within 15 minutes of a time; NULL between slots."""
    minute = F.hour(col(ts)) * 60 + F.minute(col(ts))
    slots = F.array(*[F.lit(s) for s in BASELINE_SLOTS])
    return F.get(F.filter(slots, lambda s: F.abs(minute - s) <= TOLERANCE), F.lit(0))


def slot_label(slot: Column) -> Column:
    return F.concat(
        F.lpad(F.floor(slot / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((slot % 60).cast("string"), 2, "0")
    )


def baseline_plan(venues: DataFrame, as_of: str, groups: int = 4) -> DataFrame:
    """Planned baseline visits of the day: the active group's venues times the six slots."""
    active = baseline_week_group(clock.moment(as_of), groups)
    day = F.to_date(clock.moment(as_of))
    return (
        venue_groups(venues, groups)
        .filter(F.col("venue_group") == active)
        .select(
            "venue_id",
            "venue_name",
            "venue_group",
            day.alias("plan_date"),
            F.explode(F.array(*[F.lit(s) for s in BASELINE_SLOTS])).alias("slot"),
        )
        .withColumn("time_slot", slot_label(F.col("slot")))
    )


def nearest_collection_offset(minutes: Column, reach: int = 120, step: int = 30) -> Column:
    """Collection point nearest to ``minutes`` after the event start; NULL further than 15 from any.

    Halfway between two points the later one wins: the rule is stated on the time
    left until the event, where the lower point wins.
    """
    left = -minutes
    point = F.least(F.greatest(F.ceil((left - TOLERANCE) / step) * step, F.lit(-reach)), F.lit(reach))
    return F.when(F.abs(left) <= reach + TOLERANCE, -point).cast("int")


def window_label(offset: Column) -> Column:
    return F.when(offset < -TOLERANCE, "before").when(offset > TOLERANCE, "after").when(offset.isNotNull(), "during")


def event_collection_point(events: DataFrame, as_of: str) -> DataFrame:
    """Events at a collection point at ``as_of``, with its offset (negative = before the start)."""
    minutes = clock.hours_between(clock.start_ts(), clock.moment(as_of)) * 60
    return (
        events.filter("start_sec IS NOT NULL")
        .select("event_id", "event_name", minutes.alias("minutes_from_start"))
        .withColumn("collection_point", nearest_collection_offset(F.col("minutes_from_start")))
        .filter("collection_point IS NOT NULL")
        .withColumn("window", window_label(F.col("collection_point")))
    )


def planned_points(events: DataFrame, as_of: str, reach: int = 120, step: int = 30) -> DataFrame:
    """Every planned measurement of every timed event and whether it is past, due or ahead."""
    now = clock.moment(as_of)
    planned = F.timestamp_add("MINUTE", F.col("offset_minutes"), F.col("event_datetime"))
    age = F.timestamp_diff("SECOND", F.col("planned_time"), now)
    return (
        events.filter("start_sec IS NOT NULL")
        .select(
            "event_id",
            "venue_id",
            clock.start_ts().alias("event_datetime"),
            F.explode(F.sequence(F.lit(-reach), F.lit(reach), F.lit(step))).alias("offset_minutes"),
        )
        .withColumn("planned_time", planned)
        .select(
            "event_id",
            "venue_id",
            "event_datetime",
            "offset_minutes",
            "planned_time",
            window_label(F.col("offset_minutes")).alias("window"),
            F.when(F.col("planned_time") >= now, "upcoming")
            .when(age < 1800, "now")
            .otherwise("completed")
            .alias("status"),
        )
    )


def slot_coverage(venues: DataFrame, meas: DataFrame, as_of: str, groups: int = 4) -> DataFrame:
    """Planned baseline visits of the day and the rows found at each; 0 is a missed slot.

    The facts are cut to the day by plain bounds and counted per (venue, slot)
    before they meet the plan.
    """
    day = F.to_date(clock.moment(as_of))
    lo, hi = day.cast("timestamp_ntz"), F.date_add(day, 1).cast("timestamp_ntz")
    found = (
        clock.measured_since(meas, lo, before=hi)
        .filter(F.col("is_baseline") == F.lit(True))
        .select("venue_id", baseline_slot("measurement_time").alias("slot"))
        .filter("slot IS NOT NULL")
        .groupBy("venue_id", "slot")
        .agg(F.count("*").alias("n"))
    )
    return (
        baseline_plan(venues, as_of, groups)
        .join(found, ["venue_id", "slot"], "left")
        .select(
            "venue_id",
            "venue_group",
            "plan_date",
            "time_slot",
            F.coalesce("n", F.lit(0)).alias("measurements"),
            F.col("n").isNull().alias("missed"),
        )
    )


def budget_cap(plan: DataFrame, order: list[Column], max_calls: int, calls: str = "estimated_calls") -> DataFrame:
    """Plan rows processed before the call budget is used up, in order.

    A row is started while fewer than ``max_calls`` calls were made, so the last
    one may overshoot. Rows cost at least one call each (others need no budget and
    are left out), hence no more than ``max_calls`` rows can be started: the exact
    top list of that length is enough for the running sum.
    """
    first = plan.filter(F.col(calls) > 0).orderBy(*order).limit(max_calls)
    running = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        first.withColumn("calls_so_far", F.sum(calls).over(running))
        .filter(F.col("calls_so_far") - F.col(calls) < max_calls)
    )


def category_pattern(category: Column | str) -> Column:
    """First listed pattern contained in the category (case matters), else General."""
    names = F.array(*[F.lit(p) for p in CATEGORY_PATTERNS])
    hits = F.filter(names, lambda p: col(category).contains(p))
    return F.coalesce(F.get(hits, F.lit(0)), F.lit("General"))


def daily_usage_forecast(events: DataFrame, venues: DataFrame, as_of: str) -> DataFrame:
    """Calls of the day, made and still to come: baseline slots and event points.

    Baseline runs in the two-group calendar with half of all venues, four calls per
    slot; an event has five points of two calls. A slot counts as made from its
    minute on, a later one of the running hour as neither. The line ``total`` adds both; ``cost`` is that of
    the event calls, which are paid for, and ``monthly_calls`` what they come to if every day is alike.
    """
    now = clock.moment(as_of)
    hour, minute = F.hour(now), F.minute(now)
    group = baseline_week_group(now, groups=2)
    per_slot = F.floor(F.col("venue_total") / 2) * 4
    slot_hour, slot_minute = F.floor(F.col("slot") / 60), F.col("slot") % 60
    made = (slot_hour < hour) | ((slot_hour == hour) & (slot_minute <= minute))
    ahead = slot_hour > hour
    baseline = (
        venues.agg(F.count("*").alias("venue_total"))
        .select(per_slot.alias("per_slot"), F.explode(F.array(*[F.lit(s) for s in BASELINE_SLOTS])).alias("slot"))
        .filter(group.isNotNull())
        .agg(
            F.lit("baseline").alias("collection"),
            F.coalesce(F.sum(F.when(made, F.col("per_slot"))), F.lit(0)).alias("completed_calls"),
            F.coalesce(F.sum(F.when(ahead, F.col("per_slot"))), F.lit(0)).alias("remaining_calls"),
            F.coalesce(F.sum("per_slot"), F.lit(0)).alias("total_calls"),
        )
    )
    today = events.filter(F.col("event_start_date") == F.to_date(now)).join(
        venues.select("venue_id"), "venue_id", "left_semi"
    )
    points = planned_points(today, as_of, reach=60, step=30).groupBy("status").agg((F.count("*") * 2).alias("calls"))
    event = points.agg(
        F.lit("event").alias("collection"),
        F.coalesce(F.sum(F.when(F.col("status") == "completed", F.col("calls"))), F.lit(0)).alias("completed_calls"),
        F.coalesce(F.sum(F.when(F.col("status") == "upcoming", F.col("calls"))), F.lit(0)).alias("remaining_calls"),
        F.coalesce(F.sum("calls"), F.lit(0)).alias("total_calls"),
    )
    calls = ["completed_calls", "remaining_calls", "total_calls"]
    paid = F.when(F.col("collection") == "event", F.col("total_calls")).otherwise(0)
    lines = baseline.unionByName(event).withColumn("paid", paid)
    total = lines.agg(F.lit("total").alias("collection"), *(F.sum(c).alias(c) for c in [*calls, "paid"]))
    return lines.unionByName(total).select(
        "collection",
        *calls,
        F.round(F.col("total_calls") * 100.0 / DAILY_LIMIT, 1).alias("limit_pct"),
        F.round(F.col("paid") * COST_PER_CALL, 2).alias("cost"),
        (F.col("paid") * 30).cast("bigint").alias("monthly_calls"),
    )
