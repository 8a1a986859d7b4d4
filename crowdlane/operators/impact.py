"""Traffic during events against the baseline of the same venue, weekday and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from crowdlane.functions import clock, levels
from crowdlane.operators import baseline, linking
from crowdlane.operators.skew import splittable

LISTING_DETAILS = ["event_end_date", "sponsor", "cost_description"]

VIEW_COLUMNS = [
    "event_id",
    "event_name",
    "event_start_date",
    "start_sec",
    "category",
    "is_multi_day",
    "venue_id",
    "venue_name",
    "latitude",
    "longitude",
    "event_measurements",
    "event_avg_delay",
    "event_max_delay",
    "event_avg_speed",
    "baseline_measurements",
    "baseline_avg_delay",
    "baseline_avg_speed",
    "impact_above_baseline",
]


#: what a sum is looked up by: a key of the row's own, that key with its venue, or its venue
OWN, OWN_AT_VENUE, VENUE = 0, 1, 2
KEY = ["kind", "k1", "k2", "k3"]
#: slots beside those of the baseline profile
TOTAL, STRAY = baseline.VENUE_SLOT + 1, baseline.VENUE_SLOT + 2
SUMS = ["n", "sum_delay", "n_delay", "max_delay", "sum_speed", "n_speed", "sum_distance", "n_distance"]


def _added(columns: list[str]) -> list[Column]:
    return [(F.max if c.startswith("max") else F.sum)(c).alias(c) for c in columns]


def traffic_cells(meas: DataFrame, keys: Sequence[str] = ("event_id",)) -> DataFrame:
    """Facts summed per event (``keys``), venue and, where they are baseline rows, weekday and hour.

    All sums of the impact reports are sums of these cells, so the facts are read
    and shuffled once. Rows that are neither linked nor baseline at a venue are left out.
    """
    base = F.coalesce((F.col("is_baseline") == F.lit(True)) & F.col("venue_id").isNotNull(), F.lit(False))
    return (
        meas.filter(F.col(keys[0]).isNotNull() | base)
        .groupBy(
            *keys,
            "venue_id",
            base.alias("is_baseline"),
            F.when(base, F.col("day_of_week")).alias("day_of_week"),
            F.when(base, F.col("hour_of_day")).alias("hour_of_day"),
        )
        .agg(
            F.count("*").alias("n"),
            F.sum("delay_minutes").alias("sum_delay"),
            F.count("delay_minutes").alias("n_delay"),
            F.max("delay_minutes").alias("max_delay"),
            F.sum("avg_speed_mph").alias("sum_speed"),
            F.count("avg_speed_mph").alias("n_speed"),
            F.sum("distance_miles").alias("sum_distance"),
            F.count("distance_miles").alias("n_distance"),
        )
    )


def _key(df: DataFrame, kind: int, *parts: str, **more: Column) -> Column:
    """Struct of KEY and ``more``; dates enter as day numbers, places without a part are 0."""
    types = dict(df.dtypes)
    numbers = [F.unix_date(p) if types[p] == "date" else F.col(p) for p in parts]
    numbers += [F.lit(0)] * (len(KEY) - 1 - len(parts))
    return F.struct(
        F.lit(kind).alias("kind"),
        *(x.cast("bigint").alias(k) for k, x in zip(KEY[1:], numbers, strict=True)),
        *(c.alias(name) for name, c in more.items()),
    )


def _lookups(cells: DataFrame, venues: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per KEY: ``slots``, a map of at most 202 sums, and ``site``, the columns of a venue.

    Each cell counts for its event, for its event at its venue if it is a baseline row
    that should carry no event, and for the slots of its venue's baseline profile.
    """
    dow, hour = F.col("day_of_week"), F.col("hour_of_day")
    base, linked = F.col("is_baseline"), F.col(keys[0]).isNotNull()
    day_ok, hour_ok = dow.between(0, baseline.DAYS - 1), hour.between(0, baseline.HOURS - 1)

    def at_venue(when: Column, slot: Column) -> Column:
        return F.when(base & when, _key(cells, VENUE, "venue_id", slot=slot.cast("int")))

    targets = F.array_compact(
        F.array(
            F.when(linked, _key(cells, OWN, *keys, slot=F.lit(TOTAL))),
            F.when(linked & base, _key(cells, OWN_AT_VENUE, *keys, "venue_id", slot=F.lit(TOTAL))),
            at_venue(linked, F.lit(STRAY)),
            at_venue(day_ok & hour_ok, dow * baseline.HOURS + hour),
            at_venue(day_ok, dow + baseline.DAY_SLOT),
            at_venue(hour_ok, hour + baseline.HOUR_SLOT),
            at_venue(F.lit(True), F.lit(baseline.VENUE_SLOT)),
        )
    )
    per_slot = cells.select(F.inline(targets).alias(*KEY, "slot"), *SUMS).groupBy(*KEY, "slot").agg(*_added(SUMS))
    sites = venues.select(
        _key(venues, VENUE, "venue_id").alias("key"), F.struct("venue_name", "latitude", "longitude").alias("site")
    ).filter(F.col("key.k1").isNotNull())
    entries = per_slot.select(*KEY, F.struct("slot", F.struct(*SUMS).alias("sums")).alias("entry")).unionByName(
        sites.select("key.*", "site"), allowMissingColumns=True
    )
    return entries.groupBy(*KEY).agg(
        F.map_from_entries(F.collect_list("entry")).alias("slots"), F.max("site").alias("site")
    )


def _with_traffic(
    rows: DataFrame, venues: DataFrame, meas: DataFrame, keys: Sequence[str], dow: Column, hour: Column
) -> DataFrame:
    """Add venue columns, event traffic and the baseline slots to rows that have unique ``keys`` and a known venue.

    A row's event traffic is the measurements linked to it plus, by the view's join
    rule, baseline rows of its venue linked to some other event. The latter should
    not exist but are not prevented. They enter as venue totals less the row's own
    share, so no event is ever paired with single measurements.

    Each row looks up three keys, all in one join, and its answers are put together
    again: only the first of the three carries the row's columns.
    """
    columns = [c for c in rows.columns if c not in ("venue_name", "latitude", "longitude")]
    asked = rows.select(
        *keys,
        F.struct(*columns).alias("row"),
        dow.alias("_dow"),
        hour.alias("_hour"),
        F.explode(
            F.array(
                _key(rows, OWN, *keys), _key(rows, OWN_AT_VENUE, *keys, "venue_id"), _key(rows, VENUE, "venue_id")
            )
        ).alias("key"),
    ).select(*keys, "key.*", F.when(F.col("key.kind") == OWN, F.col("row")).alias("row"), "_dow", "_hour")
    found = asked.join(splittable(_lookups(traffic_cells(meas, keys), venues, keys), *KEY), KEY, "left")
    kind = F.col("kind")
    answers = {
        "own": F.when(kind == OWN, F.try_element_at("slots", F.lit(TOTAL))),
        "own_stray": F.when(kind == OWN_AT_VENUE, F.try_element_at("slots", F.lit(TOTAL))),
        "stray": F.when(kind == VENUE, F.try_element_at("slots", F.lit(STRAY))),
        **{
            name: F.when(kind == VENUE, F.try_element_at("slots", slot))
            for name, slot in baseline.slots(F.col("_dow"), F.col("_hour")).items()
        },
    }
    together = (
        found.select(*keys, "row", "site", *(c.alias(name) for name, c in answers.items()))
        # the answers of a row come from three places: adding up before the shuffle would only sort for nothing
        .repartition(*keys)
        .groupBy(*keys)
        .agg(*(F.max(c).alias(c) for c in ("row", "site", *answers)))
        .filter("site IS NOT NULL")
    )

    def total(c: str) -> Column:
        parts = [F.coalesce(F.col(part)[c], F.lit(0)) for part in ("own", "stray", "own_stray")]
        return parts[0] + parts[1] - parts[2]

    return together.select(
        "row.*",
        "site.*",
        *baseline.SLOTS,
        total("n").alias("event_measurements"),
        F.try_divide(total("sum_delay").cast("double"), total("n_delay")).alias("event_avg_delay"),
        F.greatest(F.col("own")["max_delay"], F.col("stray")["max_delay"]).alias("event_max_delay"),
        F.try_divide(total("sum_speed").cast("double"), total("n_speed")).alias("event_avg_speed"),
        F.try_divide(F.col("own")["sum_distance"].cast("double"), F.col("own")["n_distance"]).alias("event_avg_distance"),
    )


def event_traffic_with_baseline(events: DataFrame, venues: DataFrame, meas: DataFrame) -> DataFrame:
    """One row per event with venue and start time: event traffic, baseline and their difference.

    The means need baseline rows of the same weekday AND hour; the baseline row
    count takes rows of the same weekday OR hour, counted as n(day) + n(hour) - n(both).
    Beyond ``VIEW_COLUMNS`` come listing details, the mean distance and the best
    baseline tier; they cost nothing unless used and save later reports a join.
    """
    dow, hour = clock.day_of_week("event_start_date"), clock.hour_of("start_sec")
    details = [c for c in LISTING_DETAILS if c in events.columns]
    timed = events.filter("start_sec IS NOT NULL").select(
        "event_id", "event_name", "event_start_date", "start_sec", "category", "is_multi_day", "venue_id", *details
    )

    def n(slot: str) -> Column:
        return F.coalesce(F.col(slot)["n"], F.lit(0))

    return (
        _with_traffic(timed, venues, meas, ["event_id"], dow, hour)
        .withColumns(
            {
                "baseline_measurements": n("same_day") + n("same_hour") - n("exact"),
                "baseline_avg_delay": baseline.mean_delay(F.col("exact")),
                "baseline_avg_speed": baseline.mean_speed(F.col("exact")),
                "best_baseline": baseline.best_tier(),
            }
        )
        .withColumn("impact_above_baseline", F.col("event_avg_delay") - F.col("baseline_avg_delay"))
        .select(*VIEW_COLUMNS, *details, "event_avg_distance", "best_baseline")
    )


def event_impact_detail(impact: DataFrame) -> DataFrame:
    """The impact rows with listing details, severity and data quality, newest first.

    ``impact`` has one row per event and already carries venue and details, so this
    is a projection.
    """
    return (
        impact.select(
            "event_id",
            "event_name",
            "event_start_date",
            "start_sec",
            "event_end_date",
            "category",
            "sponsor",
            "cost_description",
            "is_multi_day",
            "venue_id",
            "venue_name",
            "latitude",
            "longitude",
            "event_measurements",
            "baseline_measurements",
            "event_avg_delay",
            "baseline_avg_delay",
            "event_avg_speed",
            "baseline_avg_speed",
            "event_max_delay",
            "impact_above_baseline",
            levels.impact_level("impact_above_baseline", "detail").alias("impact_level"),
            levels.data_quality("event_measurements", "baseline_measurements").alias("data_quality"),
        )
    )


def event_impact_summary(impact: DataFrame) -> DataFrame:
    """Events with traffic and their simplified severity."""
    return impact.filter("event_measurements > 0").select(
        "event_id",
        "event_name",
        "event_start_date",
        "start_sec",
        "category",
        "venue_name",
        "venue_id",
        "event_measurements",
        "baseline_measurements",
        "event_avg_delay",
        "baseline_avg_delay",
        "impact_above_baseline",
        levels.impact_level("impact_above_baseline", "summary").alias("impact_level"),
    )


def category_traffic_impact(impact: DataFrame) -> DataFrame:
    """Impact per category over events with traffic; events without category form one group.

    ``impact`` has one row per event, so distinct events are plain row counts and
    the whole report is one map-side combined aggregate.
    """
    x = F.col("impact_above_baseline")
    return (
        impact.filter("event_measurements > 0")
        .groupBy("category")
        .agg(
            F.count("*").alias("event_count"),
            F.count(x).alias("events_with_baseline"),
            F.avg(x).alias("avg_impact_minutes"),
            F.max(x).alias("max_impact_minutes"),
            F.min(x).alias("min_impact_minutes"),
            F.avg("event_avg_delay").alias("avg_event_delay"),
            F.avg("baseline_avg_delay").alias("avg_baseline_delay"),
            F.round(F.try_divide(F.count(F.when(x > 2, 1)) * 100.0, F.count("*")), 1).alias("pct_high_impact"),
        )
        .orderBy(F.desc_nulls_last("avg_impact_minutes"), "category")
    )


def category_speed_impact(impact: DataFrame) -> DataFrame:
    """Mean event and baseline speed per category over events with traffic."""
    return (
        impact.filter("event_measurements > 0")
        .groupBy("category")
        .agg(
            F.count("*").alias("event_count"),
            F.avg("event_avg_speed").alias("avg_event_speed"),
            F.avg("baseline_avg_speed").alias("avg_baseline_speed"),
            F.avg(F.col("baseline_avg_speed") - F.col("event_avg_speed")).alias("avg_speed_difference"),
        )
        .orderBy(F.desc_nulls_last("avg_speed_difference"), "category")
    )


def speed_impact(impact: DataFrame) -> DataFrame:
    """Minutes lost over the mean measured distance, event speed against the best baseline tier."""
    minutes = levels.speed_impact_minutes(
        F.col("event_avg_distance"), F.col("event_avg_speed"), F.col("baseline_speed")
    )
    return (
        impact.filter("event_measurements > 0")
        .select(
            "event_id",
            "event_measurements",
            "event_avg_distance",
            "event_avg_speed",
            F.coalesce("best_baseline.tier", F.lit("none")).alias("baseline_tier"),
            F.col("best_baseline.delay").alias("baseline_delay"),
            F.col("best_baseline.speed").alias("baseline_speed"),
        )
        .withColumn("speed_impact_minutes", minutes)
        .withColumn("impact_level", levels.impact_level("speed_impact_minutes", "summary"))
    )


def link_to_occurrences(meas: DataFrame, events: DataFrame) -> DataFrame:
    """Measurements with the nearest occurrence (event_id, occurrence_date) of their venue.

    Candidate rows are those not flagged baseline; the rest keep NULL keys.
    """
    points = (
        linking.occurrences(events)
        .select(
            "venue_id",
            clock.start_micros("occurrence_date").alias("start_us"),
            F.struct("event_id", "occurrence_date").alias("point"),
        )
        .filter(F.col("venue_id").isNotNull() & F.col("start_us").isNotNull())
    )
    rows = meas.drop("event_id")
    near = linking.nearest_point(rows.filter(F.col("is_baseline") == F.lit(False)), points)
    rest = rows.filter(F.col("is_baseline").isNull() | (F.col("is_baseline") == F.lit(True)))
    linked = near.withColumn("is_baseline", F.lit(False)).select("*", "nearest.*").drop("nearest")
    return linked.unionByName(rest, allowMissingColumns=True)


def occurrence_impact(events: DataFrame, venues: DataFrame, meas: DataFrame) -> DataFrame:
    """Impact of every day of an event against the baseline of that day's weekday and hour.

    ``meas`` carries (event_id, occurrence_date) links. Here the baseline count,
    like the means, takes only rows of the same weekday and hour.
    """
    dow, hour = clock.day_of_week("occurrence_date"), clock.hour_of("start_sec")
    days = linking.occurrences(events).select(
        "event_id", "occurrence_date", "event_name", "start_sec", "category", "venue_id"
    )
    looked_up = _with_traffic(days, venues, meas, ["event_id", "occurrence_date"], dow, hour).withColumns(
        {
            "baseline_measurements": F.coalesce("exact.n", F.lit(0)),
            "baseline_delay": baseline.mean_delay(F.col("exact")),
        }
    )
    return looked_up.select(
        "event_id",
        "occurrence_date",
        "event_name",
        "start_sec",
        "category",
        "venue_name",
        F.col("event_avg_delay").alias("event_delay"),
        "event_measurements",
        "baseline_delay",
        "baseline_measurements",
        (F.col("event_avg_delay") - F.col("baseline_delay")).alias("impact_above_baseline"),
    )
