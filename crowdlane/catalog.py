"""Every query by name, run on the stand-in tables of a data folder.

Doubles are rounded to six digits at the very end, so that results compare across
engines that add in different orders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from crowdlane.functions import clock, geo, levels, pages, payloads, text
from crowdlane.operators import aggregates, baseline, filters, halves, impact, linking, quality, ranking, upserts
from crowdlane.plans import collection, reports
from crowdlane.session import shared_dir
from crowdlane.sources import listings, runlog, standins, tables
from crowdlane.sources.standins import AS_OF, AS_OF_YEAR
from crowdlane.sources.versions import Versions
from crowdlane.streaming import measurements as streams

Query = Callable[[SparkSession, str], DataFrame]


class Data:
    """The stand-in tables of one folder, built on demand; nothing is computed here."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return standins.sched(self.spark, self.sf_dir)

    @cached_property
    def venues(self) -> DataFrame:
        return standins.venue(self.spark, self.sf_dir)

    @cached_property
    def listing(self) -> DataFrame:
        return standins.listing(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> DataFrame:
        return standins.meas(self.spark, self.sf_dir)

    @cached_property
    def meas(self) -> DataFrame:
        return linking.link_measurements(self.raw, self.events)

    @cached_property
    def impact(self) -> DataFrame:
        return impact.event_traffic_with_baseline(self.events, self.venues, self.meas)

    @cached_property
    def detail(self) -> DataFrame:
        return impact.event_impact_detail(self.impact)

    @cached_property
    def analysed(self) -> DataFrame:
        return halves.impact_before_during(self.events, self.venues, self.raw)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def scratch(self, what: str) -> str:
        return f"{shared_dir(self.spark)}/crowdlane/{what}-{uuid.uuid4().hex}"


def tidy(df: DataFrame) -> DataFrame:
    # adding zero turns a negative zero into zero
    return df.withColumns(
        {f.name: F.round(f.name, 6) + F.lit(0.0) for f in df.schema.fields if isinstance(f.dataType, DoubleType)}
    )


QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[Data], DataFrame]], Callable[[Data], DataFrame]]:
    def register(fn: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(Data(spark, sf_dir)))
        return fn

    return register


# --- sources, sinks, upserts -------------------------------------------------


@query("load_tables")
def _(d: Data) -> DataFrame:
    return d.spark.sql(
        """SELECT 'events' AS table_name, count(*) AS row_count, max(event_start_date) AS latest FROM {events}
           UNION ALL SELECT 'venue_locations', count(*), NULL FROM {venues}
           UNION ALL SELECT 'traffic_measurements', count(*), cast(max(measurement_time) AS date) FROM {meas}""",
        events=d.events,
        venues=d.venues,
        meas=d.raw,
    )


def _batch(d: Data) -> DataFrame:
    """Listings to load: Sports events move by a day (mostly new keys), all prices rise by one."""
    moved = F.when(F.col("category") == "Sports", F.date_add("event_start_date", 1)).otherwise(
        F.col("event_start_date")
    )
    return d.events.select(
        (F.col("event_id") + 1).alias("input_seq"),
        "event_name",
        "venue_name",
        moved.alias("event_start_date"),
        "event_end_date",
        "start_sec",
        "category",
        (F.col("cost_min") + 1).alias("cost_min"),
        F.nullif("is_multi_day", F.lit(False)).alias("is_multi_day"),
    )


def _event_table(d: Data) -> DataFrame:
    unique = upserts.dedup_events(d.events.withColumn("input_seq", F.col("event_id")))
    return unique.drop("input_seq")


LOADED = [
    "event_id",
    "event_name",
    "venue_name",
    "venue_id",
    "event_start_date",
    "event_end_date",
    "start_sec",
    "category",
    "cost_min",
    "is_multi_day",
    "sponsor",
    "created_at",
    "updated_at",
]


@query("dedup_events")
def _(d: Data) -> DataFrame:
    batch = d.events.withColumn("input_seq", F.col("event_id"))
    return upserts.dedup_events(batch).select("event_id", "event_name", "event_start_date", "venue_name", "category")


@query("upsert_events")
def _(d: Data) -> DataFrame:
    return upserts.upsert_events(_event_table(d), _batch(d), AS_OF).select(LOADED)


def _geocoded(d: Data) -> DataFrame:
    """Geocoding results: two rows for each existing name, new names where coordinates were missing."""
    number = F.floor(F.col("venue_id") / 2).cast("string")
    name = F.when(F.col("latitude").isNull(), F.concat(F.lit("New venue "), F.col("venue_id").cast("string"))).otherwise(
        F.concat(F.lit("Customer#"), F.lpad(number, 9, "0"))
    )
    return d.venues.select(
        (F.col("venue_id") + 1).alias("input_seq"),
        name.alias("venue_name"),
        F.concat("address", F.lit(" (geocoded)")).alias("address"),
        F.coalesce("latitude", F.lit(35.0)).alias("latitude"),
        "longitude",
        "place_id",
    )


@query("upsert_venues")
def _(d: Data) -> DataFrame:
    return upserts.upsert_venues(d.venues, _geocoded(d), AS_OF)


@query("append_measurements")
def _(d: Data) -> DataFrame:
    new = d.raw.drop("day_of_week", "hour_of_day").withColumns(
        {
            "delay_minutes": F.col("avg_speed_mph") / 8 - 2.5,
            "data_source": F.nullif("data_source", F.lit("tomtom")),
            "baseline_type": F.lit("weekly"),
        }
    )
    return tables.stamp_measurements(new).select(
        "measurement_id",
        "is_baseline",
        "baseline_type",
        "data_source",
        "delay_minutes",
        "day_of_week",
        "hour_of_day",
    )


@query("link_events_to_venues")
def _(d: Data) -> DataFrame:
    unlinked = d.events.withColumn("venue_id", F.when(F.col("category").isNotNull(), F.col("venue_id")))
    return upserts.link_events_to_venues(unlinked, d.venues).select("event_id", "venue_name", "venue_id")


@query("distinct_venues")
def _(d: Data) -> DataFrame:
    return upserts.distinct_venues(d.events)


@query("venues_to_geocode")
def _(d: Data) -> DataFrame:
    return upserts.venues_to_geocode(d.events, d.venues.filter("latitude IS NOT NULL"))


@query("load_stats")
def _(d: Data) -> DataFrame:
    return upserts.load_stats(_event_table(d), _batch(d))


@query("report_tables")
def _(d: Data) -> DataFrame:
    path = d.scratch("report")
    report = impact.category_traffic_impact(d.impact)
    tables.write_report(report, path)
    return d.spark.read.schema(report.schema).json(path)


@query("collection_log")
def _(d: Data) -> DataFrame:
    stamp = F.date_format("measurement_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    group = (F.col("venue_id") % 4 + 1).cast("string")
    done = F.concat(
        stamp,
        F.lit(" | Group: "),
        group,
        F.lit(" | Time: 19:00 | Venues: "),
        F.col("venue_id").cast("string"),
        F.lit("/"),
        (F.col("venue_id") + 2).cast("string"),
        F.lit(" | Measurements: "),
        (F.col("venue_id") * 4).cast("string"),
        F.lit(" | API calls: "),
        (F.col("venue_id") * 4).cast("string"),
    )
    idle = F.concat(stamp, F.lit(" | Group "), group, F.lit(" week | Not at collection time"))
    lines = d.raw.select(F.when(F.col("is_baseline") == F.lit(True), done).otherwise(idle).alias("line"))
    return runlog.collection_log(lines)


@query("source_field_mapping")
def _(d: Data) -> DataFrame:
    c = F.col
    mapped = listings.map_sources(
        {
            "listings": (
                d.events,
                {
                    "event_name": c("event_name"),
                    "venue_name": c("venue_name"),
                    "event_start_date": c("event_start_date"),
                    "start_sec": c("start_sec"),
                    "category": c("category"),
                },
            ),
            "ballpark": (
                d.read("orders"),
                {
                    "event_name": F.concat(F.lit("Game "), c("o_orderkey").cast("string")),
                    "venue_name": F.lit("Ballpark"),
                    "event_start_date": F.to_date("o_orderdate"),
                    "category": F.lit("Sports - Baseball"),
                    "latitude": F.lit(35.0781),
                    "longitude": F.lit(-106.6044),
                },
            ),
            "community": (
                d.listing,
                {
                    "event_name": F.concat(F.lit("Listing "), c("listing_id").cast("string")),
                    "event_start_date": text.parse_dates("dates_text", AS_OF_YEAR)["start_date"],
                    "start_sec": text.parse_time_range("time_text")["start_sec"],
                },
            ),
        }
    )
    return mapped.groupBy("source_name", "venue_name", "category", "latitude").agg(
        F.count("*").alias("listings"),
        F.count("start_sec").alias("with_time"),
        F.min("event_start_date").alias("first_date"),
        F.max("event_start_date").alias("last_date"),
        F.count("longitude").alias("with_longitude"),
        F.max("event_name").alias("last_name"),
    )


# --- filters, projections, lookups -------------------------------------------

SHORT = ["event_id", "event_name", "category", "event_start_date", "venue_name"]


@query("events_by_date_range")
def _(d: Data) -> DataFrame:
    return filters.events_by_date_range(d.events, "2024-01-10", "2024-01-16").select(SHORT)


@query("events_by_category")
def _(d: Data) -> DataFrame:
    return filters.events_by_category(d.events, "Concerts & Music").select(SHORT)


@query("multi_day_events")
def _(d: Data) -> DataFrame:
    return filters.multi_day_events(d.events).select(*SHORT, "event_end_date")


@query("events_multi_day")
def _(d: Data) -> DataFrame:
    return filters.events_multi_day(d.events)


@query("events_single_day")
def _(d: Data) -> DataFrame:
    return filters.events_single_day(d.events)


@query("venue_lookup")
def _(d: Data) -> DataFrame:
    named = filters.venue_by_name(d.venues, "Customer#000000042").withColumn("lookup", F.lit("by_name"))
    return named.unionByName(filters.all_venues(d.venues).withColumn("lookup", F.lit("all")))


@query("events_today_with_time")
def _(d: Data) -> DataFrame:
    return filters.events_today_with_time(d.events, d.venues, AS_OF)


@query("events_with_venues")
def _(d: Data) -> DataFrame:
    return filters.events_with_venues(d.events, d.venues).select(
        "event_id", "event_name", "venue_id", "venue_name", "latitude", "longitude"
    )


@query("truncate_fields")
def _(d: Data) -> DataFrame:
    return listings.truncate_fields(
        d.events.select("event_id", "event_name", "venue_name", "category", "sponsor"),
        {"event_name": 7, "venue_name": 255, "category": 10, "sponsor": 9},
        count_as="fields_cut",
    )


def _listing_events(d: Data) -> DataFrame:
    return d.listing.select(
        "listing_id",
        F.nullif(F.lit("Listing").substr(F.lit(1), (F.col("listing_id") % 8).cast("int")), F.lit("L")).alias(
            "event_name"
        ),
        text.parse_dates("dates_text", AS_OF_YEAR)["start_date"].alias("event_start_date"),
    )


@query("validate_events")
def _(d: Data) -> DataFrame:
    valid, rejected = listings.validate_events(_listing_events(d))
    return rejected.unionByName(valid.withColumn("reason", F.lit("Valid")))


@query("dashboard_filter")
def _(d: Data) -> DataFrame:
    rows = filters.dashboard(d.events, d.venues, d.meas, AS_OF, category="Sports", data_quality="complete")
    return rows.select(
        "event_id", "category", "event_start_date", "impact_level", "data_quality", "impact_above_baseline"
    )


@query("numeric_coerce")
def _(d: Data) -> DataFrame:
    return filters.numeric_coerce(d.detail).select(
        "event_id", "impact_minutes", "measurement_count", "impact_above_baseline"
    )


@query("events_needing_baseline_link")
def _(d: Data) -> DataFrame:
    return linking.unlinked_event_rows(d.meas).select("measurement_id", "venue_id", "measurement_time")


@query("speed_comparison")
def _(d: Data) -> DataFrame:
    return filters.speed_comparison(d.detail)


# --- joins -------------------------------------------------------------------


@query("event_traffic_with_baseline")
def _(d: Data) -> DataFrame:
    return d.impact.select(impact.VIEW_COLUMNS)


@query("event_traffic_data")
def _(d: Data) -> DataFrame:
    return linking.event_traffic_data(d.events, d.venues, d.raw)


@query("nearest_event_link")
def _(d: Data) -> DataFrame:
    return d.meas.select("measurement_id", "venue_id", "event_id", "is_baseline")


@query("match_rank")
def _(d: Data) -> DataFrame:
    return linking.match_events(d.raw, d.events).select(
        "measurement_id", "event_id", "event_name", "event_datetime", "measurement_time", "hours_from_event"
    )


@query("event_impact_detail")
def _(d: Data) -> DataFrame:
    return d.detail


@query("events_missing_traffic")
def _(d: Data) -> DataFrame:
    return aggregates.events_missing_traffic(d.events, d.venues, d.meas, AS_OF)


@query("events_with_traffic")
def _(d: Data) -> DataFrame:
    return linking.events_with_traffic(d.events, d.raw)


@query("traffic_for_event")
def _(d: Data) -> DataFrame:
    return linking.traffic_for_event(d.events, d.venues, d.raw)


@query("occurrence_impact")
def _(d: Data) -> DataFrame:
    return impact.occurrence_impact(d.events, d.venues, impact.link_to_occurrences(d.raw, d.events))


@query("multi_day_window_match")
def _(d: Data) -> DataFrame:
    return linking.multi_day_window_match(d.events, d.raw)


@query("baseline_match_tiers")
def _(d: Data) -> DataFrame:
    return baseline.baseline_match_tiers(d.events, d.raw)


# --- aggregations ------------------------------------------------------------


@query("category_traffic_impact")
def _(d: Data) -> DataFrame:
    return impact.category_traffic_impact(d.impact)


@query("category_speed_impact")
def _(d: Data) -> DataFrame:
    return impact.category_speed_impact(d.impact)


@query("venue_baseline_patterns")
def _(d: Data) -> DataFrame:
    return baseline.venue_baseline_patterns(d.venues, d.raw)


@query("traffic_summary_by_venue")
def _(d: Data) -> DataFrame:
    return aggregates.traffic_summary_by_venue(d.venues, d.raw)


@query("top_venues_by_measurements")
def _(d: Data) -> DataFrame:
    return aggregates.top_venues_by_measurements(d.venues, d.raw)


@query("venues_missing_baseline")
def _(d: Data) -> DataFrame:
    return baseline.venues_missing_baseline(d.venues, d.raw, AS_OF)


@query("api_usage_by_day")
def _(d: Data) -> DataFrame:
    return aggregates.api_usage_by_day(d.meas, AS_OF)


@query("usage_7day_pivot")
def _(d: Data) -> DataFrame:
    return aggregates.usage_7day_pivot(d.raw, AS_OF)


@query("recent_collection_activity")
def _(d: Data) -> DataFrame:
    return aggregates.recent_collection_activity(d.meas, AS_OF)


@query("collection_status_summary")
def _(d: Data) -> DataFrame:
    return aggregates.collection_status_summary(d.events, d.venues, d.meas, AS_OF)


@query("collection_schedule_validation")
def _(d: Data) -> DataFrame:
    return aggregates.collection_schedule_validation(d.events, d.meas, AS_OF)


@query("event_statistics")
def _(d: Data) -> DataFrame:
    return aggregates.event_statistics(d.events)


@query("top_event_venues")
def _(d: Data) -> DataFrame:
    return aggregates.top_event_venues(d.events)


@query("category_counts")
def _(d: Data) -> DataFrame:
    return aggregates.category_counts(d.events)


@query("event_occurrences")
def _(d: Data) -> DataFrame:
    return linking.event_occurrences(d.events)


@query("impact_summary")
def _(d: Data) -> DataFrame:
    """The three parts of the summary in one frame, told apart by ``part``."""
    top = reports.top_increases(d.analysed).select(
        F.lit("top").alias("part"),
        F.col("event_id").cast("string").alias("label"),
        F.lit(1).cast("bigint").alias("event_count"),
        F.col("delay_increase").alias("value"),
    )
    return reports.impact_breakdown(d.analysed).unionByName(top)


@query("dashboard_kpis")
def _(d: Data) -> DataFrame:
    return reports.dashboard_kpis(d.detail)


@query("quality_distribution")
def _(d: Data) -> DataFrame:
    return reports.quality_distribution(d.detail)


@query("dow_hour_distribution")
def _(d: Data) -> DataFrame:
    return aggregates.dow_hour_distribution(d.raw)


@query("monthly_call_estimate")
def _(d: Data) -> DataFrame:
    return collection.monthly_call_estimate(d.events)


@query("event_avg_delay_by_venue")
def _(d: Data) -> DataFrame:
    return aggregates.event_avg_delay_by_venue(d.events, d.venues, d.raw)


@query("time_coverage")
def _(d: Data) -> DataFrame:
    return aggregates.time_coverage(d.events)


@query("daily_usage_forecast")
def _(d: Data) -> DataFrame:
    return collection.daily_usage_forecast(d.events, d.venues, "2024-01-24 17:30:00").unionByName(
        collection.daily_usage_forecast(d.events, d.venues, AS_OF)
    )


@query("map_and_timeline_points")
def _(d: Data) -> DataFrame:
    return reports.map_and_timeline_points(filters.dashboard(d.events, d.venues, d.meas, AS_OF))


@query("before_during_after")
def _(d: Data) -> DataFrame:
    return linking.before_during_after(d.events, d.venues, d.raw)


@query("impact_bins")
def _(d: Data) -> DataFrame:
    return reports.impact_bins(linking.before_during_after(d.events, d.venues, d.raw))


# --- windows, sorts, top lists -----------------------------------------------


@query("impact_before_during")
def _(d: Data) -> DataFrame:
    return d.analysed


@query("venue_groups")
def _(d: Data) -> DataFrame:
    return ranking.venue_groups(d.venues)


@query("top_impact_events")
def _(d: Data) -> DataFrame:
    return ranking.top_impact_events(d.detail)


@query("recent_events")
def _(d: Data) -> DataFrame:
    return ranking.recent_events(d.events).select(*SHORT, "updated_at")


@query("recent_measurements")
def _(d: Data) -> DataFrame:
    return ranking.recent_measurements(d.raw, 5)


@query("top_categories")
def _(d: Data) -> DataFrame:
    return reports.top_categories(d.analysed)


# --- quality checks and repairs ----------------------------------------------


@query("data_quality_check")
def _(d: Data) -> DataFrame:
    return quality.data_quality_check(d.events, d.venues, d.meas)


@query("data_quality_label")
def _(d: Data) -> DataFrame:
    return d.impact.select(
        "event_id",
        levels.data_quality("event_measurements", "baseline_measurements").alias("data_quality"),
    )


@query("impact_level")
def _(d: Data) -> DataFrame:
    return d.impact.select(
        "event_id",
        *[levels.impact_level("impact_above_baseline", v).alias(f"level_{v}") for v in ("detail", "summary", "halves", "bins")],
    )


@query("event_impact_summary")
def _(d: Data) -> DataFrame:
    return impact.event_impact_summary(d.impact)


@query("key_violations")
def _(d: Data) -> DataFrame:
    return quality.key_violations(d.events, d.venues)


@query("orphan_rows")
def _(d: Data) -> DataFrame:
    # venues without coordinates and events without category stand for deleted parents
    return quality.orphan_rows(
        d.events.filter("category IS NOT NULL"), d.venues.filter("latitude IS NOT NULL"), d.meas
    )


@query("backfill_time_metadata")
def _(d: Data) -> DataFrame:
    return quality.backfill_time_metadata(d.raw).select("measurement_id", "day_of_week", "hour_of_day")


@query("time_metadata_gaps")
def _(d: Data) -> DataFrame:
    return quality.time_metadata_gaps(d.raw)


@query("fill_estimated_defaults")
def _(d: Data) -> DataFrame:
    return quality.fill_estimated_defaults(d.events).select("event_id", "category", "start_sec", "expected_attendance")


@query("baseline_type_backfill")
def _(d: Data) -> DataFrame:
    return quality.baseline_type_backfill(d.raw).select(
        "measurement_id", "is_baseline", "baseline_type", "day_of_week", "hour_of_day"
    )


@query("baseline_with_event")
def _(d: Data) -> DataFrame:
    # link every row, flagged or not, as a faulty job would; its flag goes along as another column
    hidden = d.raw.withColumn("flag", F.col("is_baseline")).withColumn("is_baseline", F.lit(False))
    faulty = linking.link_measurements(hidden, d.events)
    return quality.baseline_with_event(faulty.withColumn("is_baseline", F.col("flag")))


# --- text, dates, math, JSON -------------------------------------------------


@query("parse_dates")
def _(d: Data) -> DataFrame:
    return d.listing.select("listing_id", text.parse_dates("dates_text", AS_OF_YEAR).alias("p")).select(
        "listing_id", "p.*"
    )


@query("parse_time_range")
def _(d: Data) -> DataFrame:
    return d.listing.select("listing_id", text.parse_time_range("time_text").alias("p")).select("listing_id", "p.*")


@query("parse_cost")
def _(d: Data) -> DataFrame:
    return d.listing.select("listing_id", text.parse_cost("price_text").alias("p")).select("listing_id", "p.*")


@query("clean_phone")
def _(d: Data) -> DataFrame:
    return d.listing.select("listing_id", text.clean_phone("phone_text").alias("phone"))


@query("clean_email")
def _(d: Data) -> DataFrame:
    return d.listing.select("listing_id", text.clean_email("email_text").alias("email"))


@query("extract_category")
def _(d: Data) -> DataFrame:
    return d.listing.select(
        "listing_id", F.coalesce(text.extract_category("gtm_vars"), F.lit("General")).alias("category")
    )


@query("page_title")
def _(d: Data) -> DataFrame:
    return d.read("pages").select("page_id", pages.page_title("html").alias("title"))


def _listing_pages(d: Data) -> DataFrame:
    """A detail page for every listing; the small rows are spread before they grow to pages."""

    def item(name: str, *value: Column | str) -> Column:
        body = F.concat(
            F.lit(f'<li data-name="{name}"><span class="info-list-label">{name}</span>'),
            F.lit('<span class="info-list-value"> '),
            *(F.lit(v) if isinstance(v, str) else v for v in value),
            F.lit(" </span></li>\n"),
        )
        return F.coalesce(body, F.lit(""))

    number = F.col("listing_id").cast("string")
    spread = d.listing.repartition(d.spark.sparkContext.defaultParallelism, "listing_id")
    return spread.select(
        F.col("listing_id").alias("page_id"),
        F.concat(F.lit("https://listings.example.org/e/"), number).alias("url"),
        F.concat(
            F.lit("<html><body><h1 class='t'> Show &amp; Tell <b>No. "),
            number,
            F.lit("</b></h1>\n<ul class=\"detail-info wide\" data-gtm-vars='"),
            F.col("gtm_vars"),
            F.lit("'>\n"),
            item("dates", F.col("dates_text")),
            item("time", F.col("time_text")),
            # a list inside the list, an element inside a value, a comment, attributes without quotes
            F.lit("<li class=more><ul><li>Parking</li><li data-name=parking><span class=info-list-value>Yes</span></li></ul></li>\n"),
            item("location", "Hall <span>", number, "</span> West"),
            F.lit('<!-- <li data-name="location"><span class="info-list-value">Old Hall</span></li> -->\n'),
            F.lit("<li data-name=host><br><span class=info-list-value>The Caf&eacute; &lt;Inc&gt;&hellip;</span></li>\n"),
            item("price", F.col("price_text")),
            item("phone", F.col("phone_text")),
            item("email", F.col("email_text")),
            F.lit('<li class="website"><a href="https://t.example.org/'),
            number,
            F.lit('">Get <i>Tickets</i></a></li><li class="website"><a class="x" href="https://w.example.org/?a=1&amp;b='),
            number,
            F.lit('">Visit Website</a></li></ul></body></html>'),
        ).alias("html"),
    )


@query("page_fields")
def _(d: Data) -> DataFrame:
    return pages.page_fields(_listing_pages(d), AS_OF_YEAR)


def _flow_probes(d: Data) -> DataFrame:
    """A flow answer for every measurement; some lack the segment, its path or its speeds."""
    i = F.col("measurement_id")
    path = F.when(
        i % 4 > 0,
        F.array(
            F.struct((35 + (i % 10) * 0.01).alias("latitude"), F.lit(-106.5).alias("longitude")),
            F.struct(F.lit(35.02).alias("latitude"), F.lit(-106.51).alias("longitude")),
            F.struct((35.05 + (i % 5) * 0.01).alias("latitude"), F.lit(-106.52).alias("longitude")),
        ),
    )
    segment = F.struct(
        F.when(i % 11 > 0, F.col("avg_speed_mph")).alias("currentSpeed"),
        F.lit(45.0).alias("freeFlowSpeed"),
        (100 + i % 400).alias("currentTravelTime"),
        (100 + i % 150).alias("freeFlowTravelTime"),
        F.lit(0.9).alias("confidence"),
        F.when(path.isNotNull(), F.struct(path.alias("coordinate"))).alias("coordinates"),
    )
    return d.raw.select(
        "measurement_id",
        F.when(i % 13 > 0, F.to_json(F.struct(segment.alias("flowSegmentData")))).otherwise("{}").alias("payload"),
    )


@query("parse_flow_json")
def _(d: Data) -> DataFrame:
    parsed = _flow_probes(d).select("measurement_id", payloads.parse_flow("payload").alias("p"))
    return parsed.filter("p IS NOT NULL").select("measurement_id", "p.*")


@query("parse_route_json")
def _(d: Data) -> DataFrame:
    i = F.col("measurement_id")
    summary = F.struct(
        (1000.0 + i % 5000).alias("lengthInMeters"),
        F.when(i % 9 > 0, 60 + i % 400).otherwise(0).alias("travelTimeInSeconds"),
        F.when(i % 6 > 0, 60 + i % 200).alias("noTrafficTravelTimeInSeconds"),
    )
    routes = F.when(i % 10 > 0, F.array(F.struct(summary.alias("summary")))).otherwise(F.array())
    probes = d.raw.select("measurement_id", F.to_json(F.struct(routes.alias("routes"))).alias("payload"))
    parsed = probes.select("measurement_id", payloads.parse_route("payload").alias("p"))
    return parsed.filter("p IS NOT NULL").select("measurement_id", "p.*")


@query("parse_matrix_json")
def _(d: Data) -> DataFrame:
    i = F.col("measurement_id")
    element = F.struct(
        F.when(i % 8 > 0, "OK").otherwise("ZERO_RESULTS").alias("status"),
        F.struct((800.0 + i % 7000).alias("value")).alias("distance"),
        F.struct((90 + i % 300).alias("value")).alias("duration"),
        F.when(i % 5 > 0, F.struct((80 + i % 500).alias("value"))).alias("duration_in_traffic"),
    )
    doc = F.struct(
        F.when(i % 12 > 0, "OK").otherwise("OVER_LIMIT").alias("status"),
        F.array(F.struct(F.array(element).alias("elements"))).alias("rows"),
    )
    parsed = d.raw.select("measurement_id", F.to_json(doc).alias("payload")).select(
        "measurement_id", payloads.parse_matrix("payload").alias("p")
    )
    return parsed.filter("p IS NOT NULL").select("measurement_id", "p.*")


@query("parse_geocode_json")
def _(d: Data) -> DataFrame:
    result = F.struct(
        F.struct(F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lng")).alias("location")).alias(
            "geometry"
        ),
        F.col("address").alias("formatted_address"),
        F.col("place_id").alias("place_id"),
    )
    answer = F.when(F.col("latitude").isNull(), "[]").otherwise(F.to_json(F.array(result, result)))
    parsed = d.venues.select("venue_id", payloads.parse_geocode(answer).alias("p"))
    return parsed.filter("p IS NOT NULL").select("venue_id", "p.*")


@query("traffic_level")
def _(d: Data) -> DataFrame:
    delay = F.col("delay_minutes") / 2.0
    return d.raw.select(
        "measurement_id",
        *[levels.traffic_level(delay, v).alias(f"level_{v}") for v in ("flow", "matrix", "pattern")],
    )


@query("haversine_miles")
def _(d: Data) -> DataFrame:
    here, there = (F.col("latitude"), F.col("longitude")), (F.lit(35.0781), F.lit(-106.6044))
    return d.venues.select(
        "venue_id",
        *[F.round(geo.haversine_miles(*here, *there, form=f), 2).alias(f"miles_{f}") for f in ("asin", "atan2")],
    )


@query("sample_points")
def _(d: Data) -> DataFrame:
    four = d.venues.select("venue_id", F.lit(4).alias("n"), F.inline(geo.sample_points("latitude", "longitude", 1.0, 4)))
    eight = d.venues.select("venue_id", F.lit(8).alias("n"), F.inline(geo.sample_points("latitude", "longitude", 0.5, 8)))
    return four.unionByName(eight)


@query("speed_impact")
def _(d: Data) -> DataFrame:
    return impact.speed_impact(d.impact)


@query("hours_from_event")
def _(d: Data) -> DataFrame:
    noon = F.timestamp_add("HOUR", F.lit(12), F.col("event_start_date").cast("timestamp_ntz"))
    return d.events.filter("start_sec IS NOT NULL").select(
        "event_id", clock.hours_between(clock.start_ts(), noon).alias("hours_from_event")
    )


@query("dow_hour")
def _(d: Data) -> DataFrame:
    return d.raw.select(
        "measurement_id",
        clock.day_of_week("measurement_time").alias("dow"),
        F.hour("measurement_time").alias("hour"),
        clock.day_name(clock.day_of_week("measurement_time")).alias("day_name"),
    )


@query("event_start_ts")
def _(d: Data) -> DataFrame:
    return d.events.select("event_id", clock.start_ts().alias("event_start_ts"))


# --- planning rules ----------------------------------------------------------


@query("collection_plan")
def _(d: Data) -> DataFrame:
    return collection.collection_plan(d.events).withColumn("directions", F.array_join("directions", ","))


@query("baseline_week_group")
def _(d: Data) -> DataFrame:
    return d.raw.select(
        "measurement_id",
        collection.baseline_week_group("measurement_time").alias("week_group"),
        collection.baseline_week_group("measurement_time", 2).alias("two_group"),
    )


@query("baseline_slot")
def _(d: Data) -> DataFrame:
    return d.raw.select(
        "measurement_id", collection.slot_label(collection.baseline_slot("measurement_time")).alias("time_slot")
    )


@query("baseline_plan")
def _(d: Data) -> DataFrame:
    return collection.baseline_plan(d.venues, AS_OF)


@query("event_collection_point")
def _(d: Data) -> DataFrame:
    return collection.event_collection_point(d.events, AS_OF)


@query("planned_points")
def _(d: Data) -> DataFrame:
    return collection.planned_points(d.events, AS_OF)


@query("slot_coverage")
def _(d: Data) -> DataFrame:
    return collection.slot_coverage(d.venues, d.raw, AS_OF)


@query("budget_cap")
def _(d: Data) -> DataFrame:
    plan = collection.collection_plan(d.events)
    order = [F.asc("event_start_date"), F.asc("start_sec"), F.asc("event_id")]
    return collection.budget_cap(plan, order, 1000).select(
        "event_id", "event_start_date", "start_sec", "estimated_calls", "calls_so_far"
    )


@query("category_pattern")
def _(d: Data) -> DataFrame:
    return d.events.select("event_id", "category", collection.category_pattern("category").alias("pattern"))


# --- streams, run to the end of the available data ---------------------------


def _probe_stream(d: Data) -> DataFrame:
    """The event file as a stream of measurement rows; a stream source takes a pattern, not a file."""
    source = d.read("events")
    arriving = d.spark.readStream.schema(source.schema).parquet(f"{d.sf_dir}/event[s].parquet")
    return standins.meas_from(d.spark, arriving)


@query("stream_measurements")
def _(d: Data) -> DataFrame:
    i = F.col("measurement_id")
    segment = F.struct(
        F.col("avg_speed_mph").alias("currentSpeed"),
        F.lit(45.0).alias("freeFlowSpeed"),
        (100 + i % 400).alias("currentTravelTime"),
        (100 + i % 150).alias("freeFlowTravelTime"),
    )
    raw = _probe_stream(d).select(
        "measurement_id",
        "venue_id",
        "event_id",
        "measurement_time",
        "is_baseline",
        "baseline_type",
        F.lit(None).cast("double").alias("origin_lat"),
        F.lit(None).cast("double").alias("origin_lng"),
        F.lit("flow").alias("payload_kind"),
        F.when(i % 13 > 0, F.to_json(F.struct(segment.alias("flowSegmentData")))).otherwise("{}").alias("payload"),
    )
    path = d.scratch("stream-measurements")
    streams.stream_measurements(raw, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return d.spark.read.parquet(f"{path}/table").select(
        "measurement_id",
        "measurement_time",
        "traffic_level",
        F.col("avg_speed_mph").cast("double"),
        "delay_minutes",
        F.col("distance_miles").cast("double"),
        "baseline_type",
        "is_baseline",
        "day_of_week",
        "hour_of_day",
        "measurement_date",
    )


@query("stream_hourly_activity")
def _(d: Data) -> DataFrame:
    path = d.scratch("stream-hourly")
    rows = _probe_stream(d)
    streams.stream_hourly_activity(rows, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return streams.read_hourly_activity(d.spark, f"{path}/table", streams.activity_cells(rows).schema)


@query("stream_link_events")
def _(d: Data) -> DataFrame:
    path = d.scratch("stream-link")
    streams.stream_link_events(_probe_stream(d), d.events, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return d.spark.read.parquet(f"{path}/table").select("measurement_id", "venue_id", "event_id", "is_baseline")


@query("stream_upsert_events")
def _(d: Data) -> DataFrame:
    source = d.read("orders")
    arriving = d.spark.readStream.schema(source.schema).parquet(f"{d.sf_dir}/order[s].parquet")
    listed = d.spark.sql(standins.SCHED, orders=arriving, events=d.read("events"))
    live = Data(d.spark, d.sf_dir)
    live.__dict__["events"] = listed
    path = d.scratch("stream-upsert")
    streams.stream_upsert_events(
        _batch(live), _event_table(d), f"{path}/events", f"{path}/checkpoint", AS_OF
    ).awaitTermination()
    return Versions(d.spark, f"{path}/events", _event_table(d).schema).read().select(LOADED)
