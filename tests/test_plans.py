"""The plans at scale: what is pruned, what is cut before a shuffle, what is split when hot."""

import re
from datetime import timedelta

import pytest
from frames import DAY, event, events, meas, probe, venues
from pyspark.sql import functions as F
from test_linking import hot_fixture

from crowdlane.operators import aggregates, filters, halves, impact, linking, ranking, upserts
from crowdlane.plans import collection, reports
from crowdlane.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sort_merge(spark):
    """Joins as on tables too large to broadcast, with small skew limits."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "300KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def crowded(spark, n=60000):
    """A third of all rows at one venue inside one bin, from many input tasks."""
    return spark.range(0, n, numPartitions=12).selectExpr(
        "id AS measurement_id",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE 2 + id % 500 END AS venue_id",
        """timestampadd(SECOND, CASE WHEN id % 3 = 0 THEN 64800 + id % 600 ELSE (id * 7919) % 86400 END,
                        timestamp_ntz'2024-01-03 00:00:00') AS measurement_time""",
        "false AS is_baseline",
        "cast(NULL AS bigint) AS event_id",
        "cast(id % 10 AS int) AS delay_minutes",
        "repeat(uuid(), 4) AS payload",
    )


def skewed(df):
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    return "skew=true" in final or "isSkewJoin=true" in final


def test_a_crowded_bin_of_measurements_is_split_and_nothing_is_lost(spark, sort_merge):
    evs = events(spark, [event(i, venue_id=1 if i % 3 == 0 else 2 + i % 500, sec=64800 + 300 * (i % 3)) for i in range(300)])
    linked = linking.link_measurements(crowded(spark), evs)
    got = linked.groupBy(F.col("event_id").isNull().alias("free")).agg(F.count("*").alias("n"), F.max("payload").alias("p"))
    assert skewed(got)
    counts = {r["free"]: r["n"] for r in got.collect()}
    assert sum(counts.values()) == 60000 and counts[False] >= 20000
    points = linking.event_points(evs, "event_id").filter("event_id < 4")
    assert skewed(linking.window_pairs(points, crowded(spark), ["payload"]).agg(F.max("payload")))


def test_a_crowded_venue_of_events_is_split(spark, sort_merge):
    # rows that look up a venue are narrow, so the crowded venue shows beside small partitions only
    spark.conf.set("spark.sql.shuffle.partitions", "96")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
    evs = crowded(spark).selectExpr(
        "measurement_id AS event_id",
        "payload AS event_name",
        "venue_id",
        "cast(NULL AS string) AS category",
        "date'2024-01-03' AS event_start_date",
        "date'2024-01-03' AS event_end_date",
        "cast(64800 + measurement_id % 2 * 60 AS int) AS start_sec",
        "false AS is_multi_day",
    )
    v = spark.range(1, 600).selectExpr("id AS venue_id", "'v' AS venue_name", "35D AS latitude", "-106D AS longitude")
    rows = meas(spark, [probe(i, i / 10, venue_id=1 + i % 3, baseline=i % 2 == 0) for i in range(300)])
    total = [F.count("*").alias("n"), F.max("event_name").alias("p")]
    for df in (
        impact.event_traffic_with_baseline(evs, v, rows),
        halves.impact_before_during(evs, v, rows),
        linking.before_during_after(evs, v, rows, keep_partial=True),
    ):
        assert skewed(df.agg(*total))
    named = upserts.link_events_to_venues(
        evs.selectExpr("* EXCEPT (venue_id)", "cast(NULL AS bigint) AS venue_id", "cast(venue_id AS string) AS venue_name"),
        v.selectExpr("venue_id", "cast(venue_id AS string) AS venue_name"),
    )
    assert skewed(named.agg(*total))


def test_date_bounds_prune_partitions(spark, tmp_path):
    rows = meas(spark, [probe(i, day=DAY + timedelta(days=i)) for i in range(5)])
    tables.append_measurements(rows, str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    report = aggregates.api_usage_by_day(stored, f"{DAY + timedelta(days=4)} 12:00:00", days=1)
    assert "PartitionFilters: [isnotnull(measurement_date" in plan(report)
    assert report.count() == 2


def test_top_rows_are_cut_before_the_shuffle(spark):
    m = meas(spark, [probe(1)])
    assert "WindowGroupLimit" in plan(ranking.recent_measurements(m, 5))
    keyed = spark.createDataFrame([(1, "A", "V", DAY)], "input_seq INT, event_name STRING, venue_name STRING, event_start_date DATE")
    assert "WindowGroupLimit" in plan(upserts.dedup_events(keyed))


def scans(df, path):
    """How often a plan reads a folder, and how often all others."""
    found = [line for line in plan(df).splitlines() if "FileScan" in line]
    facts = sum(str(path) in line for line in found)
    return facts, len(found) - facts


def test_stored_facts_are_scanned_once_for_the_impact_views(spark, tmp_path):
    evs, probes = hot_fixture(5)
    meas(spark, [{**m, "event_id": m["measurement_id"] % 60} for m in probes]).write.parquet(str(tmp_path / "facts"))
    events(spark, evs).write.parquet(str(tmp_path / "events"))
    venues(spark).write.parquet(str(tmp_path / "venues"))
    m, e, v = (spark.read.parquet(str(tmp_path / name)) for name in ("facts", "events", "venues"))
    rows = impact.event_traffic_with_baseline(e, v, m)
    for df in (
        rows,
        impact.event_impact_detail(rows),
        impact.category_traffic_impact(rows),
        impact.category_speed_impact(rows),
        reports.dashboard_kpis(impact.event_impact_detail(rows)),
        impact.speed_impact(rows),
        impact.occurrence_impact(e, v, m.withColumn("occurrence_date", F.to_date("measurement_time"))),
    ):
        assert scans(df, tmp_path / "facts") == (1, 2)


def test_only_needed_columns_are_read(spark, tmp_path):
    for name, ddl in tables.TABLES.items():
        spark.createDataFrame([], ddl).write.parquet(str(tmp_path / name))
    t = tables.load_tables(spark, str(tmp_path))
    text = plan(aggregates.traffic_summary_by_venue(t["venue_locations"], t["traffic_measurements"]))
    assert "raw_response" not in text and "PushedFilters: [IsNotNull(venue_id)" in text


def test_linked_baseline_branch_is_dropped(spark):
    e, m = events(spark, [event(1)]), meas(spark, [probe(1), probe(2, baseline=True)])
    linked = linking.link_measurements(m, e).filter("is_baseline = true AND event_id IS NULL")
    assert "Join" not in plan(linked) and linked.count() == 1
    assert linking.event_traffic_data(e, venues(spark), m).count() == 2


def test_report_bounds_prune_on_both_sides(spark, tmp_path):
    rows = meas(spark, [probe(i, day=DAY + timedelta(days=i), baseline=True) for i in range(5)])
    tables.append_measurements(rows, str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    covered = collection.slot_coverage(venues(spark), stored, f"{DAY + timedelta(days=2)} 12:00:00")
    assert "PartitionFilters: [isnotnull(measurement_date" in plan(covered)
    bounds = covered._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"measurement_date#\d+ >= 2024-01-05", bounds) and re.search(r"measurement_date#\d+ <= 2024-01-06", bounds)


def test_a_dashboard_reads_the_facts_of_its_events(spark):
    evs, probes = hot_fixture(5)
    linked = [{**m, "event_id": m["measurement_id"] % 60 if m["measurement_id"] % 3 else None} for m in probes]
    e, m, v = events(spark, evs), meas(spark, linked), venues(spark, (1, 2, 3))
    as_of = f"{evs[0]['event_start_date']} 00:00:00"
    whole = filters.dashboard_filter(impact.event_impact_detail(impact.event_traffic_with_baseline(e, v, m)), as_of, category="Sports")
    part = filters.dashboard(e, v, m, as_of, category="Sports")
    assert sorted(part.collect(), key=str) == sorted(whole.collect(), key=str) != []
    few = e.where("event_id = 3")
    kept = filters.facts_of_events(m, few)
    assert 0 < kept.count() < m.count() and "LeftSemi" in plan(kept)
    one = impact.event_traffic_with_baseline(few, v, kept).collect()
    assert one == impact.event_traffic_with_baseline(e, v, m).where("event_id = 3").collect()
