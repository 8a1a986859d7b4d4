import math
from datetime import datetime, timedelta

import pytest
from frames import DAY, event, events, meas, probe, venues
from pyspark.sql import functions as F

from crowdlane.functions import geo, levels, payloads
from crowdlane.operators import aggregates, ranking
from crowdlane.plans import collection


def test_rule_events_cost_18_calls(spark):
    evs = [
        event(1, category="Sports", sec=66900),
        event(2, category="Arts & Culture", sec=68400),
        event(3, category="Festival", sec=21600, is_multi_day=True),
        event(4, category="General", sec=None, is_multi_day=True),
    ]
    plan = {r["event_id"]: r for r in collection.collection_plan(events(spark, evs)).collect()}
    assert [plan[i]["plan_type"] for i in range(1, 5)] == ["major_single_day", "minor_single_day", "major_multi_day", None]
    assert plan[4]["reason"] == "No event time available"
    lines = {r["plan_type"]: r for r in collection.monthly_call_estimate(events(spark, evs)).collect()}
    total = lines[None]
    assert (total["calls"], total["events_processed"], total["events_skipped"], total["estimated_cost"]) == (18, 4, 1, 0.13)
    assert total["remaining_credit"] == 199.87 and set(lines) == {None, "major_single_day", "minor_single_day", "major_multi_day"}


def test_major_is_a_substring_and_null_is_minor(spark):
    df = spark.createDataFrame([("Live MUSIC & more",), ("Theater",), (None,)], "category STRING")
    assert [r[0] for r in df.select(collection.is_major("category")).collect()] == [True, False, False]


def test_collection_offset_matches_the_search_over_points(spark):
    grid = [x / 4 for x in range(-4 * 140, 4 * 140 + 1)]
    got = spark.createDataFrame([(x,) for x in grid], "m DOUBLE").select("m", collection.nearest_collection_offset(F.col("m")).alias("p")).collect()
    for r in got:
        left = -r["m"]
        hit = next((t for t in range(-120, 121, 30) if abs(left - t) <= 15), None)
        assert r["p"] == (None if hit is None else -hit), r


@pytest.mark.parametrize("n", [0, 1, 3, 4, 10, 11])
@pytest.mark.parametrize("groups", [2, 4])
def test_venue_groups_put_the_rest_last(spark, n, groups):
    ids = [i * i * 1000003 for i in range(1, n + 1)]
    df = spark.createDataFrame([(i, str(i)) for i in reversed(ids)], "venue_id BIGINT, venue_name STRING")
    got = {r["venue_id"]: (r["position"], r["venue_group"]) for r in ranking.venue_groups(df, groups).collect()}
    size = n // groups
    want = {v: (i + 1, groups if size == 0 else min(i // size + 1, groups)) for i, v in enumerate(ids)}
    assert got == want


def test_slots_and_week_groups(spark):
    times = [datetime(2024, 1, d, h, m) for d in (1, 7, 8, 15, 22, 31) for h, m in ((6, 45), (7, 15), (7, 16), (23, 0), (0, 5))]
    df = spark.createDataFrame([(t,) for t in times], "t TIMESTAMP_NTZ")
    got = df.select("t", collection.baseline_slot("t").alias("s"), collection.baseline_week_group("t").alias("g"), collection.baseline_week_group("t", 2).alias("h")).collect()
    for r in got:
        minute = r["t"].hour * 60 + r["t"].minute
        assert r["s"] == next((s for s in collection.BASELINE_SLOTS if abs(minute - s) <= 15), None)
        assert r["g"] == min((r["t"].day - 1) // 7 + 1, 4)
        assert r["h"] == (1 if 8 <= r["t"].day <= 14 else 2 if 22 <= r["t"].day <= 30 else None)


def test_slot_coverage_lists_missed_slots(spark):
    v = venues(spark, range(1, 9))
    rows = [probe(1, venue_id=5, baseline=True, at=datetime(2024, 1, 15, 12, 10)), probe(2, venue_id=5, baseline=True, at=datetime(2024, 1, 15, 11, 50)), probe(3, venue_id=5, baseline=False, at=datetime(2024, 1, 15, 17))]
    got = collection.slot_coverage(v, meas(spark, rows), "2024-01-15 12:00:00").collect()
    assert len(got) == 12 and {r["venue_id"] for r in got} == {5, 6}
    assert [(r["venue_id"], r["time_slot"], r["measurements"]) for r in got if not r["missed"]] == [(5, "12:00", 2)]


@pytest.mark.parametrize("budget", [1, 3, 8, 9, 100])
def test_budget_stops_when_used_up(spark, budget):
    calls = [2, 0, 8, 2, 8, 2]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(calls)], "event_id INT, estimated_calls INT")
    got = [r["event_id"] for r in collection.budget_cap(df, [F.asc("event_id")], budget).orderBy("event_id").collect()]
    want, used = [], 0
    for i, c in enumerate(calls):
        if used >= budget:
            break
        if c:
            want.append(i)
            used += c
    assert got == want


def test_planned_points_and_status(spark):
    got = collection.planned_points(events(spark, [event(1)]), "2024-01-03 18:10:00", reach=60).orderBy("offset_minutes").collect()
    assert [(r["offset_minutes"], r["window"], r["status"]) for r in got] == [
        (-60, "before", "completed"), (-30, "before", "completed"), (0, "during", "now"), (30, "after", "upcoming"), (60, "after", "upcoming"),
    ]


def test_category_pattern_takes_the_first_listed(spark):
    df = spark.createDataFrame([("Music at the Sports Festival",), ("Festivals & Special Events",), ("music",), (None,)], "category STRING")
    assert [r[0] for r in df.select(collection.category_pattern("category")).collect()] == ["Sports", "Festival", "General", "General"]


def test_levels_at_their_edges(spark):
    df = spark.createDataFrame([(x,) for x in (None, -1.0, 0.0, 0.5, 1.0, 1.5, 2.0, 5.0, 5.5)], "x DOUBLE")

    def column(c):
        return [r[0] for r in df.select(c).collect()]

    assert column(levels.impact_level("x", "detail")) == ["unknown", "none", "none", "low", "low", "moderate", "moderate", "high", "severe"]
    assert column(levels.impact_level("x", "summary")) == ["unknown", "low", "low", "low", "low", "moderate", "moderate", "high", "severe"]
    assert column(levels.impact_level("x", "halves"))[1:4] == ["no impact", "no impact", "low"]
    assert column(levels.impact_level("x", "bins")) == [None, "Low", "Low", "Low", "Low", "Moderate", "Moderate", "High", "Severe"]
    assert column(levels.traffic_level("x", "flow"))[1:] == ["light", "light", "moderate", "moderate", "moderate", "heavy", "severe", "severe"]
    assert column(levels.traffic_level("x", "matrix"))[1:] == ["light", "light", "moderate", "moderate", "moderate", "moderate", "heavy", "severe"]


def test_distance_and_sample_points(spark):
    df = spark.createDataFrame([(35.0781, -106.6044, 35.0837, -106.6291), (35.0, -106.0, None, -106.0)], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    cols = [F.col(c) for c in "abcd"]
    got = df.select(geo.haversine_miles(*cols, form="asin").alias("x"), geo.haversine_miles(*cols).alias("y")).collect()
    a, b, c, d = (math.radians(v) for v in (35.0781, -106.6044, 35.0837, -106.6291))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    assert got[0]["x"] == pytest.approx(2 * 3959 * math.asin(math.sqrt(h))) == pytest.approx(got[0]["y"])
    assert got[1]["x"] is None and got[1]["y"] is None
    points = df.limit(1).select(geo.sample_points("a", "b", 1.0, 4).alias("p")).first()["p"]
    assert [p["direction"] for p in points] == ["North", "East", "South", "West"]
    assert points[0]["lat"] == pytest.approx(35.0781 + 1 / 69) and points[1]["lng"] == pytest.approx(-106.6044 + 1 / 69 / math.cos(a))
    odd = df.limit(1).select(geo.sample_points("a", "b", 1.0, 3).alias("p")).first()["p"]
    assert [p["direction"] for p in odd] == ["Point_0", "Point_1", "Point_2"]


def parsed(spark, fn, *docs):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i INT, j STRING")
    return [r["p"] for r in df.select("i", fn("j").alias("p")).orderBy("i").collect()]


def test_payloads(spark):
    flow = '{"flowSegmentData": {"currentSpeed": 20, "freeFlowSpeed": 40, "currentTravelTime": 180, "freeFlowTravelTime": 90, "confidence": 0.8}}'
    a, b, c = parsed(spark, payloads.parse_flow, flow, "{}", "not json")
    assert (a["delay_minutes"], a["traffic_level"], a["distance_miles"], a["confidence"]) == (1.5, "moderate", 1.0, 0.8)
    assert b is None and c is None
    still = parsed(spark, payloads.parse_flow, '{"flowSegmentData": {}}')[0]
    assert (still["avg_speed_mph"], still["distance_miles"], still["traffic_level"]) == (0.0, None, "light")
    route = '{"routes": [{"summary": {"lengthInMeters": 16093.4, "travelTimeInSeconds": 1200}}]}'
    r, none = parsed(spark, payloads.parse_route, route, '{"routes": []}')
    assert (r["distance_miles"], r["avg_speed_mph"], r["typical_speed_mph"], r["delay_minutes"]) == (10.0, 30.0, 30.0, 0.0)
    assert none is None
    matrix = '{"status": "%s", "rows": [{"elements": [{"status": "%s", "distance": {"value": 1609.34}, "duration": {"value": 60}, "duration_in_traffic": {"value": 183}}]}]}'
    ok, bad, worse = parsed(spark, payloads.parse_matrix, matrix % ("OK", "OK"), matrix % ("OK", "NOT_FOUND"), matrix % ("DENIED", "OK"))
    assert (ok["delay_minutes"], ok["traffic_level"], ok["distance_miles"]) == (2.1, "heavy", 1.0)
    assert bad is None and worse is None
    hit, miss = parsed(spark, payloads.parse_geocode, '[{"geometry": {"location": {"lat": 35.1, "lng": -106.5}}, "formatted_address": "A", "place_id": "p"}]', "[]")
    assert (hit["latitude"], hit["longitude"], hit["place_id"]) == (35.1, -106.5, "p") and miss is None


def test_reports_on_empty_facts(spark):
    m, e, v = meas(spark, []), events(spark, [event(1)]), venues(spark)
    now = "2024-01-03 12:00:00"
    assert aggregates.usage_7day_pivot(m, now).count() == 0
    summary = aggregates.collection_status_summary(e, v, m, now).first()
    assert (summary["total_events"], summary["total_measurements"], summary["last_measurement"]) == (1, 0, None)
    check = aggregates.collection_schedule_validation(e, m, now).first()
    assert check["collection_status"] == "No data collected" and check["hours_until_event"] == 6.0
    missing = aggregates.events_missing_traffic(e, v, m, now).first()
    assert (missing["event_status"], missing["missing_reason"]) == ("today", "Should have data - check collector")


def test_whole_days_truncate_toward_zero(spark):
    from crowdlane.functions import clock

    now = clock.moment("2024-01-15 12:00:00")
    times = [datetime(2024, 1, 15, 12) + timedelta(hours=h) for h in (-25, -23, 23, 25)]
    df = spark.createDataFrame([(t,) for t in times], "t TIMESTAMP_NTZ")
    assert [r[0] for r in df.select(clock.whole_days_between(F.col("t"), now)).collect()] == [1, 0, 0, -1]
    assert DAY.weekday() == 2


def test_positions_hold_for_any_spread_of_ids(spark):
    far = [-(2**62), -1, 2**40, 2**62]
    ids = spark.range(200_000).union(spark.createDataFrame([(i,) for i in [*far, None]], "id BIGINT"))
    got = ranking.with_position(ids.withColumn("note", F.lit("x")), "id")
    assert set(got.columns) == {"id", "note", "position", "row_total"}
    wrong = got.where("id between 0 and 199999 and position <> id + 3 or row_total <> 200004").count()
    assert wrong == 0 and got.count() == 200_004
    assert {r.id: r.position for r in got.where(F.col("id").isin(far)).collect()} == {
        -(2**62): 1, -1: 2, 2**40: 200_003, 2**62: 200_004
    }


def test_no_window_of_positions_holds_more_than_a_digit(spark):
    cells = spark.range(200_000).union(spark.createDataFrame([(2**62,)], "id BIGINT"))
    sizes = cells.groupBy(F.shiftright("id", ranking.DIGIT)).count().agg(F.max("count")).first()[0]
    assert sizes <= 1 << ranking.DIGIT
