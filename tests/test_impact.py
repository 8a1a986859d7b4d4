import random
from datetime import datetime, timedelta

import duckdb
from frames import DAY, event, events, meas, probe, venues
from test_linking import hot_fixture, pairs

from crowdlane.operators import baseline, halves, impact, linking
from crowdlane.plans import reports

LITERAL = """
SELECT e.event_id,
       count(*) FILTER (m.event_id IS NOT NULL) AS event_measurements,
       avg(m.delay_minutes) FILTER (m.event_id IS NOT NULL) AS event_avg_delay,
       max(m.delay_minutes) FILTER (m.event_id IS NOT NULL) AS event_max_delay,
       avg(m.avg_speed_mph) FILTER (m.event_id IS NOT NULL) AS event_avg_speed,
       count(*) FILTER (m.is_baseline AND m.venue_id = e.venue_id
           AND (m.day_of_week = dayofweek(e.event_start_date) OR m.hour_of_day = e.start_sec // 3600)) AS baseline_measurements,
       avg(m.delay_minutes) FILTER (m.is_baseline AND m.venue_id = e.venue_id
           AND m.day_of_week = dayofweek(e.event_start_date) AND m.hour_of_day = e.start_sec // 3600) AS baseline_avg_delay
FROM e LEFT JOIN m ON m.event_id = e.event_id OR (m.is_baseline AND m.venue_id = e.venue_id)
WHERE e.start_sec IS NOT NULL AND e.venue_id IN (1, 2, 3) GROUP BY e.event_id"""


def test_impact_equals_the_literal_or_join_even_with_stray_rows(spark):
    evs, probes = hot_fixture(3)
    r = random.Random(4)
    for m in probes:
        # baseline rows that carry an event, rows linked across venues, odd days and hours
        if r.random() < 0.4:
            m["event_id"] = r.randrange(60)
        if r.random() < 0.1:
            m["day_of_week"] = r.choice([None, 7, -1])
        if r.random() < 0.1:
            m["hour_of_day"] = None
    e, m = events(spark, evs), meas(spark, probes)
    con = duckdb.connect()
    con.register("e", e.toArrow())
    con.register("m", m.toArrow())
    want = {x[0]: x[1:] for x in con.execute(LITERAL).fetchall()}
    got = impact.event_traffic_with_baseline(e, venues(spark, (1, 2, 3)), m).collect()
    assert len(got) == len(want)

    def near(a, b):
        return a == b or (a is not None and b is not None and abs(a - b) < 1e-9)

    for row in got:
        names = ["event_measurements", "event_avg_delay", "event_max_delay", "event_avg_speed", "baseline_measurements", "baseline_avg_delay"]
        assert all(near(row[n], w) for n, w in zip(names, want[row["event_id"]])), (row, want[row["event_id"]])


def test_plans_have_no_nested_loops(spark):
    evs, probes = hot_fixture(5)
    e, m, v = events(spark, evs), meas(spark, probes), venues(spark)
    linked = linking.link_measurements(m, e)
    for df in (
        linked,
        linking.event_traffic_data(e, v, m),
        impact.event_traffic_with_baseline(e, v, linked),
        halves.impact_before_during(e, v, m),
        impact.occurrence_impact(e, v, impact.link_to_occurrences(m, e)),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def check_halves(spark, evs, probes):
    by_event = {}
    for e, m in pairs(evs, probes):
        by_event.setdefault(e["event_id"], []).append(m)

    def mean(xs):
        xs = [x for x in xs if x is not None]
        return sum(xs) / len(xs) if xs else None

    got = {r["event_id"]: r for r in halves.impact_before_during(events(spark, evs), venues(spark, (1, 2, 3)), meas(spark, probes)).collect()}
    assert set(got) == set(by_event)
    for i, ms in by_event.items():
        ms.sort(key=lambda m: (m["measurement_time"], m["measurement_id"]))
        first, second = ms[: len(ms) // 2], ms[len(ms) // 2 :]
        r = got[i]
        assert (r["total_measurements"], r["before_count"], r["during_count"]) == (len(ms), len(first), len(second))
        for name, part in (("before", first), ("during", second)):
            for col, field in (("avg_delay", "delay_minutes"), ("avg_speed", "avg_speed_mph")):
                want = mean([m[field] for m in part])
                have = r[f"{name}_{col}"]
                assert have == want or abs(have - want) < 1e-9
            delays = [m["delay_minutes"] for m in part if m["delay_minutes"] is not None]
            assert r[f"{name}_max_delay"] == max(delays, default=None)


def test_halves_match_brute_force(spark):
    check_halves(spark, *hot_fixture(6))


def test_odd_count_gives_the_extra_row_to_the_second_half_and_zero_speed_is_safe(spark):
    probes = [probe(1, -10, delay_minutes=0, avg_speed_mph=0.0), probe(2, 0, delay_minutes=4), probe(3, 10, delay_minutes=8)]
    r = halves.impact_before_during(events(spark, [event(1)]), venues(spark), meas(spark, probes)).first()
    assert (r["before_count"], r["during_count"], r["delay_increase"], r["impact_level"]) == (1, 2, 6.0, "severe")
    assert r["delay_increase_pct"] == 600.0 and r["speed_decrease"] == -30.0 and r["speed_decrease_pct"] is None


def test_single_row_has_no_first_half(spark):
    r = halves.impact_before_during(events(spark, [event(1)]), venues(spark), meas(spark, [probe(1)])).first()
    assert (r["before_count"], r["during_count"], r["impact_level"]) == (0, 1, "unknown")


def test_category_without_increase_counts_as_zero(spark):
    analysed = spark.createDataFrame(
        [("A", None), ("A", None), ("B", 3.0), (None, 1.5)], "category STRING, delay_increase DOUBLE"
    )
    got = {r["category"]: (r["avg_delay_increase"], r["high_impact"], r["recommendation"]) for r in reports.top_categories(analysed).collect()}
    assert got == {"A": (0.0, False, "MINIMAL IMPACT"), "B": (3.0, True, "MODERATE IMPACT - Monitor traffic"), None: (1.5, False, "LOW IMPACT")}


def test_baseline_tiers(spark):
    week = DAY + timedelta(days=7)
    probes = [
        probe(1, 0, venue_id=1, baseline=True, day=week, delay_minutes=2),
        probe(2, 0, venue_id=2, baseline=True, day=DAY + timedelta(days=1), delay_minutes=3),
        probe(3, 240, venue_id=3, baseline=True, day=week, delay_minutes=4),
        probe(4, 240, venue_id=4, baseline=True, day=DAY + timedelta(days=1), delay_minutes=5),
        probe(5, 0, venue_id=4, baseline=True, day=week, delay_minutes=None),
    ]
    evs = [event(i, venue_id=i) for i in range(1, 6)]
    got = {r["event_id"]: (r["baseline_tier"], r["baseline_delay"]) for r in baseline.baseline_match_tiers(events(spark, evs), meas(spark, probes)).collect()}
    assert got == {1: ("exact_match", 2), 2: ("same_hour", 3), 3: ("same_day", 4), 4: ("venue_average", 5), 5: ("none", None)}


def test_halves_of_crowded_seconds_match_brute_force(spark, monkeypatch):
    """All rows of a venue in one second, at several instants, and many starts whose cut falls into it."""
    monkeypatch.setattr(halves, "BLOCK_BITS", 4)
    r = random.Random(9)
    at = datetime(2024, 1, 3, 18)
    probes = [
        probe(i, at=at + timedelta(microseconds=r.choice([0, 0, 0, 1, 500])), delay_minutes=r.choice([None, 1, 5, 9]), avg_speed_mph=r.choice([None, 10.0, 20.0]))
        for i in range(600)
    ]
    probes += [probe(1000 + i, r.uniform(-119, 119), delay_minutes=i % 7) for i in range(90)]
    # on the bounds of windows, and just beyond
    probes += [probe(2000 + i, at=at + timedelta(hours=h, microseconds=u)) for i, (h, u) in enumerate([(-2, 0), (-2, -1), (2, 0), (2, 1)])]
    evs = [event(i, sec=18 * 3600 + 97 * (i - 20)) for i in range(40)]
    check_halves(spark, evs, probes)


def test_one_interval_join_for_all_halves(spark):
    evs, probes = hot_fixture(6)
    e, m = events(spark, evs), meas(spark, probes)

    def interval_joins(df):
        text = df._jdf.queryExecution().executedPlan().toString()
        return sum("Join" in line and "_bin" in line for line in text.splitlines())

    assert interval_joins(halves.halves_by_cells(linking.start_points(e), m)) == 1
    analysed = halves.impact_before_during(e, venues(spark), m)
    top = reports.top_increases(analysed).select("category")
    assert interval_joins(reports.impact_breakdown(analysed).select("label").union(top)) == 0
