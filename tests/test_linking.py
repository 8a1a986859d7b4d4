import random
from datetime import datetime, timedelta

from frames import DAY, event, events, meas, probe, rows, venues

from crowdlane.operators import linking


def start_of(e):
    return datetime(e["event_start_date"].year, e["event_start_date"].month, e["event_start_date"].day) + timedelta(seconds=e["start_sec"])


def hot_fixture(seed):
    """A third of all rows at one venue in one hour, copies included; the rest spread out."""
    r = random.Random(seed)
    evs, probes = [], []
    for i in range(60):
        hot = i % 3 == 0
        sec = 17 * 3600 + r.randrange(0, 7200, 300) if hot else r.randrange(0, 86400)
        evs.append(event(i, venue_id=1 if hot else r.choice([2, 3, None]), sec=None if i % 11 == 10 else sec, day=DAY + timedelta(days=0 if hot else r.randrange(2))))
    for i in range(300):
        hot = i % 3 == 0
        t = datetime(2024, 1, 3, 18) + (timedelta(seconds=r.choice([0, 0, 0, 1800, 3599])) if hot else timedelta(seconds=r.uniform(-50000, 90000)))
        probes.append(probe(i, venue_id=1 if hot else r.choice([2, 3, None]), at=t, baseline=r.choice([False, False, True, None]), delay_minutes=r.choice([None, 0, 1, 3, 9]), avg_speed_mph=float(r.randrange(10, 60))))
    return evs, probes


def pairs(evs, probes, seconds=7200):
    for e in evs:
        if e["start_sec"] is None or e["venue_id"] is None:
            continue
        for m in probes:
            if m["venue_id"] == e["venue_id"] and abs((m["measurement_time"] - start_of(e)).total_seconds()) <= seconds:
                yield e, m


def test_nearest_event_matches_brute_force(spark):
    evs, probes = hot_fixture(1)
    best = {}
    for e, m in pairs(evs, probes):
        if m["is_baseline"] is False:
            key = (abs(m["measurement_time"] - start_of(e)), e["event_id"])
            best[m["measurement_id"]] = min(best.get(m["measurement_id"], key), key)
    got = linking.link_measurements(meas(spark, probes), events(spark, evs)).collect()
    assert len(got) == len(probes)
    assert {r["measurement_id"]: r["event_id"] for r in got if r["event_id"] is not None} == {k: v[1] for k, v in best.items()}


def test_window_pairs_match_brute_force(spark):
    evs, probes = hot_fixture(2)
    want = sorted((e["event_id"], m["measurement_id"]) for e, m in pairs(evs, probes))
    points = linking.event_points(events(spark, evs), "event_id")
    got = linking.window_pairs(points, meas(spark, probes), ["measurement_id"])
    assert sorted((r["event_id"], r["measurement_id"]) for r in got.collect()) == want
    semi = linking.events_with_traffic(events(spark, evs), meas(spark, probes))
    assert sorted(r["event_id"] for r in semi.collect()) == sorted({e for e, _ in want})


def test_bounds_are_inclusive_and_ties_go_to_the_smaller_id(spark):
    evs = [event(7, sec=17 * 3600), event(5, sec=19 * 3600), event(6, sec=19 * 3600)]
    probes = [probe(1, 0), probe(2, 180), probe(3, 180 + 1 / 60000), probe(4, -180), probe(5, -181)]
    got = dict(
        (r["measurement_id"], r["event_id"])
        for r in linking.link_measurements(meas(spark, probes), events(spark, evs)).collect()
    )
    assert got == {1: 5, 2: 5, 3: None, 4: 7, 5: None}


def test_rows_with_an_event_or_an_unknown_flag_are_left_alone(spark):
    probes = [probe(1, event_id=99), probe(2, baseline=None), probe(3, baseline=True), probe(4)]
    got = linking.link_measurements(meas(spark, probes), events(spark, [event(1)])).collect()
    assert {r["measurement_id"]: (r["event_id"], r["is_baseline"]) for r in got} == {1: (99, False), 2: (None, None), 3: (None, True), 4: (1, False)}


def test_missing_start_counts_as_midnight_only_for_single_events(spark):
    evs, probes = [event(1, sec=None)], [probe(1, at=datetime(2024, 1, 3, 1)), probe(2, 0)]
    flat = linking.traffic_for_event(events(spark, evs), venues(spark), meas(spark, probes))
    assert [r["measurement_id"] for r in flat.collect()] == [1]
    assert linking.event_traffic_data(events(spark, evs), venues(spark), meas(spark, probes)).count() == 0


def test_occurrences_guard_reversed_and_unknown_ranges(spark):
    later = DAY + timedelta(days=2)
    evs = [
        event(1, event_end_date=later, is_multi_day=True),
        event(2, event_end_date=DAY - timedelta(days=1), is_multi_day=True),
        event(3, event_end_date=later, is_multi_day=False),
        event(4, event_end_date=later, is_multi_day=None),
        event(5, event_end_date=None, is_multi_day=None),
        event(6, is_multi_day=None),
    ]
    got = linking.event_occurrences(events(spark, evs)).collect()
    count = {i: sum(r["event_id"] == i for r in got) for i in range(1, 7)}
    assert count == {1: 3, 2: 0, 3: 1, 4: 0, 5: 0, 6: 1}
    assert [r["is_primary_day"] for r in got if r["event_id"] == 1] == [True, False, False]


def test_multi_day_window_stops_at_midnight(spark):
    evs = [event(1, sec=23 * 3600, event_end_date=DAY + timedelta(days=1), is_multi_day=True)]
    probes = [probe(1, at=datetime(2024, 1, 3, 23, 30)), probe(2, at=datetime(2024, 1, 4, 0, 30)), probe(3, at=datetime(2024, 1, 4, 21))]
    got = linking.multi_day_window_match(events(spark, evs), meas(spark, probes)).collect()
    assert sorted((r["measurement_id"], r["hours_from_start"]) for r in got) == [(1, 0.5), (3, -2.0)]


def test_before_during_after(spark):
    probes = [probe(1, -16, delay_minutes=1), probe(2, -15, delay_minutes=9), probe(3, 15, delay_minutes=9), probe(4, 16, delay_minutes=4)]
    got = linking.before_during_after(events(spark, [event(1)]), venues(spark), meas(spark, probes)).first()
    assert (got["avg_delay_before"], got["avg_delay_during"], got["avg_delay_after"], got["impact_minutes"]) == (1, 9, 4, 3)
    only_before = linking.before_during_after(events(spark, [event(1)]), venues(spark), meas(spark, probes[:1]))
    assert rows(only_before) == []


def test_backfill_report_and_limit(spark):
    e, m = events(spark, [event(1), event(2, sec=20 * 3600)]), meas(spark, [probe(1, -30), probe(2, 130)])
    got = {r["measurement_id"]: (r["event_id"], r["event_datetime"].hour, r["hours_from_event"]) for r in linking.match_events(m, e).collect()}
    assert got == {1: (1, 18, -0.5), 2: (2, 20, 1 / 6)}
    assert [r["event_id"] for r in linking.events_with_traffic(e, m, limit=1).collect()] == [1]
