from datetime import date, datetime

import pytest
from frames import DAY, event, events, meas, probe, venues
from pyspark.sql import functions as F

from crowdlane.operators import quality, upserts
from crowdlane.sources import listings, runlog, tables

NOW = "2024-01-15 12:00:00"
BATCH = """input_seq BIGINT, event_name STRING, venue_name STRING, event_start_date DATE, event_end_date DATE,
           start_sec INT, category STRING, is_multi_day BOOLEAN, cost_min DOUBLE"""


def batch(spark, *keys, category="New"):
    return spark.createDataFrame([(i, n, v, d, d, 3600, category, None, None) for i, (n, v, d) in enumerate(keys, 1)], BATCH)


def test_first_row_of_a_key_wins_and_null_equals_null(spark):
    df = batch(spark, ("A", None, DAY), ("A", None, DAY), ("A", "V", DAY), ("B", "V", None), ("B", "V", None))
    assert sorted(r["input_seq"] for r in upserts.dedup_events(df).collect()) == [1, 3, 4]


def test_upsert_keeps_identity_and_inserts_null_keys(spark):
    target = events(spark, [event(10, event_name="A", venue_name="V"), event(11, event_name="N", venue_name=None)])
    new = batch(spark, ("A", "V", DAY), ("A", "V", DAY), ("N", None, DAY), ("C", "V", DAY))
    got = {r["event_id"]: r for r in upserts.upsert_events(target, new, NOW).collect()}
    assert set(got) == {10, 11, 11 + 3, 11 + 4}
    assert (got[10]["category"], got[10]["venue_id"], got[10]["created_at"]) == ("New", 1, datetime(2023, 1, 1))
    assert got[10]["updated_at"] == datetime(2024, 1, 15, 12) and got[10]["is_multi_day"] is None
    assert got[11]["category"] == "Sports" and got[11]["updated_at"] == datetime(2023, 1, 1)
    assert (got[14]["event_name"], got[14]["venue_name"], got[14]["venue_id"], got[14]["is_multi_day"]) == ("N", None, None, False)
    stats = upserts.load_stats(target, new).first().asDict()
    assert stats == {"events_loaded": 3, "updated_events": 1, "new_events": 2, "total_in_db": 4}


def test_upsert_into_an_empty_table(spark):
    got = upserts.upsert_events(events(spark, []), batch(spark, ("A", "V", DAY)), NOW).collect()
    assert [r["event_id"] for r in got] == [1]


def test_link_events_to_venues_keeps_given_ids(spark):
    evs = [event(1, venue_id=None, venue_name="Venue 2"), event(2, venue_id=9, venue_name="Venue 2"), event(3, venue_id=None, venue_name=None)]
    got = upserts.link_events_to_venues(events(spark, evs), venues(spark)).collect()
    assert {r["event_id"]: r["venue_id"] for r in got} == {1: 2, 2: 9, 3: None}


def test_validation_and_truncation(spark):
    df = spark.createDataFrame([("", DAY), (None, DAY), ("A", None), ("x" * 300, DAY)], "event_name STRING, event_start_date DATE")
    good, bad = listings.validate_events(df)
    assert good.count() == 1
    assert sorted(r["reason"] for r in bad.collect()) == ["Missing event_name", "Missing event_name", "Missing event_start_date"]
    cut = listings.truncate_fields(good, count_as="n").first()
    assert len(cut["event_name"]) == 255 and cut["n"] == 1


def test_stamped_rows_append_by_day(spark, tmp_path):
    df = meas(spark, [probe(1, baseline_type="weekly", baseline=None, data_source=None), probe(2, 600, baseline=True)])
    path = str(tmp_path / "m")
    fractional = df.withColumn("delay_minutes", df.measurement_id - 0.5)
    tables.append_measurements(fractional, path)
    tables.append_measurements(fractional, path)
    got = spark.read.parquet(path).orderBy("measurement_id").collect()
    assert [r["measurement_id"] for r in got] == [1, 1, 2, 2]
    one, two = got[0], got[2]
    assert (one["is_baseline"], one["baseline_type"], one["data_source"], one["delay_minutes"]) == (False, None, "tomtom", 1)
    assert (two["baseline_type"], two["delay_minutes"], two["day_of_week"], two["hour_of_day"]) == ("weekly", 2, 4, 4)
    assert sorted({str(r["measurement_date"]) for r in got}) == ["2024-01-03", "2024-01-04"]


def test_appended_rows_are_read_back_in_declared_types(spark, tmp_path):
    df = meas(spark, [probe(1, speed, avg_speed_mph=speed) for speed in (20.0, 30.126)])
    tables.append_measurements(df.withColumn("payload", F.lit("{}")), str(tmp_path / "traffic_measurements"), NOW)
    got = tables.read_table(spark, str(tmp_path), "traffic_measurements")
    assert "payload" not in got.columns
    row = got.agg(F.sum("avg_speed_mph").cast("double").alias("speed"), F.count("created_at").alias("stamped"), F.count("raw_response").alias("raw")).first()
    assert (row["speed"], row["stamped"], row["raw"]) == (50.13, 2, 0)


def test_declared_schemas_round_trip(spark, tmp_path):
    empty = {n: spark.createDataFrame([], ddl) for n, ddl in tables.TABLES.items()}
    for name, df in empty.items():
        df.write.parquet(str(tmp_path / name))
    loaded = tables.load_tables(spark, str(tmp_path))
    tables.register_views(loaded)
    assert spark.sql("SELECT count(*) AS n FROM traffic_measurements").first()["n"] == 0


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_reports_are_written(spark, tmp_path, fmt):
    df = spark.createDataFrame([("A", 1)], "category STRING, n INT")
    tables.write_report(df, str(tmp_path / fmt), fmt)
    back = spark.read.schema(df.schema).option("header", True).format(fmt).load(str(tmp_path / fmt))
    assert back.collect() == df.collect()


def test_run_log(spark, tmp_path):
    lines = [
        "",
        "2025-07-06 08:00:01.250000 | Group: 1 | Time: 08:00 | Venues: 5/5 | Measurements: 40 | API calls: 40",
        "2025-07-08 09:30:00.125000 | Group 1 week | Not at collection time",
        "2025-07-08 09:45:30 | Not baseline week | No collection",
        "2025-07-08 11:00:02.500000 | Group: 2 | Time: 11:00 | Venues: 7/9 | Measurements: 14 | API calls: 18",
    ]
    path = tmp_path / "log.txt"
    path.write_text("\n".join(lines))
    parsed = runlog.parse_log(runlog.read_log(spark, str(path))).orderBy("run_time").collect()
    assert [r["status"] for r in parsed] == ["Collected", "Not at collection time", "No collection", "Collected"]
    assert (parsed[3]["venues_done"], parsed[3]["venues_total"], parsed[3]["measurements"], parsed[3]["api_calls"], parsed[3]["time_slot"], parsed[3]["venue_group"]) == (7, 9, 14, 18, "11:00", 2)
    assert parsed[2]["venue_group"] is None
    per_day = {str(r["run_date"]): (r["log_lines"], r["runs"], r["api_calls"]) for r in runlog.collection_log(runlog.read_log(spark, str(path))).collect()}
    assert per_day == {"2025-07-06": (1, 1, 40), "2025-07-08": (3, 1, 18)}


def test_quality_checks(spark):
    rows = [probe(1, baseline=True, event_id=5), probe(2, venue_id=77), probe(3, event_id=6, day_of_week=None), probe(4, baseline=None)]
    m, e, v = meas(spark, rows), events(spark, [event(5), event(7, venue_id=88), event(8, event_name="Event 5")]), venues(spark)
    orphans = {(r["reference"], r["missing_id"]): r["row_count"] for r in quality.orphan_rows(e, v, m).collect()}
    assert orphans == {("events.venue_id", 88): 1, ("traffic_measurements.event_id", 6): 1, ("traffic_measurements.venue_id", 77): 1}
    assert [(r["venue_id"], r["row_count"]) for r in quality.baseline_with_event(m).collect()] == [(1, 1)]
    assert [r["row_count"] for r in quality.key_violations(e, v).collect()] == [2]
    fixed = {r["measurement_id"]: (r["day_of_week"], r["hour_of_day"]) for r in quality.backfill_time_metadata(m).collect()}
    assert fixed[3] == (3, 18)
    gaps = quality.time_metadata_gaps(m).first().asDict()
    assert gaps == {"missing_before": 1, "repaired": 1, "missing_after": 0}
    unlinked = {r["issue"]: r["count"] for r in quality.data_quality_check(e, v, m).collect()}
    assert unlinked["Traffic without event or baseline flag"] == 1 and len(unlinked) == 7


def test_defaults_need_the_exact_name(spark):
    evs = [event(1, sec=None, category="Sports - Baseball"), event(2, sec=None, category="sports"), event(3, sec=None, category=None), event(4, sec=1, category="Market")]
    df = events(spark, evs).selectExpr("*", "cast(NULL AS int) AS expected_attendance")
    got = {r["event_id"]: (r["start_sec"], r["expected_attendance"]) for r in quality.fill_estimated_defaults(df).collect()}
    assert got == {1: (66900, 6000), 2: (None, None), 3: (None, None), 4: (1, 2000)}


def test_sources_map_to_one_schema(spark):
    a = spark.createDataFrame([("X", date(2026, 1, 1))], "title STRING, d DATE")
    mapped = listings.map_sources({"a": (a, {"event_name": a.title, "event_start_date": a.d}), "b": (a, {"event_name": a.title, "category": a.title})})
    assert mapped.columns == ["source_name", "event_name", "event_start_date", "category"] and mapped.count() == 2
