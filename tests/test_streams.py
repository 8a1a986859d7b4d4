import functools
import random
import re
from datetime import date, datetime, timedelta

from frames import DAY, event, events, meas, probe, rows
from pyspark.sql import functions as F

from crowdlane.operators import aggregates, linking, upserts
from crowdlane.sources.tables import TABLES
from crowdlane.sources.versions import Versions
from crowdlane.streaming import measurements as streams
from test_loads import NOW, batch


def arrivals(spark, path, *frames):
    """Each frame becomes one file, taken as one micro-batch."""
    for i, df in enumerate(frames):
        df.coalesce(1).write.mode("append").parquet(f"{path}/part={i}")
    return (
        spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
    )


def test_links_equal_the_batch_result(spark, tmp_path):
    evs = events(spark, [event(1), event(2, sec=20 * 3600)])
    first, second = meas(spark, [probe(1), probe(2, 100)]), meas(spark, [probe(3, 130, baseline=True), probe(4, 300)])
    stream = arrivals(spark, tmp_path / "in", first, second)
    streams.stream_link_events(stream, evs, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {r["measurement_id"]: r["event_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r["measurement_id"]: r["event_id"] for r in linking.link_measurements(first.union(second), evs).collect()}
    assert got == want == {1: 1, 2: 2, 3: None, 4: None}
    # a finished stream started again adds nothing
    streams.stream_link_events(stream, evs, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_upserts_equal_one_after_another(spark, tmp_path):
    target = events(spark, [event(1, event_name="A", venue_name="V"), *(event(10 + i, event_name=f"Other {i}", venue_name="W") for i in range(40))])
    loads = [
        batch(spark, ("A", "V", DAY), ("B", "V", DAY)),
        batch(spark, ("B", "V", DAY), ("C", None, date(2024, 5, 1)), category="Newer"),
        batch(spark, ("C", None, date(2024, 5, 1)), ("B", "V", DAY), ("D", "V", DAY), category="Newest"),
    ]
    root, cp = str(tmp_path / "t"), str(tmp_path / "cp")
    table = Versions(spark, root, target.schema)

    def run(i):
        arrivals(spark, tmp_path / "in" / str(i), *loads[i : i + 2])
        stream = spark.readStream.schema(loads[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*/*")
        streams.stream_upsert_events(stream, target, root, cp, NOW).awaitTermination()

    want, states = target, []
    for load in loads:
        want = upserts.upsert_events(want, load, NOW)
        states.append(sorted(want.collect(), key=str))
    run(0)
    assert sorted(table.read().collect(), key=str) == states[1] and sorted(table.read(1).collect(), key=str) == states[0]
    first = {b: table._of(b) for b in table.buckets()}
    run(2)  # started again
    assert sorted(table.read().collect(), key=str) == states[2]
    assert {r["event_name"]: r["category"] for r in table.read().collect() if r["event_name"] < "E"} == {"A": "New", "B": "Newest", "C": "Newest", "D": "Newest"}
    assert [table.note(v)["max_id"] for v in table.commits()] == [49, 51, 53, 56]
    assert [(n["events_loaded"], n["new_events"]) for n in map(table.note, table.commits()[1:])] == [(2, 1), (2, 1), (3, 2)]
    # buckets that no batch touched have their first version only, touched ones at most two
    untouched = [b for b in table.buckets() if table._of(b) == [0]]
    assert len(untouched) >= 15 and all(first[b] == [0] for b in untouched)
    assert all(len(table._of(b)) <= 2 for b in table.buckets())
    times = [f.stat().st_mtime for b in untouched for f in (tmp_path / "t" / "data" / f"bucket={b}").rglob("*.parquet")]
    assert max(times) <= min(f.stat().st_mtime for f in (tmp_path / "t" / "data").rglob("version=1/*.parquet"))


def test_hours_equal_the_batch_report_also_while_open(spark, tmp_path):
    r = random.Random(3)

    def some(first, n, hours):
        at = [datetime(2024, 1, 3, *[0] * 3) + timedelta(hours=r.choice(hours), seconds=r.randrange(3600)) for _ in range(n)]
        return [
            probe(first + i, at=t, venue_id=r.choice([1, 2, 3, None]), event_id=r.choice([None, 7, 8]), baseline=i % 3 == 0, delay_minutes=r.choice([None, 2, 5]))
            for i, t in enumerate(at)
        ]

    frames = [meas(spark, some(100 * i, 40, hours)) for i, hours in enumerate([(22, 23), (24, 25), (25, 26)])]
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def run(*new):
        if new:
            arrivals(spark, tmp_path / "in" / str(len(new)), *new)
        stream = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*/*")
        streams.stream_hourly_activity(stream, out, cp).awaitTermination()
        return streams.read_hourly_activity(spark, out, streams.activity_cells(stream).schema)

    def expected(*given):
        return rows(aggregates.hourly_activity(functools.reduce(lambda a, b: a.unionByName(b), given)))

    assert rows(run(frames[0])) == expected(frames[0])
    # started again with more to read, and once more with nothing new
    for new in (frames[1:], []):
        assert rows(run(*new)) == expected(*frames)
    table = Versions(spark, out, streams.activity_cells(meas(spark, [probe(1)])).schema)
    # a day no later batch touched stays as it was written
    assert table._of("20240103") == [0] and table._of("20240104") == [2, 3] and table.commits() == [0, 1, 2, 3, 4]


def test_a_batch_run_again_and_half_a_batch(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"), spark.range(0).schema)
    numbered = lambda a, b: spark.range(a, b).withColumn("bucket", F.col("id") % 3)
    assert table.read().collect() == [] and table.commits() == []
    table.write(numbered(0, 9), 0)
    assert table.read().collect() == []
    table.commit(0, n=9)
    for _ in range(2):
        table.write(numbered(0, 12).where("bucket = 1"), 1)
    assert table.read().count() == 9 and table.read(1).count() == 10
    table.commit(1)
    table.commit(1)
    assert table.read().count() == 10 and table.note(0) == {"n": 9} and table.read(buckets=["1"]).count() == 4
    table.write(numbered(0, 15).where("bucket = 1"), 2)
    table.retire(2, ["1", "2"])
    assert table._of("1") == [1, 2] and table._of("2") == [0] and table.read(0, ["1"]).count() == 0


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    early = meas(spark, [probe(1, at=datetime(2024, 1, 3, 8, 10)), probe(2, at=datetime(2024, 1, 3, 8, 50), baseline=True), probe(3, at=datetime(2024, 1, 3, 12, 30))])
    # a watermark holds for the batch after the one that raised it
    more = meas(spark, [probe(6, at=datetime(2024, 1, 3, 12, 40))])
    late = meas(spark, [probe(4, at=datetime(2024, 1, 3, 8, 20)), probe(5, at=datetime(2024, 1, 3, 16))])
    stream = arrivals(spark, tmp_path / "in", early, more, late)
    streams.stream_hourly_activity(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = streams.read_hourly_activity(spark, str(tmp_path / "out"), streams.activity_cells(stream).schema)
    assert [(r["collection_hour"].hour, r["measurements"], r["baseline_count"]) for r in got.orderBy("collection_hour").collect()] == [
        (8, 2, 1),
        (12, 2, 0),
        (16, 1, 0),
    ]


def test_probes_become_measurements(spark, tmp_path):
    raw = spark.createDataFrame(
        [
            (1, datetime(2024, 1, 3, 8), "flow", '{"flowSegmentData": {"currentSpeed": 20, "currentTravelTime": 180, "freeFlowTravelTime": 60}}'),
            (2, datetime(2024, 1, 3, 9), "route", '{"routes": [{"summary": {"lengthInMeters": 1000, "travelTimeInSeconds": 60}}]}'),
            (3, datetime(2024, 1, 4, 9), "flow", "{}"),
            (4, datetime(2024, 1, 4, 9), "other", "{}"),
        ],
        "measurement_id BIGINT, measurement_time TIMESTAMP_NTZ, payload_kind STRING, payload STRING",
    ).selectExpr("*", "1L AS venue_id", "true AS is_baseline", "'weekly' AS baseline_type", "35D AS origin_lat", "-106D AS origin_lng")
    stream = arrivals(spark, tmp_path / "in", raw)
    streams.stream_measurements(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert all(len(list(day.rglob("*.parquet"))) == 1 for day in (tmp_path / "out").glob("measurement_date=*"))
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("measurement_id").collect()
    assert [(r["measurement_id"], r["delay_minutes"], r["data_source"], r["hour_of_day"]) for r in got] == [(1, 2, "tomtom", 8), (2, 0, "tomtom", 9)]
    # the stored table has the declared columns, with the payload as it came
    stored = spark.read.schema(TABLES["traffic_measurements"]).parquet(str(tmp_path / "out"))
    assert stored.where("raw_response like '{%' and avg_speed_mph > 0").count() == 2


def test_a_batch_reads_only_the_days_it_can_reach(spark, tmp_path):
    days = [event(i, day=DAY + timedelta(days=i)) for i in range(10)]
    events(spark, days).write.partitionBy("event_start_date").parquet(str(tmp_path / "schedule"))
    schedule = spark.read.parquet(str(tmp_path / "schedule"))
    late = meas(spark, [probe(1, day=DAY + timedelta(days=3)), probe(2, at=datetime(2024, 1, 7, 23, 30)), probe(3, baseline=True, day=DAY + timedelta(days=9))])
    linked = streams.link_batch(late, schedule)
    text = linked._jdf.queryExecution().executedPlan().toString()
    # 2024-01-06 and, within two hours of the last row, 2024-01-08
    assert "PartitionFilters: [isnotnull(event_start_date" in text
    bounds = linked._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"event_start_date#\d+ >= 2024-01-06", bounds) and re.search(r"event_start_date#\d+ <= 2024-01-08", bounds)
    assert {r["measurement_id"]: r["event_id"] for r in linked.collect()} == {1: 3, 2: None, 3: None}
    assert streams.link_batch(late.where("is_baseline"), schedule).collect()[0]["event_id"] is None


def test_later_changes_of_the_schedule_count(spark, tmp_path):
    path = str(tmp_path / "schedule")
    events(spark, [event(1)]).write.parquet(path)
    seen = []

    def schedule():
        if seen:
            events(spark, [event(2, sec=20 * 3600)]).write.mode("append").parquet(path)
        seen.append(1)
        return spark.read.parquet(path)

    stream = arrivals(spark, tmp_path / "in", meas(spark, [probe(1, 120)]), meas(spark, [probe(2, 120)]))
    streams.stream_link_events(stream, schedule, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert {r["measurement_id"]: r["event_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {1: 1, 2: 2}


def test_one_parse_serves_all_kinds(spark):
    raw = spark.createDataFrame([(1, datetime(2024, 1, 3, 8), "flow", "{}", 35.0, -106.0)], "measurement_id BIGINT, measurement_time TIMESTAMP_NTZ, payload_kind STRING, payload STRING, origin_lat DOUBLE, origin_lng DOUBLE")
    rows = streams.parse_probes(raw.selectExpr("*", "true AS is_baseline", "'weekly' AS baseline_type"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # the filter on usable answers and the answer itself
    assert plan.lower().count("from_json(") <= 2 or plan.count("from_json") <= 2
