"""Small hand-made tables."""

from datetime import date, datetime, timedelta

EVENTS = """event_id BIGINT, event_name STRING, venue_name STRING, venue_id BIGINT, category STRING,
            event_start_date DATE, event_end_date DATE, start_sec INT, is_multi_day BOOLEAN, sponsor STRING,
            cost_min DOUBLE, cost_description STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"""
VENUES = "venue_id BIGINT, venue_name STRING, latitude DOUBLE, longitude DOUBLE"
MEAS = """measurement_id BIGINT, venue_id BIGINT, measurement_time TIMESTAMP_NTZ, is_baseline BOOLEAN,
          baseline_type STRING, data_source STRING, delay_minutes INT, avg_speed_mph DOUBLE, typical_speed_mph DOUBLE,
          distance_miles DOUBLE, traffic_level STRING, day_of_week INT, hour_of_day INT, event_id BIGINT"""

DAY = date(2024, 1, 3)  # a Wednesday


def event(event_id, venue_id=1, day=DAY, sec=18 * 3600, **more):
    row = {
        "event_id": event_id,
        "event_name": f"Event {event_id}",
        "venue_name": f"Venue {venue_id}",
        "venue_id": venue_id,
        "category": "Sports",
        "event_start_date": day,
        "event_end_date": day,
        "start_sec": sec,
        "is_multi_day": False,
        "sponsor": None,
        "cost_min": None,
        "cost_description": None,
        "created_at": datetime(2023, 1, 1),
        "updated_at": datetime(2023, 1, 1),
    }
    return {**row, **more}


def probe(measurement_id, minutes=0.0, venue_id=1, baseline=False, day=DAY, at=None, **more):
    """A measurement ``minutes`` after 18:00 of the day."""
    t = at or datetime(day.year, day.month, day.day, 18) + timedelta(minutes=minutes)
    row = {
        "measurement_id": measurement_id,
        "venue_id": venue_id,
        "measurement_time": t,
        "is_baseline": baseline,
        "baseline_type": "weekly" if baseline else None,
        "data_source": "tomtom",
        "delay_minutes": 1,
        "avg_speed_mph": 30.0,
        "typical_speed_mph": 45.0,
        "distance_miles": 2.0,
        "traffic_level": "moderate",
        "day_of_week": (t.weekday() + 1) % 7,
        "hour_of_day": t.hour,
        "event_id": None,
    }
    return {**row, **more}


def events(spark, rows):
    return spark.createDataFrame(rows, EVENTS)


def meas(spark, rows):
    return spark.createDataFrame(rows, MEAS)


def venues(spark, ids=(1, 2)):
    return spark.createDataFrame([(i, f"Venue {i}", 35.0 + i / 100, -106.0) for i in ids], VENUES)


def rows(df, *order):
    names = df.columns
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
