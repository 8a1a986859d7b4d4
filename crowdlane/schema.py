"""Declared schemas of the three base tables and the service payloads.

Spark has no usable TIME type, so a time of day is kept as whole seconds after
midnight (``start_sec``, ``end_sec``). Timestamps carry no zone.
"""

from __future__ import annotations

EVENTS = """
    event_id BIGINT, event_name STRING, venue_name STRING, category STRING,
    expected_attendance INT, latitude DECIMAL(10,8), longitude DECIMAL(11,8),
    source_url STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ,
    venue_id BIGINT, event_start_date DATE, event_end_date DATE,
    start_sec INT, end_sec INT, is_multi_day BOOLEAN, sponsor STRING,
    cost_min DECIMAL(10,2), cost_max DECIMAL(10,2), cost_description STRING,
    phone STRING, email STRING, ticket_url STRING, website_url STRING"""

VENUES = """
    venue_id BIGINT, venue_name STRING, address STRING, city STRING, state STRING,
    latitude DECIMAL(10,8), longitude DECIMAL(11,8), place_id STRING,
    created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"""

MEASUREMENTS = """
    measurement_id BIGINT, venue_id BIGINT, measurement_time TIMESTAMP_NTZ,
    traffic_level STRING, avg_speed_mph DECIMAL(5,2), typical_speed_mph DECIMAL(5,2),
    travel_time_seconds INT, typical_time_seconds INT, delay_minutes INT,
    data_source STRING, origin_lat DECIMAL(10,8), origin_lng DECIMAL(11,8),
    destination_lat DECIMAL(10,8), destination_lng DECIMAL(11,8),
    distance_miles DECIMAL(6,2), raw_response STRING, created_at TIMESTAMP_NTZ,
    event_id BIGINT, is_baseline BOOLEAN, baseline_type STRING,
    day_of_week INT, hour_of_day INT"""

FLOW_PAYLOAD = """
    flowSegmentData STRUCT<currentSpeed: DOUBLE, freeFlowSpeed: DOUBLE,
    currentTravelTime: BIGINT, freeFlowTravelTime: BIGINT, confidence: DOUBLE,
    coordinates: STRUCT<coordinate: ARRAY<STRUCT<latitude: DOUBLE, longitude: DOUBLE>>>>"""

ROUTE_PAYLOAD = """
    routes ARRAY<STRUCT<summary: STRUCT<lengthInMeters: DOUBLE,
    travelTimeInSeconds: BIGINT, noTrafficTravelTimeInSeconds: BIGINT>>>"""

MATRIX_PAYLOAD = """
    status STRING, rows ARRAY<STRUCT<elements: ARRAY<STRUCT<status: STRING,
    distance: STRUCT<value: DOUBLE>, duration: STRUCT<value: BIGINT>,
    duration_in_traffic: STRUCT<value: BIGINT>>>>>"""

GEOCODE_PAYLOAD = """
    ARRAY<STRUCT<geometry: STRUCT<location: STRUCT<lat: DOUBLE, lng: DOUBLE>>,
    formatted_address: STRING, place_id: STRING>>"""

# Column length limits enforced before a load.
FIELD_LIMITS = {
    "event_name": 255,
    "venue_name": 255,
    "address": 500,
    "category": 100,
    "sponsor": 500,
    "cost_description": 255,
    "phone": 20,
    "email": 255,
    "ticket_url": 1000,
    "website_url": 1000,
    "source_url": 1000,
}
