"""JSON answers of traffic and geocoding services to typed structs.

Every parser returns one struct column, NULL where the payload carries no usable
answer, so a caller filters on it and expands it in one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from crowdlane import schema
from crowdlane.functions.clock import col
from crowdlane.functions.geo import haversine_miles
from crowdlane.functions.levels import traffic_level
from crowdlane.functions.text import let

MILES_PER_METER = 0.000621371
METERS_PER_MILE = 1609.34


def parse_flow(payload: Column | str, lat: Column | None = None, lng: Column | None = None) -> Column:
    """Road-segment flow: speeds, times, delay, segment length, level and confidence.

    ``lat``/``lng`` (the probed point) stand in for coordinates a segment end lacks.
    """
    own_lat = lat if lat is not None else F.lit(None).cast("double")
    own_lng = lng if lng is not None else F.lit(None).cast("double")
    segment = F.from_json(col(payload), schema.FLOW_PAYLOAD)["flowSegmentData"]
    return let(segment, lambda flow: _flow_answer(flow, own_lat, own_lng))


def _flow_answer(flow: Column, own_lat: Column, own_lng: Column) -> Column:
    speed = F.coalesce(flow["currentSpeed"], F.lit(0.0))
    typical = F.coalesce(flow["freeFlowSpeed"], F.lit(0.0))
    seconds = F.coalesce(flow["currentTravelTime"], F.lit(0))
    typical_seconds = F.coalesce(flow["freeFlowTravelTime"], F.lit(0))
    delay = (seconds - typical_seconds) / 60.0
    path = flow["coordinates"]["coordinate"]
    first, last = F.get(path, F.lit(0)), F.get(path, F.size(path) - 1)
    length = haversine_miles(
        F.coalesce(first["latitude"], own_lat),
        F.coalesce(first["longitude"], own_lng),
        F.coalesce(last["latitude"], own_lat),
        F.coalesce(last["longitude"], own_lng),
        form="asin",
    )
    by_speed = F.when(speed > 0, seconds / 3600.0 * speed).otherwise(0.0)
    miles = F.when(F.size(path) >= 2, length).otherwise(by_speed)
    out = F.struct(
        traffic_level(delay).alias("traffic_level"),
        F.round(speed, 2).alias("avg_speed_mph"),
        F.round(typical, 2).alias("typical_speed_mph"),
        seconds.alias("travel_time_seconds"),
        typical_seconds.alias("typical_time_seconds"),
        F.round(delay, 2).alias("delay_minutes"),
        F.when(miles > 0, F.round(miles, 2)).alias("distance_miles"),
        F.coalesce(flow["confidence"], F.lit(0.0)).alias("confidence"),
        F.lit("tomtom").alias("data_source"),
    )
    return F.when(flow.isNotNull(), out)


def parse_route(payload: Column | str) -> Column:
    """First route: length, speeds from length and time, delay against the no-traffic time."""
    first = F.get(F.from_json(col(payload), schema.ROUTE_PAYLOAD)["routes"], F.lit(0))["summary"]
    return let(first, _route_answer)


def _route_answer(summary: Column) -> Column:
    miles = F.coalesce(summary["lengthInMeters"], F.lit(0.0)) * MILES_PER_METER
    seconds = F.coalesce(summary["travelTimeInSeconds"], F.lit(0))
    free_seconds = F.coalesce(summary["noTrafficTravelTimeInSeconds"], seconds)
    speed = F.when(seconds > 0, miles / seconds * 3600).otherwise(0.0)
    typical = F.when(free_seconds > 0, miles / free_seconds * 3600).otherwise(speed)
    delay = (seconds - free_seconds) / 60.0
    out = F.struct(
        traffic_level(delay).alias("traffic_level"),
        F.round(speed, 2).alias("avg_speed_mph"),
        F.round(typical, 2).alias("typical_speed_mph"),
        seconds.alias("travel_time_seconds"),
        free_seconds.alias("typical_time_seconds"),
        F.round(delay, 2).alias("delay_minutes"),
        F.round(miles, 2).alias("distance_miles"),
        F.lit("tomtom").alias("data_source"),
    )
    return F.when(summary.isNotNull(), out)


def parse_matrix(payload: Column | str) -> Column:
    """First element of a distance matrix; both status fields must read OK."""
    return let(F.from_json(col(payload), schema.MATRIX_PAYLOAD), _matrix_answer)


def _matrix_answer(doc: Column) -> Column:
    element = F.get(F.get(doc["rows"], F.lit(0))["elements"], F.lit(0))
    miles = element["distance"]["value"] / METERS_PER_MILE
    typical_seconds = element["duration"]["value"]
    seconds = F.coalesce(element["duration_in_traffic"]["value"], typical_seconds)
    delay = F.round((seconds - typical_seconds) / 60.0, 1)
    # a zero speed counts as missing, like a zero time
    speed = F.nullif(F.when(seconds > 0, miles / seconds * 3600), F.lit(0.0))
    typical = F.nullif(F.when(typical_seconds > 0, miles / typical_seconds * 3600), F.lit(0.0))
    out = F.struct(
        traffic_level(delay, "matrix").alias("traffic_level"),
        F.round(speed, 2).alias("avg_speed_mph"),
        F.round(typical, 2).alias("typical_speed_mph"),
        seconds.alias("travel_time_seconds"),
        typical_seconds.alias("typical_time_seconds"),
        delay.alias("delay_minutes"),
        F.round(miles, 2).alias("distance_miles"),
        F.lit("google_maps").alias("data_source"),
    )
    return F.when((doc["status"] == "OK") & (element["status"] == "OK"), out)


def parse_probe(payload: Column | str, kind: Column | str, lat: Column | None = None, lng: Column | None = None) -> Column:
    """What flow, route and matrix answers have in common, by the ``kind`` of the payload; NULL for other kinds.

    The text is parsed once, by a schema that has the fields of all kinds, which do not clash.
    """
    own = [c if c is not None else F.lit(None).cast("double") for c in (lat, lng)]
    shared = [
        "traffic_level",
        "avg_speed_mph",
        "typical_speed_mph",
        "travel_time_seconds",
        "typical_time_seconds",
        "delay_minutes",
        "distance_miles",
        "data_source",
    ]

    def narrow(answer: Column) -> Column:
        return F.when(answer.isNotNull(), F.struct(*[answer[c].alias(c) for c in shared]))

    def any_kind(doc: Column) -> Column:
        route = F.get(doc["routes"], F.lit(0))["summary"]
        return (
            F.when(col(kind) == "flow", let(_flow_answer(doc["flowSegmentData"], *own), narrow))
            .when(col(kind) == "route", let(_route_answer(route), narrow))
            .when(col(kind) == "matrix", let(_matrix_answer(doc), narrow))
        )

    every = ", ".join((schema.FLOW_PAYLOAD, schema.ROUTE_PAYLOAD, schema.MATRIX_PAYLOAD))
    return let(F.from_json(col(payload), every), any_kind)


def parse_geocode(payload: Column | str) -> Column:
    """Best (first) geocoding result; also serves reverse lookups, whose location is NULL."""

    def answer(best: Column) -> Column:
        location = best["geometry"]["location"]
        out = F.struct(
            location["lat"].alias("latitude"),
            location["lng"].alias("longitude"),
            best["formatted_address"].alias("formatted_address"),
            best["place_id"].alias("place_id"),
        )
        return F.when(best.isNotNull(), out)

    return let(F.get(F.from_json(col(payload), schema.GEOCODE_PAYLOAD), F.lit(0)), answer)
