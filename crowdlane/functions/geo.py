"""Great-circle distance and probe points around a venue."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from crowdlane.functions.clock import col

EARTH_RADIUS_MILES = 3959.0
MILES_PER_DEGREE = 69.0

# Compass names for the two usual point counts.
COMPASS = {
    4: ["North", "East", "South", "West"],
    8: ["North", "NE", "East", "SE", "South", "SW", "West", "NW"],
}


def haversine_miles(lat1: Column, lng1: Column, lat2: Column, lng2: Column, form: str = "atan2") -> Column:
    """Unrounded distance; ``form`` picks the asin or the atan2 closing step."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lng = F.radians(lng2 - lng1) / 2
    a = F.pow(F.sin(half_lat), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lng), F.lit(2)
    )
    # rounding can lift it above 1 for antipodal points; NULL stays NULL
    a = F.when(a > 1, 1.0).otherwise(a)
    arc = F.asin(F.sqrt(a)) if form == "asin" else F.atan2(F.sqrt(a), F.sqrt(1 - a))
    return arc * (2 * EARTH_RADIUS_MILES)


def sample_points(lat: Column | str, lng: Column | str, radius_miles: float, n: int = 4) -> Column:
    """Array of n structs (point_index, direction, lat, lng), evenly spaced and starting due north."""
    lat, lng = col(lat), col(lng)
    degrees = radius_miles / MILES_PER_DEGREE
    names = COMPASS.get(n)

    def point(i: Column) -> Column:
        angle = i * F.lit(2 * math.pi / n)
        name = (
            F.get(F.array(*[F.lit(x) for x in names]), i) if names else F.concat(F.lit("Point_"), i.cast("string"))
        )
        return F.struct(
            i.alias("point_index"),
            name.alias("direction"),
            (lat + F.cos(angle) * degrees).alias("lat"),
            (lng + F.try_divide(F.sin(angle) * degrees, F.cos(F.radians(lat)))).alias("lng"),
        )

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), point)
