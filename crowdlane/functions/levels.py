"""Classification bands. Thresholds are fixed values and strict unless stated."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from crowdlane.functions.clock import col


def impact_level(impact: Column | str, variant: str = "detail") -> Column:
    """Severity of an impact in minutes.

    ``detail``   unknown / none / low / moderate / high / severe
    ``summary``  as detail, with everything up to 1 minute called low
    ``halves``   as detail, with 0 or less called "no impact"
    ``bins``     Low / Moderate / High / Severe over (-inf,1], (1,2], (2,5], (5,inf); NULL stays NULL
    """
    x = col(impact)
    if variant == "bins":
        return (
            F.when(x > 5, "Severe").when(x > 2, "High").when(x > 1, "Moderate").when(x.isNotNull(), "Low")
        )
    upper = F.when(x.isNull(), "unknown").when(x > 5, "severe").when(x > 2, "high").when(x > 1, "moderate")
    if variant == "summary":
        return upper.otherwise("low")
    rest = {"detail": "none", "halves": "no impact"}[variant]
    return upper.when(x > 0, "low").otherwise(rest)


def data_quality(event_rows: Column | str, baseline_rows: Column | str) -> Column:
    ev, base = col(event_rows), col(baseline_rows)
    return (
        F.when(ev == 0, "no_event_data")
        .when(base == 0, "no_baseline_data")
        .when((base > 0) & (ev > 0), "complete")
        .when((base > 0) | (ev > 0), "partial")
        .otherwise("unknown")
    )


def traffic_level(delay: Column | str, variant: str = "flow") -> Column:
    """``flow`` bands by < 0.5, < 2, < 5 minutes; ``matrix`` by <= 0, <= 2, <= 5;
    ``pattern`` (hourly averages) by < 1, < 2, < 5. NULL is severe, as the last band is the rest."""
    d = col(delay)
    if variant == "matrix":
        return F.when(d <= 0, "light").when(d <= 2, "moderate").when(d <= 5, "heavy").otherwise("severe")
    first = {"flow": 0.5, "pattern": 1.0}[variant]
    return F.when(d < first, "light").when(d < 2, "moderate").when(d < 5, "heavy").otherwise("severe")


def recommendation(delay: Column | str) -> Column:
    d = col(delay)
    return (
        F.when(d > 5, "HIGH IMPACT - Consider traffic management")
        .when(d > 2, "MODERATE IMPACT - Monitor traffic")
        .when(d > 1, "LOW IMPACT")
        .otherwise("MINIMAL IMPACT")
    )


def speed_impact_minutes(distance: Column, event_speed: Column, baseline_speed: Column) -> Column:
    """Extra minutes to cover ``distance`` at event speed; NULL when a speed is zero or missing."""
    return (F.try_divide(distance, event_speed) - F.try_divide(distance, baseline_speed)) * 60
