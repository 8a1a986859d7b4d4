"""Listings before they become events: source mapping, length limits, validation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from crowdlane.schema import FIELD_LIMITS


def map_sources(sources: Mapping[str, tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """Bring several listing sources to one schema.

    Each source gives its frame and the expression of every event column it can
    fill (a fixed-venue source passes literals); the rest become NULL. A
    ``source_name`` column tells the rows apart.
    """
    frames = [
        df.select(F.lit(name).alias("source_name"), *[e.alias(c) for c, e in columns.items()])
        for name, (df, columns) in sources.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def truncate_fields(df: DataFrame, limits: Mapping[str, int] = FIELD_LIMITS, count_as: str | None = None) -> DataFrame:
    """Cut text columns to their limits; ``count_as`` adds how many columns of the row were cut."""
    present = {c: n for c, n in limits.items() if c in df.columns}
    out = {c: F.substring(c, 1, n) for c, n in present.items()}
    if count_as:
        cut = [F.coalesce((F.length(c) > n).cast("int"), F.lit(0)) for c, n in present.items()]
        out[count_as] = reduce(lambda a, b: a + b, cut, F.lit(0))
    return df.withColumns(out)


def rejection_reason() -> Column:
    """Why a listing cannot be loaded; NULL when it can. An empty name counts as missing."""
    return F.when(F.coalesce("event_name", F.lit("")) == "", "Missing event_name").when(
        F.col("event_start_date").isNull(), "Missing event_start_date"
    )


def validate_events(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason)."""
    marked = df.withColumn("reason", rejection_reason())
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")
