"""Joins of a large, possibly crowded side with a side that has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def splittable(unique: DataFrame, *keys: str) -> DataFrame:
    """``unique`` with its numeric keys rewritten as expressions, to be joined with a crowded side.

    Adaptive execution splits a crowded key only where both sides of the join come
    straight from a shuffle. A side just grouped by the join keys does not: its
    partitioning is reused, and one hot key then stays one task. Behind an
    expression the old partitioning is not recognised, so the small side is
    shuffled once more and the crowded side can be split. (Inverting all bits twice
    changes nothing and, unlike adding zero, is not simplified away.)
    """
    return unique.withColumns({k: F.bitwise_not(F.bitwise_not(k)) for k in keys})
