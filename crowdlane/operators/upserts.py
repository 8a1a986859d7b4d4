"""Deduplication and upserts of events and venues.

A table snapshot plus a batch gives the next snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from crowdlane.functions import clock

EVENT_KEY = ["event_name", "event_start_date", "venue_name"]
VENUE_KEY = ["venue_name"]
EVENT_KEEP = ["event_id", "venue_id", "created_at"]
# What a venue row gets when no city or state is given.
DEFAULT_CITY, DEFAULT_STATE = "Albuquerque", "NM"
VENUE_KEEP = ["venue_id", "city", "state", "created_at"]


def dedup_events(batch: DataFrame, key: Sequence[str] = EVENT_KEY, order: str = "input_seq") -> DataFrame:
    """First row per key in batch order; missing key parts equal each other.

    Keeping rank 1 lets Spark drop all but one row per key before the shuffle.
    """
    first = Window.partitionBy(*key).orderBy(order)
    return batch.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def last_of_batch(batch: DataFrame, key: Sequence[str], order: str = "input_seq") -> DataFrame:
    """Last row per key in batch order: the outcome of upserting rows one after another."""
    last = Window.partitionBy(*key).orderBy(F.desc(order))
    return batch.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").drop("_rank")


#: what became of a row of the table after a load
KEPT, UPDATED, NEW = "kept", "updated", "new"


def upsert(
    target: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    id_col: str,
    keep: Sequence[str],
    as_of: str,
    order: str = "input_seq",
    max_id: int | None = None,
    state: str | None = None,
) -> DataFrame:
    """The table after inserting ``batch`` with update on key conflict.

    Matched rows take every batch column except ``keep`` and the key, and a new
    ``updated_at``. A key with a NULL part conflicts with nothing, so such rows are
    plain inserts; in the one full join they match nothing. A new row's id is the largest old id
    (``max_id`` where it is known) plus its place in the batch (``order``, from 1): unique, repeatable, with gaps
    where a row was an update, as a sequence leaves them. ``batch`` has unique keys.
    ``state`` names a column that tells whether the row was kept, updated or is new.
    """
    now = clock.moment(as_of)
    last_id = F.coalesce(target.agg(F.max(id_col)).scalar(), F.lit(0)) if max_id is None else F.lit(max_id)
    incoming = [c for c in batch.columns if c in target.columns and c not in keep and c != "updated_at"]
    old = target.select(*(F.col(c).alias(f"_k_{c}") for c in key), F.struct(*target.columns).alias("_old"))
    new = batch.select(*(F.col(c).alias(f"_n_{c}") for c in key), F.col(order).alias("_place"), F.struct(*incoming).alias("_new"))
    same = reduce(lambda x, y: x & y, [F.col(f"_k_{c}") == F.col(f"_n_{c}") for c in key])
    both = old.join(new, same, "full")
    is_new, is_old = F.col("_old").isNull(), F.col("_new").isNull()

    def value(c: str) -> Column:
        held, given = F.col(f"_old.{c}"), F.col(f"_new.{c}") if c in incoming else F.lit(None)
        first = given
        if c == id_col:
            first = (last_id + F.col("_place")).cast(target.schema[c].dataType)
        elif c in ("created_at", "updated_at"):
            first = now
        elif c == "is_multi_day" and c in incoming:
            first = F.coalesce(given, F.lit(False))
        if c == "updated_at":
            held = F.when(is_old, held).otherwise(now)
        elif c in incoming and c not in key:
            held = F.when(is_old, held).otherwise(given)
        return F.when(is_new, first).otherwise(held).alias(c)

    out = [value(c) for c in target.columns]
    if state:
        out.append(F.when(is_new, NEW).when(is_old, KEPT).otherwise(UPDATED).alias(state))
    return both.select(out)


def upsert_events(target: DataFrame, batch: DataFrame, as_of: str) -> DataFrame:
    """Events after loading a batch; within the batch the first row of a key wins."""
    return upsert(target, dedup_events(batch), EVENT_KEY, "event_id", EVENT_KEEP, as_of)


def upsert_venues(target: DataFrame, batch: DataFrame, as_of: str) -> DataFrame:
    """Venues after loading geocoded rows one by one, so the last row of a name wins."""
    out = upsert(target, last_of_batch(batch, VENUE_KEY), VENUE_KEY, "venue_id", VENUE_KEEP, as_of)
    return out.withColumns(
        {"city": F.coalesce("city", F.lit(DEFAULT_CITY)), "state": F.coalesce("state", F.lit(DEFAULT_STATE))}
    )


def load_counts(state: str = "state") -> list[Column]:
    """Rows loaded, new, updated and in the table, from the states of :func:`upsert`."""
    count = lambda *states: F.count(F.when(F.col(state).isin(*states), 1))
    return [
        count(NEW, UPDATED).alias("events_loaded"),
        count(UPDATED).alias("updated_events"),
        count(NEW).alias("new_events"),
        F.count("*").alias("total_in_db"),
    ]


def load_stats(target: DataFrame, batch: DataFrame) -> DataFrame:
    """One row: batch rows loaded, new, updated, and the table's size afterwards, from the rows of the load itself."""
    after = upsert(target, dedup_events(batch), EVENT_KEY, "event_id", EVENT_KEEP, "1970-01-01", max_id=0, state="state")
    return after.agg(*load_counts())


def link_events_to_venues(events: DataFrame, venues: DataFrame) -> DataFrame:
    """Fill a missing venue id by venue name; events that have one keep it.

    Only events lacking the id are joined, so the rest are not shuffled.
    """
    lacking = events.filter(F.col("venue_id").isNull() & F.col("venue_name").isNotNull())
    others = events.filter(F.col("venue_id").isNotNull() | F.col("venue_name").isNull())
    ids = venues.select("venue_name", F.col("venue_id").alias("_venue_id"))
    filled = lacking.join(ids, "venue_name", "left").withColumn("venue_id", F.col("_venue_id"))
    return others.unionByName(filled.select(events.columns))


def distinct_venues(events: DataFrame) -> DataFrame:
    """Venue names in use, without blanks."""
    return events.filter("venue_name IS NOT NULL AND venue_name <> ''").select("venue_name").distinct()


def venues_to_geocode(events: DataFrame, venues: DataFrame) -> DataFrame:
    """Venue names in use that have no venue row yet."""
    return distinct_venues(events).join(venues.select("venue_name"), "venue_name", "left_anti")
