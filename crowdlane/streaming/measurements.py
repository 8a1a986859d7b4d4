"""The collection loop as streams: arriving payloads, hourly activity, links, event loads.

Every stream takes its checkpoint and output folders from the caller, or under the
session's shared folder; each restarts where it stopped after a lost executor or driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from crowdlane.functions import payloads
from crowdlane.functions.clock import WINDOW_SECONDS
from crowdlane.operators import aggregates, linking, upserts
from crowdlane.sources.tables import conform, stamp_measurements
from crowdlane.sources.versions import Versions


def parse_probes(raw: DataFrame) -> DataFrame:
    """Raw probes (probe columns plus ``payload`` and ``payload_kind``) to stamped measurement rows.

    ``payload_kind`` is flow, route or matrix; probes without a usable answer are dropped.
    The payload is kept as ``raw_response``.
    """
    answer = payloads.parse_probe("payload", "payload_kind", F.col("origin_lat"), F.col("origin_lng"))
    rows = raw.withColumn("_answer", answer).filter("_answer IS NOT NULL").select("*", "_answer.*")
    return stamp_measurements(
        rows.withColumn("raw_response", F.col("payload")).drop("_answer", "payload", "payload_kind")
    )


def stream_measurements(raw: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append parsed probes, in the declared types, to a table partitioned by day.

    Each batch is brought together by day before it is written, and a busy day is split, so that it makes few
    files. They are named by the batch, and a batch run again replaces its own: ``measurement_date=.../batch_id=...``.
    """
    rows = conform(parse_probes(raw), "traffic_measurements").withColumn("measurement_date", F.to_date("measurement_time"))

    def append(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id))
            .hint("rebalance", "measurement_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("measurement_date", "batch_id")
            .parquet(out)
        )

    return (
        rows.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


ACTIVITY_KEY = ["collection_hour", "data_source", "venue_id", "event_id"]


def activity_cells(rows: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Sums per hour, source, venue and event of a stream; rows later than ``lateness`` are dropped.

    State holds one row of sums per venue and event of the hours that are open, never the
    measurements. Watermarks need a zoned time, so the session zone should be UTC.
    """
    timed = rows.withColumn("_time", F.col("measurement_time").cast("timestamp")).withWatermark("_time", lateness)
    return (
        timed.groupBy(F.window("_time", "1 hour").alias("_hour"), "data_source", "venue_id", "event_id")
        .agg(*aggregates.activity_sums())
        .select(F.col("_hour.start").cast("timestamp_ntz").alias("collection_hour"), "*")
        .drop("_hour")
    )


def stream_hourly_activity(rows: DataFrame, out: str, checkpoint: str, lateness: str = "2 hours") -> StreamingQuery:
    """Keep the activity of all hours up to date, those still open included; :func:`read_hourly_activity` gives it.

    Each batch brings the new totals of the cells it changed. They replace the old ones in the
    days they belong to, and other days are not touched. A batch run again writes the same.
    """
    spark = rows.sparkSession
    cells = activity_cells(rows, lateness)
    table = Versions(spark, out, cells.schema)

    def merge(batch: DataFrame, batch_id: int) -> None:
        day = F.date_format("collection_hour", "yyyyMMdd")
        changed = batch.withColumn("bucket", day).persist()
        # days in one batch: few, as an hour closes when the watermark passes it
        days = [r[0] for r in changed.select("bucket").distinct().collect()]
        known = table.read(batch_id - 1, days).withColumn("bucket", day)
        sums = [c for c in table.schema.names if c not in ACTIVITY_KEY]
        both = known.withColumn("_new", F.lit(False)).unionByName(changed.withColumn("_new", F.lit(True)))
        rows = both.groupBy("bucket", *ACTIVITY_KEY).agg(F.max_by(F.struct(*sums), "_new").alias("_sums"))
        if days:
            table.write(rows.select("bucket", *ACTIVITY_KEY, "_sums.*"), batch_id)
        table.commit(batch_id, days=len(days))
        table.retire(batch_id, days)
        changed.unpersist()

    return (
        cells.writeStream.outputMode("update")
        .foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_hourly_activity(spark: SparkSession, out: str, cells: StructType) -> DataFrame:
    """Activity per hour and source as of the last complete batch, with exact distinct venues and events.

    ``cells`` is the schema of :func:`activity_cells`.
    """
    return aggregates.activity_by_hour(Versions(spark, out, cells).read())


def link_batch(batch: DataFrame, events: DataFrame, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """``batch`` linked to its nearest events, of which only the days that its rows can reach are read.

    The days come from the batch's rows that lack an event, as one row of bounds; they prune
    a schedule partitioned by ``event_start_date`` and skip row groups of any other.
    """
    reach = F.make_interval(secs=F.lit(seconds))
    t = F.col("measurement_time")
    span = linking.unlinked_event_rows(batch).agg(F.to_date(F.min(t) - reach).alias("lo"), F.to_date(F.max(t) + reach).alias("hi"))
    lo, hi = span.first()
    if lo is None:
        return batch
    near = events.filter(F.col("event_start_date").between(F.lit(lo), F.lit(hi)))
    return linking.link_measurements(batch, near, seconds)


def stream_link_events(
    rows: DataFrame, events: DataFrame | Callable[[], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Link arriving rows to their nearest event, micro-batch by micro-batch.

    ``events`` given as a function is asked anew for every batch, so that later changes of
    the schedule count from the next batch on. A batch owns the folder named by its id and overwrites it, so a batch run
    again after a failure leaves no duplicates.
    """
    schedule = events if callable(events) else lambda: events

    def link(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        link_batch(held, schedule()).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        held.unpersist()

    return (
        rows.writeStream.foreachBatch(link)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _in_buckets(rows: DataFrame, many: int) -> DataFrame:
    """Rows with the bucket of their event key; parts that are NULL count as such."""
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*upserts.EVENT_KEY), F.lit(many)).cast("string"))


def stream_upsert_events(
    batches: DataFrame, initial: DataFrame, root: str, checkpoint: str, as_of: str, buckets: int = 64
) -> StreamingQuery:
    """Deduplicate and upsert arriving listings into a table of :class:`Versions`, in buckets of the key.

    Version 0 is ``initial``, written only where there is none. Batch n reads the newest versions of the
    buckets it touches and writes these anew as version n + 1; all others stay as they are. What a load did is counted and the
    largest id is taken while it is written. A repeated batch reads the same versions and overwrites its own,
    so the result does not depend on how often it ran. Versions no batch can need again are deleted.
    """
    spark: SparkSession = initial.sparkSession
    table = Versions(spark, root, initial.schema)

    def write(rows: DataFrame, version: int, touched: list[str], max_id: int) -> None:
        seen = Observation(f"load-{version}")
        counts = upserts.load_counts("_state")
        rows = rows.observe(seen, F.max("event_id").alias("max_id"), *counts).drop("_state")
        if touched:
            table.write(_in_buckets(rows, buckets), version)
        got = seen.get if touched else {}
        table.commit(version, **{k: v or 0 for k, v in got.items()} | {"max_id": max(got.get("max_id") or 0, max_id)})

    if not table.commits():
        write(initial.withColumn("_state", F.lit(upserts.KEPT)), 0, ["all"], 0)

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = _in_buckets(upserts.dedup_events(batch), buckets).persist()
        touched = [r[0] for r in rows.select("bucket").distinct().collect()]  # at most ``buckets``
        max_id = table.note(batch_id).get("max_id", 0)
        after = upserts.upsert(
            table.read(batch_id, touched), rows.drop("bucket"), upserts.EVENT_KEY, "event_id", upserts.EVENT_KEEP, as_of,
            max_id=max_id, state="_state",
        )
        write(after, batch_id + 1, touched, max_id)
        table.retire(batch_id + 1, touched)
        rows.unpersist()

    return (
        batches.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
