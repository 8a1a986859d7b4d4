"""First half against second half of an event's measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from crowdlane.functions import clock, levels
from crowdlane.functions.clock import MICROS
from crowdlane.operators.linking import event_points, start_points, window_pairs
from crowdlane.operators.skew import splittable
from crowdlane.session import stored

KEY = ["venue_id", "start_us"]
SUMS = ["n", "sum_delay", "n_delay", "max_delay", "sum_speed", "n_speed"]
#: ids that agree in all but their last bits are ranked together
BLOCK_BITS = 16


def _sums() -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.sum("delay_minutes").alias("sum_delay"),
        F.count("delay_minutes").alias("n_delay"),
        F.max("delay_minutes").alias("max_delay"),
        F.sum("avg_speed_mph").alias("sum_speed"),
        F.count("avg_speed_mph").alias("n_speed"),
    ]


def _added(of: Column | None = None, prefix: str = "", columns: str = "") -> list[Column]:
    """Sums of sums, of the rows for which ``of`` holds, as ``prefix`` and their names."""
    pick = lambda c: F.col(columns + c) if of is None else F.when(of, F.col(columns + c))
    return [(F.max if c == "max_delay" else F.sum)(pick(c)).alias(prefix + c) for c in SUMS]


def _cell() -> Column:
    """Microsecond that stands for a measurement's cell: its second, and whether it is later than the second's beginning.

    Cells keep the order of time, and as starts are whole seconds, a window's bounds never cut one.
    """
    second = F.floor(F.col("t_us") / MICROS) * MICROS
    return second + F.when(F.col("t_us") > second, 1).otherwise(0)


def _facts(meas: DataFrame) -> DataFrame:
    return (
        meas.filter(F.col("venue_id").isNotNull() & F.col("measurement_time").isNotNull())
        .select("venue_id", "measurement_id", "delay_minutes", "avg_speed_mph", clock.micros("measurement_time").alias("t_us"))
        .withColumn("cell", _cell())
    )


def halves_by_cells(starts: DataFrame, meas: DataFrame) -> DataFrame:
    """Per start: sums b_* of its cells that lie in the first half, a_* of those in the second, and what is left open.

    Facts are added up per venue and cell, and these cells, at most 28,802 in a
    four-hour window, meet the starts in the one interval join. Their running count gives the
    cut, after n // 2 rows. ``cut`` is the cell it falls into and ``left`` how many of
    that cell's first rows belong to the first half; both are NULL where the cut lies between cells.
    """
    cells = _facts(meas).groupBy("venue_id", "cell").agg(*_sums())
    pairs = window_pairs(starts, cells, SUMS, instant=F.col("cell"))
    in_order = Window.partitionBy(*KEY).orderBy("t_us")
    placed = pairs.withColumns(
        {
            "_upto": F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_half_rows": F.floor(F.sum("n").over(Window.partitionBy(*KEY)) / 2),
        }
    )
    before = F.col("_upto") <= F.col("_half_rows")
    after = F.col("_upto") - F.col("n") >= F.col("_half_rows")
    cut = F.struct(F.col("t_us").alias("cut"), (F.col("_half_rows") - (F.col("_upto") - F.col("n"))).alias("left"))
    return (
        placed.groupBy(*KEY)
        .agg(*_added(before, "b_"), *_added(after, "a_"), F.max(F.when(~before & ~after, cut)).alias("_cut"))
        .select("*", "_cut.*")
        .drop("_cut")
    )


def halves_of_cut_cells(cuts: DataFrame, meas: DataFrame) -> DataFrame:
    """Sums of the first ``left`` rows (c_b_*) and of the others (c_a_*) of each (venue_id, cut, left) of ``cuts``.

    Rows are ordered by (t_us, measurement_id). Only the rows of cut cells are read, by an equi join.
    A crowded cell is not sorted as one group: rows are counted per instant and block of ids, ranked inside these, and
    added up between one ``left`` and the next, so that many cuts of one cell do not multiply its rows.
    """
    wanted = cuts.groupBy("venue_id", F.col("cut").alias("cell")).agg(F.sort_array(F.collect_set("left")).alias("lefts"))
    at = ["venue_id", "cell", "t_us", "block"]
    rows = (
        _facts(meas)
        .join(splittable(wanted.select("venue_id", "cell"), "venue_id", "cell"), ["venue_id", "cell"])
        .withColumn("block", F.shiftright("measurement_id", BLOCK_BITS))
    )
    earlier = Window.partitionBy("venue_id", "cell").orderBy("t_us", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*at).count().withColumn("_offset", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy(*at).orderBy("measurement_id")) + F.col("_offset")
    ranked = (
        rows.join(splittable(offsets.drop("count"), "venue_id", "cell", "t_us"), at)
        .withColumn("rank", rank)
        .join(splittable(wanted, "venue_id", "cell"), ["venue_id", "cell"])
    )
    # the place of the first left that takes the row into the first half
    place = F.size(F.filter("lefts", lambda x: x < F.col("rank")))
    parts = ranked.withColumn("place", place).groupBy("venue_id", "cell", "place").agg(*_sums(), F.max("lefts").alias("lefts"))
    order = Window.partitionBy("venue_id", "cell").orderBy("place")
    first = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = order.rowsBetween(1, Window.unboundedFollowing)
    add = lambda c: F.max(c) if c == "max_delay" else F.sum(c)
    return parts.select(
        "venue_id",
        F.col("cell").alias("cut"),
        F.get("lefts", "place").alias("left"),
        *(add(c).over(first).alias(f"c_b_{c}") for c in SUMS),
        *(add(c).over(rest).alias(f"c_a_{c}") for c in SUMS),
    ).filter("left IS NOT NULL")


def split_in_halves(starts: DataFrame, meas: DataFrame) -> DataFrame:
    """Sums of the first n // 2 measurements (b_*) around each start and of the rest (a_*).

    The halves by cells are a written table, one row per start, because their cuts
    choose which facts are read again: so the interval join runs once.
    """
    known = stored(halves_by_cells(starts, meas), "halves")
    open_ = halves_of_cut_cells(known.filter("left IS NOT NULL").select("venue_id", "cut", "left"), meas)
    joined = known.join(splittable(open_, "venue_id", "cut", "left"), ["venue_id", "cut", "left"], "left")

    def both(c: str) -> Column:
        if c.endswith("max_delay"):
            return F.greatest(c, f"c_{c}")
        return F.when(F.col(c).isNotNull() | F.col(f"c_{c}").isNotNull(), F.coalesce(c, F.lit(0)) + F.coalesce(f"c_{c}", F.lit(0)))

    return joined.select(*KEY, *(both(h + c).alias(h + c) for h in ("b_", "a_") for c in SUMS))


def impact_before_during(events: DataFrame, venues: DataFrame, meas: DataFrame) -> DataFrame:
    """Delay and speed of the two halves per event with traffic, their change and its level.

    With an odd count the extra row belongs to the second half. A percentage over
    a zero speed is NULL.
    """
    halves = split_in_halves(start_points(events), meas)
    per_start = halves.select(
        *KEY,
        (F.coalesce("b_n", F.lit(0)) + F.coalesce("a_n", F.lit(0))).alias("total_measurements"),
        *[
            e
            for half, name in (("b_", "before"), ("a_", "during"))
            for e in (
                F.coalesce(f"{half}n", F.lit(0)).alias(f"{name}_count"),
                F.try_divide(F.col(f"{half}sum_delay").cast("double"), f"{half}n_delay").alias(f"{name}_avg_delay"),
                F.col(f"{half}max_delay").alias(f"{name}_max_delay"),
                F.try_divide(F.col(f"{half}sum_speed").cast("double"), f"{half}n_speed").alias(f"{name}_avg_speed"),
            )
        ],
    )
    gain = F.col("during_avg_delay") - F.col("before_avg_delay")
    drop = F.col("before_avg_speed") - F.col("during_avg_speed")
    analysed = per_start.withColumns(
        {
            "delay_increase": gain,
            "delay_increase_pct": gain / (F.abs("before_avg_delay") + 1) * 100,
            "speed_decrease": drop,
            "speed_decrease_pct": F.try_divide(drop, F.col("before_avg_speed")) * 100,
            "impact_level": levels.impact_level(gain, "halves"),
        }
    )
    sited = analysed.join(venues.select("venue_id", "venue_name"), "venue_id", "left")
    return (
        event_points(events, "event_id", "event_name", "category").join(splittable(sited, *KEY), KEY).drop(*KEY)
    )
