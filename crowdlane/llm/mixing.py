"""Mixing sources to target weights by subset-sum budget fitting.

Sizes are words. Every source gets a target; whole copies of the source are taken
while they fit, and what is left of the budget is filled by documents chosen by their
exact size: a bounded knapsack over the source's size counts says how many documents
of each size are taken, and a seeded order says which.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .scratch import store

#: budget, in words, that the knapsack is solved for exactly
EXACT = 1 << 16
#: slots of the seeded order within one source and size
SLOTS = 1024

PLAN = "src string, size bigint, number bigint"


def targets(sizes: DataFrame, weights: Sequence[float], limit: int) -> DataFrame:
    """src, source_size, target for the frame ``sizes`` (src, source_size), one row per source.

    All words are shared by weight. The weights repeat over the sources by code point,
    null last. A target stops at ``limit`` times the source's size and the excess is
    shared again by weight, until none is above. Sorted by the share at which they stop, a prefix
    of the sources is stopped; the first level that its successors can bear is the final one.
    """
    # one row per source: what these windows bring together
    by_name = Window.orderBy(F.col("src").isNull(), F.col("src"))
    by_stop = Window.orderBy("stop", "place")
    all_rows = Window.partitionBy()
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.col("place") % len(weights)).cast("int") + 1)
    rows = sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn("w", w)
    rows = rows.withColumn("cap", limit * F.col("source_size")).withColumn("stop", F.col("cap") / F.col("w"))
    rows = (
        rows.withColumn("total", F.sum("source_size").over(all_rows))
        .withColumn("weights", F.sum("w").over(all_rows))
        .withColumn("caps", F.sum("cap").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("spent", F.sum("w").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)))
    )
    level = (F.col("total") - F.coalesce("caps", F.lit(0))) / (F.col("weights") - F.coalesce("spent", F.lit(0.0)))
    rows = rows.withColumn("level", level)
    # sources are stopped up to the first that can bear its own level
    open_ = F.when(F.col("level") <= F.col("stop"), F.struct("stop", "place", "level"))
    rows = rows.withColumn("final", F.min(open_).over(all_rows)["level"])
    target = F.when(F.col("final").isNull() | (F.col("final") >= F.col("stop")), F.col("cap").cast("double"))
    return rows.select("src", "source_size", target.otherwise(F.col("final") * F.col("w")).alias("target"))


def fit(size: np.ndarray, count: np.ndarray, budget: int) -> np.ndarray:
    """How many of ``count`` documents of each ``size`` (distinct, > 0) are taken so that their sizes add up
    to the budget, or come as near to it as can be from below or above.

    Each size first gives the same share of its documents, so that the choice looks like the
    source, then the larger sizes give more while there is much left. The rest, at most
    EXACT words, is a bounded knapsack: counts are cut into powers of two, reachable sums are the bits of
    an integer, and the sums after each step lead back to the numbers taken.
    """
    take = np.zeros(len(size), np.int64)
    total = int((size * count).sum())
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return count.astype(np.int64)
    keep = min(EXACT, budget)  # left to the knapsack
    take = (count.astype(object) * (budget - keep) // total).astype(np.int64)
    left = budget - int((size * take).sum())
    for i in np.argsort(-size, kind="stable").tolist():
        if left <= EXACT:
            break
        more = min(int(count[i] - take[i]), (left - EXACT // 2) // int(size[i]))
        if more > 0:
            take[i] += more
            left -= more * int(size[i])
    bound = min(left, EXACT)
    top = 2 * bound  # beyond it, taking nothing more is as near
    mask, reach, steps = (1 << (top + 1)) - 1, 1, []
    for i in np.argsort(size, kind="stable").tolist():
        have, power = min(int(count[i] - take[i]), top // int(size[i])), 1
        while have > 0:
            n = min(power, have)
            new = (reach | reach << (n * int(size[i]))) & mask
            if new != reach:
                steps.append((i, n, reach))
            reach, have, power = new, have - n, power * 2
        if reach >> bound & 1:
            break
    below = (reach & ((1 << (bound + 1)) - 1)).bit_length() - 1
    above = reach >> bound
    above = bound + (above & -above).bit_length() - 1 if above else top + 1
    at = below if bound - below <= above - bound else above
    for i, n, before in reversed(steps):
        if not before >> at & 1:
            take[i] += n
            at -= n * int(size[i])
    return take


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), limit: int = 3, seed: int = 0
) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, copies of every row of ``docs`` (doc_id, text, source).

    ``size`` is the number of words; null and blank texts have 0 and are taken 0 words.
    ``copies`` (0 to ``limit``) says how often the mix takes the row, ``taken`` is copies * size.
    Null is a source of its own, the last. A source whose documents are all empty has target 0.
    Rows with the same doc_id and size, also repeated rows, are interchangeable: as many of them
    are taken as the plan says. The result depends on the rows, the weights and the seed
    alone, not on partitions. Other columns are ignored; an empty table gives no rows.
    """
    size = F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")
    rows = docs.select("doc_id", F.col("source").alias("src"), size.alias("size"))
    # identical rows get different places by nothing, different ones by this hash
    slot = F.xxhash64(F.lit(seed), "doc_id", "src", "size")
    rows = store(rows.withColumn("h", slot), "sizes").withColumn("slot", F.pmod("h", F.lit(SLOTS)).cast("int"))
    per_slot = rows.groupBy("src", "size", "slot").count()
    per_size = per_slot.groupBy("src", "size").agg(F.sum("count").alias("count"))
    sources = targets(
        per_size.groupBy("src").agg(F.sum(F.col("size") * F.col("count")).alias("source_size")), weights, limit
    )
    sources = store(
        sources.withColumn("whole", F.expr("if(source_size = 0, 0, cast(floor(target / source_size) as bigint))")), "targets"
    ).withColumn("rest", F.expr("cast(round(target) as bigint) - whole * source_size"))

    def plan(table: pa.Table) -> pa.Table:
        size, count = table["size"].to_numpy(), table["count"].to_numpy()
        number = fit(size, count, int(table["rest"][0].as_py()))
        return pa.table({"src": table["src"], "size": size, "number": number})

    # one row per size that a source has: bounded by the longest text, not by the documents
    wanted = (
        per_size.where("size > 0")
        .join(sources.where("rest > 0").selectExpr("src as s", "rest"), F.col("src").eqNullSafe(F.col("s")))
        .select("src", "size", "count", "rest")
        .groupBy("src")
        .applyInArrow(plan, PLAN)
        .where("number > 0")
    )
    # the documents of a size are ordered by slot, then by hash; only the slot in which the number
    # runs out is ranked
    order = Window.partitionBy("src", "size").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("count").over(order), F.lit(0))
    cut = (
        per_slot.where("size > 0")
        .withColumn("before", before)
        .join(wanted.selectExpr("src as s", "size as z", "number"), F.expr("src <=> s and size = z"))
        .select("src", "size", "slot", F.expr("number - before").alias("open"), "count")
        .where("open > 0")
    )
    cut = store(cut, "cut")
    key = F.expr("src <=> s and size = z and slot = o")
    marked = rows.join(
        cut.selectExpr("src as s", "~~size as z", "slot as o", "open", "count"), key, "left"
    ).select("doc_id", "src", "size", "slot", "h", "open", "count")
    whole = marked.selectExpr("doc_id", "src", "size", "if(open >= count, 1, 0) as extra").where("extra = 1 ")
    rest = marked.where("open is null").selectExpr("doc_id", "src", "size", "0 as extra")
    rank = F.row_number().over(Window.partitionBy("src", "size", "slot").orderBy("h", "doc_id"))
    part = marked.where("open < count").withColumn("rank", rank).selectExpr(
        "doc_id", "src", "size", "if(rank <= open, 1, 0) as extra"
    )
    chosen = whole.union(rest).union(part)
    return chosen.join(sources.withColumnRenamed("src", "s"), F.expr("src <=> s")).selectExpr(
        "doc_id",
        "size",
        "source_size",
        "target",
        "size * (whole + extra) as taken",
        "src as source",
        "if(size = 0, 0, whole + extra) as copies",
    )
