"""Connected components of a graph that is given as a frame of edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .scratch import forget, store

#: edges that one task contracts
EDGES = 1 << 18


def _same(c: str) -> Column:
    """The value behind an expression: its old partitioning is not recognised, so that
    adaptive execution may split the crowded keys on the other side of the join."""
    return F.bitwise_not(F.bitwise_not(c))


def _least(edges: DataFrame) -> DataFrame:
    """The least neighbour of each node u, or itself, by edges (u, v)."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select(_same("u").alias("u"), F.least("u", "m").alias("m"))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of every node of the edges that is not the least itself."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    up = np.arange(len(nodes))
    x, y = at[: len(a)], at[len(a) :]
    while True:
        # each root takes the least root that an edge leads to, then paths are halved until they end
        before = up
        up = up.copy()
        rx, ry = before[x], before[y]
        low = np.minimum(rx, ry)
        np.minimum.at(up, rx, low)
        np.minimum.at(up, ry, low)
        while True:
            further = up[up]
            if (further == up).all():
                break
            up = further
        if (up == before).all():
            break
    child = np.flatnonzero(up != np.arange(len(nodes)))
    return nodes[child], nodes[up[child]]


def _contracted(edges: DataFrame, count: int) -> DataFrame:
    """Edges (u, v) of the same components: every task makes stars of its share of EDGES edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches]
        if got:
            u, v = stars(*(np.concatenate(c) for c in zip(*got, strict=True)))
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return edges.repartition(-(-count // EDGES)).mapInArrow(run, "u bigint, v bigint")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node of an edge; a component is named by its least node.

    First tasks contract shares of EDGES edges each, as long as this halves their number; what fits
    one share is done then. Otherwise large-star and small-star contraction: every round links each node's neighbours
    to the least one, first the larger neighbours, then the others, until the edges
    are stars and change no more (a logarithmic number of rounds). Only edges move,
    each round is a table in the shared folder, and only a count and a checksum come
    to the driver. Edges with a null end and loops are left out.
    """
    now = store(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    count = now.count()
    while count:
        new = store(_contracted(now, count), "edges")
        forget(now)
        shares, before, now = -(-count // EDGES), count, new
        if shares == 1:
            return _named(now)
        count = now.count()
        if count > before // 2:
            break
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    last = now.agg(mark).first()[0]
    while last[0]:
        both = now.union(now.select("v", "u"))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = _least(large)
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = store(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        mark_new = new.agg(mark).first()[0]
        forget(now)
        now = new
        if mark_new == last:
            break
        last = mark_new
    return _named(now)


def _named(now: DataFrame) -> DataFrame:
    # edges are stars now: every node points to the least one
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct()
    )
