"""Trie of the prefixes that conversations share.

Identical conversations are one weighted sequence with a list of ends. Sequences that are
proper prefixes of others fall out by an anti-join; the rest are leaves. Each node of the trie
is a distinct prefix, found by adding up the prefixes of the weighted sequences. A prefix is
known by its depth and two hashes: every turn's hash is mixed with its place, and those of a prefix are
combined by exclusive or, so they are running values that need no long strings (128 bits: two
prefixes of a million million meet with a chance of about 1 in 10**15).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from crowdlane.operators.skew import splittable

from .scratch import forget, store

NODE = ["depth", "p1", "p2"]
#: a conversation's turns are ordered and added up in cells of so many turn numbers or places
CELL = 1024
#: ids in one piece of a list of ends
PIECE = 1 << 16
NULL_CELL = -(1 << 62)


def _offsets(rows: DataFrame, **running: str) -> DataFrame:
    """conv_id, cell and, as b_<name>, each running value up to the end of the conversation's earlier cells, which are few.

    A running value is given as an aggregate, such as ``sum(bytes)``, that also adds up its own results.
    """
    cells = rows.groupBy("conv_id", "cell").agg(*(F.expr(f).alias(n) for n, f in running.items()))
    before = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    again = {n: f"{f.split('(')[0].replace('count', 'sum')}({n})" for n, f in running.items()}
    return cells.select("conv_id", "cell", *(F.coalesce(F.expr(f).over(before), F.lit(0)).alias(f"b_{n}") for n, f in again.items()))


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), a, b (hashes of role and text), bytes (of the text in UTF-8).

    Turns are in order of their number, null first; at ties of role, then of the text's hash. A null role or text is
    empty; rows with null conv_id belong to no conversation and are left out. No conversation is sorted whole: its
    turns are placed within cells of CELL turn numbers.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn"),
        F.coalesce(F.floor(F.col("turn") / CELL), F.lit(NULL_CELL)).alias("cell"),
        role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), text, role).alias("b"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    before = _offsets(rows, n="count(1)")
    here = Window.partitionBy("conv_id", "cell").orderBy(F.asc_nulls_first("turn"), "role", "a", "b")
    placed = rows.withColumn("row", F.row_number().over(here))
    return placed.join(splittable(before, "conv_id"), ["conv_id", "cell"]).select(
        "conv_id", (F.col("row") + F.col("b_n")).alias("place"), "a", "b", "bytes"
    )


def _prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, p1, p2 of every prefix, q1, q2 of the one before, bytes of its last text and of all (cum)."""
    rows = turns.select(
        "conv_id",
        F.col("place").alias("depth"),
        F.expr(f"(place - 1) div {CELL}").alias("cell"),
        F.xxhash64("place", "a").alias("x1"),
        F.xxhash64("b", "place").alias("x2"),
        "bytes",
    )
    running = {"x1": "bit_xor(x1)", "x2": "bit_xor(x2)", "bytes": "sum(bytes)"}
    before = _offsets(rows, **running)
    here = Window.partitionBy("conv_id", "cell").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.select("*", *(F.expr(f).over(here).alias(f"r_{n}") for n, f in running.items()))
    run = run.join(splittable(before, "conv_id"), ["conv_id", "cell"])
    return run.selectExpr(
        "conv_id",
        "depth",
        "r_x1 ^ b_x1 as p1",
        "r_x2 ^ b_x2 as p2",
        "r_x1 ^ b_x1 ^ x1 as q1",
        "r_x2 ^ b_x2 ^ x2 as q2",
        "bytes",
        "r_bytes + b_bytes as cum",
    )


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the trie of ``conversations`` (conv_id, distinct) by ``turns`` (conv_id, place from 1, a, b, bytes).

    ``nodes`` has one row per distinct prefix, the empty one included: depth, p1, p2; conv_id, the
    smallest conversation that begins with it; parent_conv_id, that of the prefix without its last turn;
    n_convs; n_children; n_leaves, the sequences in its subtree that no other continues; saved_tokens, over its
    subtree (n_convs - 1) times the bytes of the last text. ``ends`` (conv_id, depth, p1, p2) has the
    node each conversation ends in; a conversation without turns ends in the root. Without conversations there is no node.
    """
    steps = store(_prefixes(turns), "prefixes")
    zero = [F.lit(0).cast("bigint").alias(c) for c in NODE]
    last = steps.groupBy("conv_id").agg(F.max(F.struct("depth", "p1", "p2", "cum")).alias("end"))
    ends = (
        conversations.select("conv_id")
        .join(last, "conv_id", "left")
        .selectExpr("conv_id", *(f"coalesce(end.{c}, 0L) as {c}" for c in [*NODE, "cum"]))
    )
    ends = store(ends, "ends")
    # identical conversations collapse
    sequences = ends.groupBy(*NODE).agg(
        F.count("*").alias("weight"), F.min("conv_id").alias("seq"), F.max("cum").alias("total")
    )
    sequences = store(sequences.withColumnRenamed("depth", "n"), "sequences")
    own = steps.join(splittable(sequences.select("seq", "n", "weight", "total"), "seq"), F.col("conv_id") == F.col("seq"))
    root = sequences.select("seq", *zero, *(F.lit(0).cast("bigint").alias(c) for c in ("q1", "q2", "bytes", "cum")), "n", "weight", "total")
    rows = store(own.select(root.columns).union(root), "rows")
    # leaves: sequences that are no proper prefix
    proper = rows.where("depth < n").select(*NODE).distinct()
    leaves = sequences.join(
        proper.withColumnsRenamed({"depth": "n"}), ["n", "p1", "p2"], "left_anti"
    ).select(F.col("seq").alias("s"), F.lit(1).alias("leaf"))
    # a node belongs to its smallest sequence; what a sequence owns begins at some depth and goes on to its end
    first = rows.groupBy(*NODE).agg(F.min("seq").alias("owner"))
    begins = (
        rows.where("depth > 0")
        .join(splittable(first.where("depth > 0"), "p1", "p2"), NODE)
        .where("owner = seq")
        .groupBy("seq")
        .agg(F.min(F.struct("depth", F.expr("cum - bytes").alias("before"))).alias("own"))
    )
    known = sequences.select("seq").join(begins, "seq", "left").join(leaves, F.col("seq") == F.col("s"), "left")
    known = known.selectExpr("seq as s", "own", "coalesce(leaf, 0) as leaf")
    behind = "total - cum + bytes"  # bytes of the prefix's last turn and all behind it
    weighed = rows.join(splittable(known, "s"), F.col("seq") == F.col("s")).selectExpr(
        *NODE, "q1", "q2", "seq", "weight", "leaf",
        f"weight * ({behind}) - if(own is null, 0L, if(depth >= own.depth, {behind}, total - own.before)) as saved",
    )
    nodes = weighed.groupBy(*NODE).agg(
        F.min("seq").alias("conv_id"),
        F.max("q1").alias("q1"),
        F.max("q2").alias("q2"),
        F.sum("weight").alias("n_convs"),
        F.sum("leaf").cast("bigint").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
    )
    nodes = store(nodes, "nodes")
    for part in (steps, rows, sequences):
        forget(part)
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    parents = nodes.selectExpr("depth + 1 as d", "p1 as o1", "p2 as o2", "conv_id as parent_conv_id")
    counted = nodes.join(children.agg(F.count("*").alias("n_children")), NODE, "left")
    return (
        counted.join(splittable(parents, "o1", "o2"), F.expr("d = depth and o1 = q1 and o2 = q2"), "left").selectExpr(
            *NODE,
            "conv_id",
            "if(depth = 0, null, parent_conv_id) as parent_conv_id",
            "n_convs",
            "coalesce(n_children, 0L) as n_children",
            "n_leaves",
            "saved_tokens",
        ),
        ends.drop("cum"),
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, p1, p2, ends_sha256 of each node that conversations end in: of their ids, ascending, joined by commas.

    Ids are joined in pieces of PIECE neighbouring numbers, and a node's pieces pass through the digest one after
    the other, so no list of ids is held whole.
    """
    pieces = ends.groupBy(*NODE, F.expr(f"floor(conv_id / {PIECE})").alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()
        for batch in batches:
            done = []
            ids = batch.column(4).to_pylist()
            for node, text in zip(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True), ids, strict=True):
                if node == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = node, hashlib.sha256()
                digest.update(text.encode())
            if done:
                yield _batch(done)
        if key is not None:
            yield _batch([(*key, digest.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[*NODE, "ends_sha256"]
        )

    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece").mapInArrow(
        run, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string"
    )


#: SHA-256 of nothing
NO_ENDS = hashlib.sha256().hexdigest()


ORACLE = r"""
WITH ids AS (
    SELECT DISTINCT CAST(conv_id AS BIGINT) AS c FROM conversations WHERE conv_id IS NOT NULL
), h AS (
    -- crc32 by bits: each byte is added, then shifted out in eight steps
    SELECT c, c - c % 5 AS base, xor(list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
            lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, (acc & 1) * 3988292384) END), 4294967295) % 9 AS h
    FROM ids
), t AS (
    SELECT CAST(conv_id AS BIGINT) AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), r AS (
    SELECT h.c, role, text, place FROM h JOIN t ON t.c = h.base AND place <= h
    UNION ALL SELECT h.c, role, text, 100 + place FROM h JOIN t ON t.c = h.c AND place > h
), p AS (
    SELECT c, text, row_number() OVER w AS depth, string_agg(sha256(sha256(role) || sha256(text)), ' ') OVER w AS k
    FROM r WINDOW w AS (PARTITION BY c ORDER BY place ROWS UNBOUNDED PRECEDING)
), m AS (
    SELECT c, 0::BIGINT AS depth, '' AS k, '' AS up, '' AS text FROM ids
    UNION ALL SELECT c, depth, k, CASE WHEN depth = 1 THEN '' ELSE left(k, length(k) - 65) END, text FROM p
), nodes AS (
    SELECT k, any_value(up) AS up, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * any_value(octet_length(encode(text))) AS saved
    FROM m GROUP BY k
), kids AS (
    SELECT up AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up
), below AS (
    SELECT k, sum(saved) AS saved_tokens, count(*) FILTER (n IS NULL) AS n_leaves FROM (
        SELECT DISTINCT a.k, b.k AS b, saved, n
        FROM m a JOIN m b ON a.c = b.c AND a.depth <= b.depth JOIN nodes ON nodes.k = b.k LEFT JOIN kids ON kids.k = b.k
    ) GROUP BY k
), ends AS (
    SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS s
    FROM (SELECT c, arg_max(k, depth) AS k FROM m GROUP BY c) GROUP BY k
)
SELECT nodes.conv_id, CAST(nodes.depth AS BIGINT) AS depth, CASE WHEN nodes.depth > 0 THEN parent.conv_id END AS parent_conv_id,
       CAST(nodes.n_convs AS BIGINT) AS n_convs, CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(s, sha256('')) AS ends_sha256
FROM nodes JOIN below USING (k) LEFT JOIN kids USING (k) LEFT JOIN ends USING (k)
LEFT JOIN nodes parent ON parent.k = nodes.up
"""
