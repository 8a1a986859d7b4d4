"""Exact Jaccard join of documents on the sets of their word n-grams.

Texts with equal sets are one class from the start. Classes that could link are
found by pigeonhole: two sets that link differ in at most D values, so if the range
of hashes is cut into D + 1 + E parts, at least E + 1 parts are equal in both. Parts without
values say nothing, so a set with at most E of them leaves these out: one of the
equal parts is still there. D follows from the
size, so parts are made per size band, and a set also enters the next band if a set
there could link with it. Classes that share as many parts as a link asks for are candidates;
those that share parts form groups, and :mod:`.tiles` compares these in
size-banded tiles by bitmaps and then exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import words as wd
from .components import components
from .scratch import store
from .sieve import Sieve
from .tiles import Jaccard, verified_links


def size_bands(num: int, den: int, most: int) -> np.ndarray:
    """Lower bounds of size bands up to ``most``; sizes that link are in one band or in neighbours."""
    low = [1]
    while low[-1] <= most:
        low.append(max(low[-1] + 1, low[-1] * den // num + 1))
    return np.array(low, np.int64)


def part_keys(sets: np.ndarray, begin: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The part hashes of each set in its own band and, where it matters, the next; their marks; where each set's begin.

    A mark is 2 n, and 1 more in the next band: n keys of that band at least are equal in any set that links.
    """
    n = np.diff(begin)
    low = size_bands(num, den, int(n.max(initial=1)) * den // num + 1)
    own = np.searchsorted(low, n, "right") - 1
    reach = np.searchsorted(low, n * den // num, "right") - 1
    units = np.flatnonzero(n > 0)
    units = np.concatenate([units, units[reach[units] > own[units]]])
    band = np.concatenate([own[: 0], own[units]])
    band[np.count_nonzero(n > 0) :] += 1
    # the larger of two that link is below the band's end: bounds the sum of sizes, and so the difference
    differ = (den - num) * 2 * (low[band + 1] - 1) // (den + num)
    spare = np.minimum(differ, 2) + differ // 6
    parts = differ + 1 + spare
    base = np.concatenate([[0], np.cumsum(parts)])
    length = n[units]
    row = np.repeat(np.arange(len(units)), length)
    at = np.concatenate([[0], np.cumsum(length)])
    h = sets[begin[:-1][units][row] + np.arange(at[-1]) - at[:-1][row]]
    # hashes ascend within a set, so a part is a stretch of it
    part = ((h >> np.uint64(32)) * parts[row].astype(np.uint64)) >> np.uint64(32)
    slot = base[:-1][row] + part.astype(np.int64)
    edge = np.flatnonzero(np.diff(slot, prepend=-1))
    keys = np.zeros(base[-1], np.uint64)
    if len(edge):
        keys[slot[edge]] = np.add.reduceat(wd.mix(h), edge)
    owner = np.repeat(np.arange(len(units)), parts)
    place = np.arange(base[-1]) - base[:-1][owner]
    filled = np.zeros(base[-1], bool)
    filled[slot] = True
    empty = parts - np.bincount(owner, weights=filled, minlength=len(units)).astype(np.int64)
    keep = filled | (empty > spare)[owner]
    # of E + 1 equal parts or more, no more are empty than either set has empty ones
    need = np.where(empty > spare, 1, spare + 1 - empty)
    marks = 2 * need + (np.arange(len(units)) >= np.count_nonzero(n > 0))
    keys, owner, place = keys[keep], owner[keep], place[keep]
    keys = wd.mix(keys + wd.mix((band[owner] * (1 << 32) + place).astype(np.uint64)))
    # bring the keys of a set together again
    order = np.argsort(units[owner], kind="stable")
    counts = np.bincount(units[owner], minlength=len(n))
    return keys[order], marks[owner][order], np.concatenate([[0], np.cumsum(counts)])


def shingle_sets(part: wd.Slice, k: int) -> tuple[np.ndarray, np.ndarray]:
    w = wd.words(part.data, part.offs)
    return wd.distinct(*wd.shingles(w.hash, w.first, k))


def set_hash(sets: np.ndarray, begin: np.ndarray) -> pa.Array:
    return pa.array(wd.mix(wd.sums(wd.mix(sets), begin) + np.diff(begin).astype(np.uint64)).view(np.int64))


def signatures(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, n_shingles, set_hash, keys, marks of every text; keys once per task and set, of rows that have a doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in wd.slices(batches):
            sets, begin = shingle_sets(part, k)
            n, hashes = np.diff(begin), set_hash(sets, begin)
            valid = part.batch.column(0).is_valid().to_pylist()
            # a group of copies adds its keys once per task, before they are shuffled
            first = [ok and not (h in seen or seen.add(h)) for h, ok in zip(hashes.to_pylist(), valid, strict=True)]
            own = np.where(first, n, 0)
            at = np.repeat(first, n)
            keys, marks, edges = part_keys(sets[at], np.concatenate([[0], np.cumsum(own)]), num, den)
            yield pa.RecordBatch.from_arrays(
                [
                    part.batch.column(0),
                    pa.array(n),
                    hashes,
                    wd.lists(keys, edges),
                    pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(marks.astype(np.int32))),
                ],
                names=["doc_id", "n_shingles", "set_hash", "keys", "marks"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, set_hash bigint, keys array<bigint>, marks array<int>"
    )


def candidate_groups(keyed: DataFrame) -> DataFrame:
    """(node, grp): nodes of frame (node, key) that share keys, directly or over others."""
    least = keyed.selectExpr("node", "min(node) over (partition by key) as least")
    links = least.where("node > least").distinct()
    return components(links, "node", "least").withColumnRenamed("component", "grp")


def shared_keys(keyed: DataFrame) -> DataFrame:
    """node, least of frame (node, key, mark): nodes that may be of a link, with the least node of each of their keys.

    A key of one node links nothing, and neither does a node that shares fewer keys of a band
    with others than its mark asks for; both go.
    """
    by_key = Window.partitionBy("key")

    def of_several(rows: DataFrame) -> DataFrame:
        ends = rows.select("node", "key", "mark", F.min("node").over(by_key).alias("least"), F.max("node").over(by_key).alias("most"))
        return ends.where("least < most")

    shared = store(of_several(keyed).select("node", "key", "mark").distinct(), "shared")
    enough = shared.groupBy("node", "mark").agg(F.count("*").alias("n")).where("n >= mark div 2")
    kept = shared.join(enough.selectExpr("~~node as node", "mark"), ["node", "mark"])
    return of_several(kept).select("node", "least").distinct()


def payloads(docs: DataFrame, k: int, wanted: Sieve) -> DataFrame:
    """doc_id, node, payload: the hash of the set and its sorted shingle hashes, of texts that pass the sieve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wd.slices(wanted.pass_on(batches)):
            sets, begin = shingle_sets(part, k)
            yield pa.RecordBatch.from_arrays(
                [part.batch.column(0), set_hash(sets, begin), wd.binaries(sets, begin)], names=["doc_id", "node", "payload"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, node bigint, payload binary")


def ngram_components(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text).

    Two texts link when den * |A and B| >= num * |A or B| for their sets of distinct
    k-word shingles (num over den at least one half). component_id is the least doc_id
    that links reach. A text without words (null, empty, blank) has an empty set and is
    linked with nothing; with fewer than k words its whole sequence is its one shingle.
    Equal texts link. A doc_id that repeats is one document for linking: its rows
    come back each, and their classes are joined. Rows with a null doc_id come back
    with a null component_id and link with nothing. Other columns are ignored.
    """
    sig = store(signatures(docs, k, num, den), "signatures")
    full = sig.where("n_shingles > 0 and doc_id is not null")
    keyed = store(shared_keys(full.select(F.col("set_hash").alias("node"), F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("marks").alias("mark"))))), "keyed")
    groups = components(keyed.where("node > least"), "node", "least").withColumnRenamed("component", "grp")
    # one document stands for each class of equal sets
    first = full.groupBy("set_hash").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").cast("int").alias("n"))
    reps = groups.join(first.selectExpr("~~set_hash as node", "rep as doc_id", "n"), "node")
    reps = store(reps, "candidates")
    texts = payloads(docs, k, Sieve(reps, "doc_id"))
    links = verified_links(
        reps, texts, ["doc_id", "node"], den / num, lambda size, sets: Jaccard(size, sets, num, den)
    )
    # rows of one doc_id with different texts tie their classes together
    tied = full.groupBy("doc_id").agg(F.min("set_hash").alias("a"), F.max("set_hash").alias("b")).where("a < b")
    tied = full.join(tied, "doc_id").select("a", F.col("set_hash").alias("b"))
    classes = components(links.union(tied), "a", "b")
    named = classes.join(first.selectExpr("~~set_hash as node", "rep"), "node")
    ids = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = store(named.join(ids.selectExpr("~~component as component", "component_id"), "component").select("node", "component_id"), "classes")
    own = first.join(named, first.set_hash == named.node, "left").selectExpr(
        "~~set_hash as set_hash", "coalesce(component_id, rep) as component_id"
    )
    rows = sig.select("doc_id", "n_shingles", "set_hash")
    linked = rows.withColumn("set_hash", F.expr("if(n_shingles > 0 and doc_id is not null, set_hash, null)"))
    empty = linked.where("set_hash is null").selectExpr("doc_id", "n_shingles", "doc_id as component_id")
    return (
        linked.where("set_hash is not null").join(own, "set_hash").select("doc_id", "n_shingles", "component_id").union(empty)
    )
