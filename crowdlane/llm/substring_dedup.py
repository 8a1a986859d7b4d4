"""Repeated paragraphs and passages: MinHash banding, exact Jaccard, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import words as wd
from .components import components
from .ngram_join import candidate_groups
from .scratch import store
from .sieve import Sieve
from .tiles import Jaccard, verified_links

#: a pair with Jaccard 0.8 shares one of BANDS bands of ROWS with a chance of 0.9992, one with 0.9 surely to 1e-5
BANDS, ROWS = 10, 3
K, NUM, DEN = 5, 80, 100
#: a word starts a block if its hash is the least of REACH words on either side
REACH = 6
PARAGRAPH, BLOCK = 0, 1


def minhash_bands(sets: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A key per band of each set (unit x BANDS); sets are not empty."""
    keys = np.zeros((len(begin) - 1, BANDS), np.uint64)
    for band in range(BANDS):
        for row in range(ROWS):
            salt = np.uint64((band * ROWS + row + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            least = np.minimum.reduceat((sets ^ salt) * np.uint64(0xFF51AFD7ED558CCD) + (sets >> np.uint64(29)) * salt, begin[:-1])
            keys[:, band] = keys[:, band] * np.uint64(0xC4CEB9FE1A85EC53) + least
        keys[:, band] = wd.mix(keys[:, band] + np.uint64(band))
    return keys


def block_starts(w: wd.Words) -> np.ndarray:
    """Words whose hash is least among REACH on either side within the text: they depend on these words only."""
    g, n = wd.mix(w.hash + np.uint64(17)), len(w.hash)
    least = np.ones(n, bool)
    for d in range(1, min(REACH, n - 1) + 1):
        near = w.text[d:] == w.text[:-d]
        least[d:] &= ~near | (g[d:] < g[:-d])
        least[:-d] &= ~near | (g[:-d] <= g[d:])
    # the edges of a text are not known to be least
    at = np.arange(n)
    inside = (at - w.first[w.text] >= REACH) & (w.first[w.text + 1] - at > REACH)
    return np.flatnonzero(least & inside)


def paragraphs(part: wd.Slice, least: int):
    """Lines of at least ``least`` words: words, index of each line's first word, text of the line, chosen lines."""
    begin, text, _ = wd.lines(part.data, part.offs)
    w = wd.words(part.data, begin)
    chosen = np.flatnonzero(np.diff(w.first) >= least)
    size = np.diff(w.first)[chosen]
    first = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(w.first[:-1][chosen] - first[:-1], size) + np.arange(first[-1])
    sets, set_begin = wd.distinct(*wd.shingles(w.hash[at], first, K))
    node = wd.sequences(w.hash, w.first[:-1][chosen], w.first[1:][chosen])
    return w, text, chosen, sets, set_begin, node


def unit_table(docs: DataFrame, least: int) -> DataFrame:
    """doc_id, th, kind, start, n_words, node, n, bands of paragraphs and blocks; blocks have no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wd.slices(batches):
            w, text, chosen, sets, begin, node = paragraphs(part, least)
            doc_first = np.searchsorted(text[w.text] if len(w.text) else np.zeros(0, int), np.arange(part.batch.num_rows))
            own = text[chosen]
            start = w.first[:-1][chosen] - doc_first[own]
            keys = minhash_bands(sets, begin) if len(chosen) else np.zeros((0, BANDS), np.uint64)
            d = wd.words(part.data, part.offs)
            cuts = block_starts(d)
            same = np.flatnonzero(d.text[cuts[1:]] == d.text[cuts[:-1]]) if len(cuts) > 1 else np.zeros(0, int)
            a, b = cuts[same], cuts[same + 1] if len(same) else cuts[:0]
            blocks = wd.sequences(d.hash, a, b)
            who = pa.array(np.concatenate([own, d.text[a]]))
            bands_at = np.concatenate([np.arange(len(chosen) + 1) * BANDS, np.full(len(a), len(chosen) * BANDS)])
            ints = lambda *x: pa.array(np.concatenate(x).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.batch.column(0).take(who),
                    part.batch.column(1).take(who),
                    ints(np.full(len(chosen), PARAGRAPH), np.full(len(a), BLOCK)),
                    ints(start, a - d.first[d.text[a]]),
                    ints(np.diff(w.first)[chosen], b - a),
                    pa.array(np.concatenate([node, wd.mix(blocks + np.uint64(BLOCK))]).view(np.int64)),
                    ints(np.diff(begin), np.zeros(len(a))),
                    wd.lists(keys.ravel(), bands_at),
                ],
                names=["doc_id", "th", "kind", "start", "n_words", "node", "n", "bands"],
            )

    rows = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("th"), "text")
    return rows.mapInArrow(
        run, "doc_id bigint, th bigint, kind int, start int, n_words int, node bigint, n int, bands array<bigint>"
    )


def sets_of(docs: DataFrame, wanted_docs: Sieve, wanted: Sieve, least: int) -> DataFrame:
    """node, payload: the shingle sets of paragraphs that the sieves let pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wd.slices(wanted_docs.pass_on(batches)):
            _, _, _, sets, begin, node = paragraphs(part, least)
            pick = np.flatnonzero(wanted.may(node.view(np.int64)))
            size = np.diff(begin)[pick]
            out = np.concatenate([[0], np.cumsum(size)])
            at = np.repeat(begin[:-1][pick] - out[:-1], size) + np.arange(out[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[pick].view(np.int64)), wd.binaries(sets[at], out)], names=["node", "payload"]
            )

    rows = docs.where("text is not null").select("doc_id", "text")
    return rows.mapInArrow(run, "node bigint, payload binary").dropDuplicates(["node"])


def repeated_passages(docs: DataFrame, least_words: int = 15) -> DataFrame:
    """doc_id, start_word, end_word, kept_doc_ids, groups: what ``docs`` (doc_id, text) repeat of other or earlier places.

    Paragraphs are lines of at least ``least_words`` words; those whose sets of 5-word shingles have a Jaccard
    coefficient of 0.8 or more link. A passage may also stand inside a longer paragraph: texts
    are cut before words whose hash is locally least, so equal passages are cut alike wherever they stand,
    and equal blocks link. Of each connected group the occurrence with the least doc_id and start is kept.
    The others are merged where they touch or overlap; stretches of at least ``least_words`` words
    are returned as words [start, end), with the documents that keep them and the number of groups met.

    Rows that repeat doc_id and text are one document; rows of one doc_id with different texts
    are several. Rows without doc_id or text, and empty texts, repeat nothing. Other columns are ignored.
    """
    units = store(unit_table(docs, least_words), "units")
    nodes = units.groupBy("node").agg(
        F.min(F.struct("doc_id", "start", "th")).alias("first"),
        F.count("*").alias("count"),
        F.min("kind").alias("kind"),
        F.min("n").alias("n"),
    )
    nodes = store(nodes.where(f"count > 1 or kind = {PARAGRAPH}"), "nodes")
    groups = candidate_groups(
        units.where(F.col("kind") == PARAGRAPH).select("node", F.explode("bands").alias("key"))
    )
    members = store(
        nodes.where(F.col("kind") == PARAGRAPH)
        .join(groups.selectExpr("~~node as node", "grp"), "node")
        .selectExpr("grp", "node", "n", "first.doc_id as doc_id"),
        "members",
    )
    sets = sets_of(docs, Sieve(members, "doc_id"), Sieve(members, "node"), least_words)
    links = verified_links(members, sets, ["node"], DEN / NUM, lambda size, rows: Jaccard(size, rows, NUM, DEN))
    classes = components(links, "a", "b").selectExpr("~~node as node", "component")
    named = nodes.join(classes, "node", "left").withColumn("group_id", F.coalesce("component", "node"))
    kept = named.groupBy("group_id").agg(F.min("first").alias("kept"), F.sum("count").alias("total")).where("total > 1")
    named = named.select("node", "group_id").join(kept.select(F.expr("~~group_id as group_id"), "kept"), "group_id")
    again = (
        units.select("doc_id", "th", "start", "n_words", "node")
        .join(named.selectExpr("~~node as node", "group_id", "kept"), "node")
        .where("not (doc_id = kept.doc_id and start = kept.start and th = kept.th)")
        .selectExpr("doc_id", "th", "start", "start + n_words as stop", "kept.doc_id as kept_doc_id", "group_id")
        .distinct()
    )
    # the units of one text, in order: bounded by its length
    order = Window.partitionBy("doc_id", "th").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = again.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("new").over(order))
    return (
        runs.groupBy("doc_id", "th", "run")
        .agg(
            F.min("start").alias("start_word"),
            F.max("stop").alias("end_word"),
            F.sort_array(F.collect_set("kept_doc_id")).alias("kept_doc_ids"),
            F.countDistinct("group_id").alias("groups"),
        )
        .where(F.col("end_word") - F.col("start_word") >= least_words)
        .select("doc_id", "start_word", "end_word", "kept_doc_ids", "groups")
    )
