"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import words as wd
from .scratch import store
from .sieve import Sieve

MATCH, MISS, GAP = 2, -1, -1


def _grams(batch_rows: DataFrame, k: int, wanted: Sieve | None = None) -> DataFrame:
    """id, gram, at, n_words: the k-word grams of each text (of short texts, all words) that pass the sieve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wd.slices(batches):
            w = wd.words(part.data, part.offs)
            grams, begin = wd.shingles(w.hash, w.first, k)
            grams = grams.view(np.int64)
            pick = np.flatnonzero(wanted.may(grams)) if wanted else np.arange(len(grams))
            text = np.searchsorted(begin, pick, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    part.batch.column(0).take(pa.array(text)),
                    pa.array(grams[pick]),
                    pa.array((pick - begin[text]).astype(np.int32)),
                    pa.array(np.diff(w.first)[text].astype(np.int32)),
                ],
                names=["id", "gram", "at", "n_words"],
            )

    return batch_rows.mapInArrow(run, "id bigint, gram bigint, at int, n_words int")


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair of rows, and the column of ``text`` where it ends.

    Row i of ``item`` meets row i of ``text``; values that are padding differ on both sides. The gaps along
    the text are a running maximum, so a whole row of all pairs is one step.
    """
    n, m = text.shape
    slope = np.arange(m, dtype=np.int32) * -GAP
    last = np.zeros((n, m + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for k in range(item.shape[1]):
        now = last[:, :-1] + np.where(text == item[:, k : k + 1], MATCH, MISS)
        np.maximum(now, last[:, 1:] + GAP, out=now)
        np.maximum(now, 0, out=now)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        top = now.max(1)
        better = top > best
        end[better] = now[better].argmax(1)
        best = np.maximum(best, top)
        last[:, 1:] = now
    return best, end


def _padded(rows: list[np.ndarray], filler: int) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows))), filler, np.int64)
    for line, row in zip(out, rows, strict=True):
        line[: len(row)] = row
    return out


def seeds_of(items: DataFrame, k: int) -> DataFrame:
    """gram, item_id, at, n_item: every gram of each item; their number is bounded by the benchmark."""
    grams = _grams(items, k).withColumnRenamed("id", "item_id").withColumnRenamed("n_words", "n_item")
    return grams.select("gram", "item_id", "at", "n_item").distinct()


def find_leaks(docs: DataFrame, items: DataFrame, k: int = 4, least: float = 0.5) -> DataFrame:
    """doc_id, item_id, score, start_word, end_word: the test items found in each document.

    ``docs`` has doc_id and text, ``items`` item_id and text. Where any ``k`` words of an item stand in a
    text as in the item, the words around it are aligned with the item (match +2, miss and gap -1, local);
    ``score`` is the best alignment's over that of the whole item with itself, and the item is found from
    ``least`` on: whole copies have 1, copies with a fifth of the words replaced about 0.7. The best
    place of each (document, item) is returned with its words [start, end).

    Every gram of an item is a seed, however often it occurs, so neither an item that has leaked into many
    documents nor its edited copies are missed. A copy without ``k`` neighbouring words in place has no seed. Items or texts that are null or empty find nothing; an item shorter than ``k``
    words is one seed. Rows without id are left out; rows of one doc_id with different texts count together.
    Repeated rows change nothing. Other columns are ignored.
    """
    docs = docs.where("doc_id is not null").select(F.col("doc_id").alias("id"), "text")
    items = items.where("item_id is not null").select(F.col("item_id").alias("id"), "text")
    seeds = store(seeds_of(items, k), "seeds")
    hits = _grams(docs, k, Sieve(seeds, "gram"))
    # the stretch of text that an item with this seed would take, in steps of its own length
    places = hits.withColumnRenamed("at", "place").withColumnRenamed("n_words", "n_text").join(seeds, "gram")
    places = places.withColumn("step", F.expr("int(floor((place - at) / n_item))"))
    counted = places.groupBy("id", "item_id", "n_item", "step").count()
    wanted = store(
        counted.select(
            "id",
            "item_id",
            F.expr("(step * n_item) - int(ceil(n_item / 4)) - 2").alias("low"),
            F.expr("(step + 2) * n_item + int(ceil(n_item / 4)) + 2").alias("high"),
        ),
        "stretches",
    )
    rows = wanted.groupBy("id").agg(F.sort_array(F.collect_set(F.struct("item_id", "low", "high"))).alias("wanted"))
    sieve = Sieve(wanted, "id")

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sieve.pass_on(batches)

    # each step in Python is a stage of its own: a task holds one worker then, not three
    texts = docs.mapInArrow(passed, "id bigint, text string").join(rows.selectExpr("~~id as id", "wanted"), "id")
    texts = store(texts.select("id", "text", "wanted"), "texts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wd.slices(batches):
            w = wd.words(part.data, part.offs)
            out: list[tuple] = []
            for row, doc in enumerate(part.batch.column(0).to_pylist()):
                own = w.hash[w.first[row] : w.first[row + 1]].view(np.int64)
                for x in part.batch.column(2)[row].as_py():
                    low = max(x["low"], 0)
                    piece = own[low : max(x["high"], 0)]
                    if len(piece):
                        out.append((doc, x["item_id"], low, piece.tobytes()))
            columns = zip(*out, strict=True) if out else ((), (), (), ())
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["id", "item_id", "low", "words"]
            )

    pieces = store(texts.mapInArrow(cut, "id bigint, item_id bigint, low int, words binary"), "pieces")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wd.slices(batches):
            w = wd.words(part.data, part.offs)
            yield pa.RecordBatch.from_arrays([part.batch.column(0), wd.binaries(w.hash, w.first)], names=["item_id", "item"])

    known = items.mapInArrow(hashed, "item_id bigint, item binary").dropDuplicates(["item_id", "item"])
    pairs = pieces.join(known, "item_id").select("id", "item_id", "low", "words", "item")

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item = [np.frombuffer(x, np.int64) for x in batch.column(4).to_pylist()]
            text = [np.frombuffer(x, np.int64) for x in batch.column(3).to_pylist()]
            score, start, end = np.zeros(len(item)), np.zeros(len(item), np.int32), np.zeros(len(item), np.int32)
            order = sorted(range(len(item)), key=lambda i: (len(item[i]), len(text[i])))
            at = 0
            while at < len(order):
                # of like lengths, and no more than about two million cells of a row at once
                group = order[at : at + max(1, min(256, 2_000_000 // (len(text[order[at]]) + 1)))]
                at += len(group)
                a, b = [item[i] for i in group], [text[i] for i in group]
                best, last = smith_waterman(_padded(a, 1), _padded(b, 2))
                back, first = smith_waterman(_padded([x[::-1] for x in a], 1), _padded([x[: e + 1][::-1] for x, e in zip(b, last.tolist(), strict=True)], 2))
                score[group] = best / np.array([MATCH * max(len(x), 1) for x in a])
                end[group], start[group] = last + 1, last - first
            low = batch.column(2).to_numpy()
            keep = pa.array(score >= least)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.round(score, 6)), pa.array(low + start), pa.array(low + end)],
                names=["doc_id", "item_id", "score", "start_word", "end_word"],
            ).filter(keep)

    found = pairs.mapInArrow(aligned, "doc_id bigint, item_id bigint, score double, start_word int, end_word int")
    best = F.min(F.struct((-F.col("score")).alias("s"), "start_word", "end_word")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("b.s")).alias("score"), "b.start_word", "b.end_word"
    )
