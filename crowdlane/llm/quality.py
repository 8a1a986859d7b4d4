"""Quality classifier: random Fourier features, ridge by summed normal equations, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import words as wd
from .scratch import store

FEATURES = 17
DIMENSIONS = 192
#: places of the histogram that the calibration is fitted to
PLACES = 1000


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """FEATURES numbers of each text: lengths, shares of kinds of bytes, repetition of words, pairs and lines."""
    w = wd.words(data, offs)
    n_words, size = np.diff(w.first), np.diff(offs)
    per_word, per_byte = np.maximum(n_words, 1), np.maximum(size, 1)
    per_text = lambda at: np.bincount(np.searchsorted(offs, at, "right") - 1, minlength=len(size))

    def kind(*spans: tuple[str, str]) -> np.ndarray:
        table = np.zeros(256, bool)
        for a, b in spans:
            table[ord(a) : ord(b) + 1] = True
        return table

    def share(table: np.ndarray) -> np.ndarray:
        return per_text(np.flatnonzero(table[data])) / per_byte

    symbols = kind(("#", "'"), ("*", "+"), ("<", "<"), (">", ">"), ("=", "="), ("@", "@"), ("[", "`"), ("{", "~"))
    length = (w.end - w.start).astype(float)
    sum_of = lambda v: np.bincount(w.text, weights=v, minlength=len(size))
    mean = sum_of(length) / per_word
    spread = np.sqrt(np.maximum(sum_of(length**2) / per_word - mean**2, 0))
    last, first = data[w.end - 1], data[w.start]
    new, begin = wd.distinct(w.hash, w.first)
    pairs, pair_first = wd.shingles(w.hash, w.first, 2)
    new_pairs, pair_begin = wd.distinct(pairs, pair_first)
    again = np.zeros(len(w.hash))
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.text[1:] == w.text[:-1])
    lines = per_text(np.flatnonzero(data == 10)) + 1
    out = [
        np.log1p(n_words),
        mean,
        spread,
        np.log1p(n_words / lines),
        share(kind(("A", "Z"))),
        share(kind(("0", "9"))),
        share(symbols),
        share(kind(("!", "!"), ("?", "?"))),
        share(kind((".", "."), (",", ","), (";", ":"))),
        share(kind((" ", " "), ("\t", "\r"))),
        (data >= 128).any() * share(kind(("\x80", "\xff"))),
        sum_of(symbols[last] | (last == ord("!"))) / per_word,
        sum_of(kind(("A", "Z"))[first]) / per_word,
        sum_of(length <= 1) / per_word,
        np.diff(begin) / per_word,
        np.diff(pair_begin) / np.maximum(np.diff(pair_first), 1),
        sum_of(again) / per_word,
    ]
    return np.stack(out, 1).astype(np.float64)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, x (FEATURES doubles) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wd.slices(batches):
            x = statistics(part.data, part.offs)
            at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * FEATURES)
            yield pa.RecordBatch.from_arrays(
                [part.batch.column(0), pa.ListArray.from_arrays(at, pa.array(x.ravel()))], names=["doc_id", "x"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, x array<double>")


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray  # directions of the random Fourier features
    shift: np.ndarray
    weights: np.ndarray
    low: float  # raw score of place 0
    step: float
    level: np.ndarray  # calibrated score at each place, ascending

    def features(self, x: np.ndarray) -> np.ndarray:
        """Their products approximate exp(-|a - b|**2 / (2 FEATURES)) of standardised statistics."""
        z = np.cos(np.clip((x - self.mean) / self.scale, -8, 8) @ self.turn + self.shift)
        return np.concatenate([z * np.sqrt(2 / self.turn.shape[1]), np.ones((len(x), 1))], 1)

    def place(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.round((raw - self.low) / self.step), 0, PLACES - 1).astype(np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.level[self.place(self.features(x) @ self.weights)]


def _matrix(table: pa.RecordBatch, name: str = "x") -> np.ndarray:
    return table.column(table.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The ascending sequence nearest to ``value`` by weighted squares: neighbours out of order are pooled."""
    pools: list[list[float]] = []
    for v, w in zip(value.tolist(), weight.tolist(), strict=True):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v1, w1, n1 = pools.pop()
            v0, w0, n0 = pools.pop()
            pools.append([(v0 * w0 + v1 * w1) / (w0 + w1), w0 + w1, n0 + n1])
    return np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


def fit(stats: DataFrame, labels: DataFrame, seed: int = 0, ridge: float = 1e-3) -> Model:
    """The model from ``stats`` (doc_id, x) and ``labels`` (doc_id, y 0 or 1).

    Rows with crc32(doc_id) mod 2 = 0 give the ridge weights, the others the calibration.
    Each partition sums its own normal equations; the sums are added row by row of the matrix.
    What reaches the driver is means, one matrix of DIMENSIONS + 1 and a histogram of PLACES,
    whatever the number of labels. With one class only, or none, every score is the label's share (or one half).
    """
    labels = labels.where("y is not null and doc_id is not null").groupBy("doc_id").agg(F.max("y").cast("double").alias("y"))
    learn = store(stats.join(labels.withColumnRenamed("doc_id", "id"), F.col("doc_id") == F.col("id")).select("doc_id", "x", "y"), "learn")
    fold = F.pmod(F.crc32(F.concat(F.lit("fold "), F.col("doc_id").cast("string"))), F.lit(2))
    sums = [f"sum(x[{i}]) as s{i}" for i in range(FEATURES)] + [f"sum(x[{i}] * x[{i}]) as q{i}" for i in range(FEATURES)]
    row = learn.selectExpr("count(*) as n", "avg(y) as y", *sums).first()
    n = max(row["n"], 1)
    mean = np.array([row[f"s{i}"] or 0.0 for i in range(FEATURES)]) / n
    var = np.array([row[f"q{i}"] or 0.0 for i in range(FEATURES)]) / n - mean**2
    rng = np.random.default_rng(seed)
    flat = Model(
        mean,
        np.sqrt(np.maximum(var, 1e-6)),
        rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, DIMENSIONS)),
        rng.uniform(0, 2 * np.pi, DIMENSIONS),
        np.zeros(DIMENSIONS + 1),
        0.0,
        1.0,
        np.full(PLACES, 0.5 if row["y"] is None else row["y"]),
    )
    if not row["n"]:
        return flat

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((DIMENSIONS + 1, DIMENSIONS + 2))
        for batch in batches:
            y = batch.column(1).to_numpy()
            for at in range(0, len(y), 4096):
                z = flat.features(_matrix(batch.slice(at, 4096)))
                total += z.T @ np.concatenate([z, y[at : at + 4096, None]], 1)
        rows = np.arange(DIMENSIONS + 1)
        cells = pa.array(total.ravel())
        at = pa.array((np.arange(DIMENSIONS + 2) * (DIMENSIONS + 2)).astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.ListArray.from_arrays(at, cells)], names=["row", "cells"])

    def added(table: pa.Table) -> pa.Table:
        cells = table["cells"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        return pa.table({"row": table["row"][:1], "cells": [cells.sum(0)]})

    parts = learn.where(fold == 0).select("x", "y").mapInArrow(equations, "row bigint, cells array<double>")
    got = parts.groupBy("row").applyInArrow(added, "row bigint, cells array<double>").toArrow()
    matrix = np.zeros((DIMENSIONS + 1, DIMENSIONS + 2))
    matrix[got["row"].to_numpy()] = np.array(got["cells"].to_pylist()).reshape(-1, DIMENSIONS + 2)
    gram, right = matrix[:, :-1], matrix[:, -1]
    count = gram[-1, -1]
    if not count or right[-1] in (0, count):
        return flat
    weights = np.linalg.solve(gram + ridge * count / DIMENSIONS * np.eye(DIMENSIONS + 1), right)
    sharp = flat._replace(weights=weights, low=-0.5, step=2 / PLACES)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = sharp.place(sharp.features(_matrix(batch)) @ sharp.weights)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column(1)], names=["place", "y"])

    seen = learn.where(fold == 1).select("x", "y").mapInArrow(placed, "place bigint, y double")
    seen = seen.groupBy("place").agg(F.count("*").alias("n"), F.sum("y").alias("y")).toArrow()
    n, y = np.zeros(PLACES), np.zeros(PLACES)
    n[seen["place"].to_numpy()], y[seen["place"].to_numpy()] = seen["n"].to_numpy(), seen["y"].to_numpy()
    if not n.any():
        return sharp._replace(level=np.clip(sharp.low + sharp.step * np.arange(PLACES), 0, 1))
    full = np.flatnonzero(n)
    level = np.interp(np.arange(PLACES), full, isotonic(y[full] / n[full], n[full]))
    return sharp._replace(level=np.clip(level, 0, 1))


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``least`` or more; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wd.slices(batches):
            good = np.round(model.score(statistics(part.data, part.offs)), 6) >= least
            if good.any():
                yield part.batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def score_quality(docs: DataFrame, labels: DataFrame, learn: str = "true") -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 if score >= 0.5) of every row of ``docs`` (doc_id, text).

    Learns from the rows of ``labels`` (doc_id, y) for which the SQL condition ``learn`` holds;
    ids, sources and labels never enter a score. Null text counts as empty; empty texts are scored by
    the statistics of nothing. Of several labels of one doc_id the greatest counts, null labels do not.
    Repeated rows are scored each. Other columns are ignored.
    """
    stats = store(document_statistics(docs), "statistics")
    model = fit(stats, labels.where(learn))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.round(model.score(_matrix(batch)), 6)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return stats.mapInArrow(run, "doc_id bigint, score double, predicted int")
