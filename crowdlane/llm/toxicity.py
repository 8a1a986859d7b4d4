"""Toxicity by a bidirectional gated recurrent network with attention pooling.

The network reads windows of words in both directions. A word enters by its characters, each with its
place in the word, and by a trained vector of its own. Attention pools a window's states, and
a document is as toxic as the worst of its windows, which overlap by half and cover the whole text.
It is trained here by backpropagation through time in numpy, from labels of documents: a
document's loss goes to its windows in proportion to their scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import words as wd

HIDDEN, CHARS, OWN, HEADS = 8, 12, 8, 8
#: words of a window, and from one window to the next
SPAN, STEP = 32, 16
#: word vectors; words share one by their hash
BUCKETS = 1 << 15
#: places of a character in its word that are told apart
PLACES = 12
#: strata of the sample per class
STRATA = 64

# a word has letters, digits and bytes above ASCII; A-Z in lower case, all else parts words
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[:128] = [ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(128)]


class Network(NamedTuple):
    chars: np.ndarray  # PLACES * 256 x CHARS
    own: np.ndarray  # BUCKETS x OWN
    into: np.ndarray  # (CHARS + OWN + 1) x 6 HIDDEN: gates z, r and candidate c, forth and back
    forth: np.ndarray  # HIDDEN x 3 HIDDEN
    back: np.ndarray
    look: np.ndarray  # 2 HIDDEN x HEADS
    head: np.ndarray  # HEADS
    out: np.ndarray  # 2 HIDDEN + 1


class Model(NamedTuple):
    net: Network | None
    #: the score of every text, if the labels have one class only or none
    share: float


class Text(NamedTuple):
    """Words of a slice of texts, ready for the network."""

    first: np.ndarray  # where each text's words begin; one more for the end
    bucket: np.ndarray
    char: np.ndarray  # rows of Network.chars
    word: np.ndarray  # where each word's characters begin

    @classmethod
    def of(cls, data: np.ndarray, offs: np.ndarray) -> Text:
        w = wd.words(data, offs, _TABLE)
        size = w.end - w.start
        word = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(word[-1]) - np.repeat(word[:-1], size)
        char = np.minimum(place, PLACES - 1) * 256 + _TABLE[data[np.repeat(w.start, size) + place]]
        return cls(w.first, (w.hash % np.uint64(BUCKETS)).astype(np.int64), char, word)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word, end) of every window; the windows of a text overlap by SPAN - STEP words."""
        n = np.diff(self.first)
        many = np.where(n > 0, 1 + np.maximum(-(-(n - SPAN) // STEP), 0), 0)
        text = np.repeat(np.arange(len(n)), many)
        begin = self.first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * STEP
        return text, begin, np.minimum(begin + SPAN, self.first[text + 1])


def _inputs(net: Network, t: Text) -> np.ndarray:
    """What enters the network for each word: characters, own vector, one."""
    sums = np.add.reduceat(net.chars[t.char], t.word[:-1], 0) if len(t.char) else np.zeros((0, CHARS), np.float32)
    return np.concatenate([np.tanh(sums), net.own[t.bucket], np.ones((len(t.bucket), 1), np.float32)], 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _direction(gates: np.ndarray, at: np.ndarray, inside: np.ndarray, between: np.ndarray, trace: list | None) -> np.ndarray:
    """States (time x window) of one direction; ``at`` are rows of ``gates``."""
    h = np.zeros((at.shape[1], HIDDEN), np.float32)
    states = np.empty((*at.shape, HIDDEN), np.float32)
    for i in range(len(at)):
        g, u = gates[at[i]], h @ between
        zr = _sigmoid(g[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(g[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
        if trace is not None:
            trace.append((h, z, r, c, u[:, 2 * HIDDEN :]))
        h = (h + z * (c - h)) * inside[i][:, None]
        states[i] = h
    return states


def _forward(net: Network, gates: np.ndarray, begin: np.ndarray, end: np.ndarray, traces: tuple | None = None) -> tuple[np.ndarray, ...]:
    """Score of each window before the sigmoid, and what backpropagation needs."""
    at = begin[None, :] + np.arange(SPAN)[:, None]
    inside = (at < end).astype(np.float32)
    at = np.minimum(at, len(gates) - 1)
    forth = _direction(gates[:, : 3 * HIDDEN], at, inside, net.forth, traces and traces[0])
    back = _direction(gates[:, 3 * HIDDEN :], at[::-1], inside[::-1], net.back, traces and traces[1])[::-1]
    both = np.concatenate([forth, back], 2)
    seen = np.tanh(both @ net.look)
    weight = seen @ net.head - 1e9 * (1 - inside)
    weight = np.exp(weight - weight.max(0))
    weight /= weight.sum(0)
    pooled = (weight[..., None] * both).sum(0)
    return pooled @ net.out[:-1] + net.out[-1], at, inside, both, seen, weight, pooled


def _summed(rows: np.ndarray, values: np.ndarray, many: int) -> np.ndarray:
    return np.stack([np.bincount(rows, v, many) for v in values.T], 1).astype(np.float32)


def _gradients(net: Network, t: Text, y: np.ndarray, weight_of: np.ndarray) -> Network:
    x = _inputs(net, t)
    gates = x @ net.into
    text, begin, end = t.windows()
    traces = ([], [])
    logit, at, inside, both, seen, weight, pooled = _forward(net, gates, begin, end, traces)
    # a document's score is the smooth maximum of its windows'
    many = len(t.first) - 1
    top = np.full(many, -np.inf)
    np.maximum.at(top, text, logit)
    part = np.exp(logit - top[text])
    total = np.bincount(text, part, many)
    doc = top + np.log(np.maximum(total, 1e-30))
    error = (_sigmoid(doc) - y) * weight_of
    d = (error[text] * part / total[text]).astype(np.float32)
    d_out = np.append(pooled.T @ d, d.sum()).astype(np.float32)
    d_pooled = d[:, None] * net.out[:-1]
    d_weight = (both * d_pooled).sum(2)
    d_score = weight * (d_weight - (weight * d_weight).sum(0))
    d_seen = d_score[..., None] * net.head * (1 - seen**2)
    d_both = weight[..., None] * d_pooled + d_seen @ net.look.T
    d_head = (seen * d_score[..., None]).sum((0, 1))
    d_look = both.reshape(-1, 2 * HIDDEN).T @ d_seen.reshape(-1, HEADS)
    d_between, d_gates = [], []
    for way, between in enumerate((net.forth, net.back)):
        ahead = d_both[..., way * HIDDEN : (way + 1) * HIDDEN]
        mask = inside
        if way:
            ahead, mask = ahead[::-1], inside[::-1]
        carry = np.zeros_like(ahead[0])
        grad, into = np.zeros_like(between), np.empty((*ahead.shape[:2], 3 * HIDDEN), np.float32)
        for i in range(SPAN - 1, -1, -1):
            h, z, r, c, u = traces[way][i]
            g = (carry + ahead[i]) * mask[i][:, None]
            dc = g * z * (1 - c * c)
            dz = g * (c - h) * z * (1 - z)
            dr = dc * u * r * (1 - r)
            into[i] = np.concatenate([dz, dr, dc], 1)
            du = np.concatenate([dz, dr, dc * r], 1)
            grad += h.T @ du
            carry = g * (1 - z) + du @ between.T
        d_between.append(grad)
        rows = at[::-1] if way else at
        d_gates.append(_summed(rows.ravel(), into.reshape(-1, 3 * HIDDEN), len(x)))
    d_gates = np.concatenate(d_gates, 1)
    d_x = d_gates @ net.into.T
    d_sum = d_x[:, :CHARS] * (1 - x[:, :CHARS] ** 2)
    d_chars = _summed(t.char, np.repeat(d_sum, np.diff(t.word), 0), len(net.chars))
    d_own = _summed(t.bucket, d_x[:, CHARS : CHARS + OWN], BUCKETS)
    return Network(d_chars, d_own, x.T @ d_gates, *d_between, d_look, d_head, d_out)


def _train(texts: list[bytes], y: np.ndarray, steps: int, batch: int, seed: int) -> Network:
    rng = np.random.default_rng(seed)

    def some(*shape: int, scale: float = 0.3) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    net = Network(
        some(PLACES * 256, CHARS, scale=0.2),
        np.zeros((BUCKETS, OWN), np.float32),
        some(CHARS + OWN + 1, 6 * HIDDEN),
        some(HIDDEN, 3 * HIDDEN),
        some(HIDDEN, 3 * HIDDEN),
        some(2 * HIDDEN, HEADS),
        some(HEADS),
        some(2 * HIDDEN + 1),
    )
    net.out[-1] = -3
    first, second = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
    order: list[int] = []
    for step in range(1, steps + 1):
        if len(order) < batch:
            order += rng.permutation(len(texts)).tolist()
        pick, order = order[:batch], order[batch:]
        offs = np.concatenate([[0], np.cumsum([len(texts[i]) for i in pick])])
        t = Text.of(np.frombuffer(b"".join(texts[i] for i in pick), np.uint8), offs)
        full = np.diff(t.first) > 0
        grads = _gradients(net, t, y[pick], full / max(full.sum(), 1))
        rate = 0.02 * min(1, step / 10) * (1 - 0.95 * step / steps)
        for p, g, m, v in zip(net, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            # words seen seldom move little, so that what one document says by chance is not learnt
            slow = 1e-3 if p is net.own else 1e-6
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + slow)
        net.own[:] *= 1 - 0.1 * rate
    return net


def train(docs: DataFrame, labels: DataFrame, toxic: int = 512, clean: int = 1024, most: int = 8192, steps: int = 240, batch: int = 32, seed: int = 0) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, y 0 or 1).

    The sample is bounded: at most ``toxic`` and ``clean`` labelled documents in an order given by a hash
    of doc_id, spread over STRATA slots, of which those with more than ``most`` characters are left out.
    Of several labels of one doc_id the greatest counts, null labels do not; of several texts of one doc_id one is taken.
    """
    h = F.xxhash64(F.lit(seed), "doc_id")
    known = labels.where("y is not null and doc_id is not null").groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
    rank = F.row_number().over(Window.partitionBy("y", "slot").orderBy("h", "doc_id"))
    ranked = known.select(F.col("doc_id").alias("id"), "y", h.alias("h")).withColumnRenamed("id", "doc_id")
    ranked = ranked.withColumn("slot", F.expr(f"pmod(xxhash64(h), {STRATA})")).withColumn("r", rank)
    sample = ranked.where(f"r <= if(y = 1, {max(toxic // STRATA, 1)}, {max(clean // STRATA, 1)})").selectExpr("doc_id as id", "y", "h")
    # at most toxic + clean rows, so they may be sent everywhere
    found = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("id"))
    found = found.where(f"length(text) between 1 and {most}").groupBy("h", "id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = found.toArrow()
    rows = sorted(zip(*(rows[c].to_pylist() for c in ("h", "id", "y", "text")), strict=True))
    y = np.array([r[2] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return Model(None, float(y.mean()) if len(y) else 0.5)
    return Model(_train([r[3].encode() for r in rows], y, steps, batch, seed), float(y.mean()))


def window_scores(net: Network, data: np.ndarray, offs: np.ndarray) -> tuple[Text, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts, and (text, first word, end, score) of every window."""
    t = Text.of(data, offs)
    gates = _inputs(net, t) @ net.into
    text, begin, end = t.windows()
    logit = [_forward(net, gates, begin[i : i + 2048], end[i : i + 2048])[0] for i in range(0, len(text), 2048)]
    return t, text, begin, end, _sigmoid(np.concatenate(logit)) if logit else np.zeros(0)


def score_toxicity(docs: DataFrame, model: Model, windows: bool = False) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 if score >= 0.5), worst (words start to end) of every row of ``docs`` (doc_id, text).

    The score is that of the worst window, which ``worst`` names (the first at ties). A text without a word (null,
    empty, blank, signs only) scores 0, and null is its worst window. If nothing or one class was learnt every text
    scores the toxic share of the labels (or one half). With ``windows`` a column has (start, end, score) of all windows.
    Repeated rows are scored each. Other columns are ignored.
    """
    net = model.net
    span = "struct<start:bigint,end:bigint>"
    schema = f"doc_id bigint, score double, predicted int, worst {span}"
    if windows:
        schema += ", windows array<struct<start:bigint,end:bigint,score:double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wd.slices(batches):
            n = part.batch.num_rows
            score, place = np.full(n, model.share), np.full(n, -1)
            text = begin = end = each = np.zeros(0, np.int64)
            first = np.zeros(n + 1, np.int64)
            if net:
                t, text, begin, end, each = window_scores(net, part.data, part.offs)
                first, each = t.first, np.round(each, 6)
                score = np.zeros(n)
                order = np.lexsort((begin, -each, text))
                lead = order[np.flatnonzero(np.diff(text[order], prepend=-1))]
                score[text[lead]], place[text[lead]] = each[lead], lead
            at = np.maximum(place, 0)
            none = place < 0
            own = first[:-1]
            spans = [np.where(none, 0, x[at] - own) if len(x) else np.zeros(n, np.int64) for x in (begin, end)]
            worst = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in spans], names=["start", "end"], mask=pa.array(none))
            columns = [part.batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), worst]
            names = ["doc_id", "score", "predicted", "worst"]
            if windows:
                edge = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
                cells = [pa.array((x - own[text]).astype(np.int64)) for x in (begin, end)] + [pa.array(each.astype(np.float64))]
                columns.append(pa.ListArray.from_arrays(pa.array(edge), pa.StructArray.from_arrays(cells, names=["start", "end", "score"])))
                names.append("windows")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
