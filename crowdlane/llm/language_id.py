"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a text in both directions, labels every byte and pools
the probabilities over the document. It is trained here by backpropagation through
time in numpy, on a bounded sample of labelled windows. Texts of any length are read
whole: in stretches of STRIDE bytes with WARM bytes of context on either side, many at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from . import words as wd

HIDDEN, STRIDE, WARM = 8, 240, 12
UNKNOWN = "und"
#: strata of the sample per language
STRATA = 64
#: the byte read beyond either end of a text
NOTHING = 0


class Direction(NamedTuple):
    """Gate z and candidate c of a minimal gated unit: h' = (1 - z) h + z tanh(c)."""

    wz: np.ndarray  # 256 x HIDDEN
    wc: np.ndarray
    uz: np.ndarray  # HIDDEN x HIDDEN
    uc: np.ndarray


class Network(NamedTuple):
    names: list[str]
    ways: tuple[Direction, Direction]
    out: np.ndarray  # 2 HIDDEN + 1 x languages


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _states(x: np.ndarray, d: Direction) -> np.ndarray:
    """States after each byte, for columns of bytes x (time x batch)."""
    into, between = np.concatenate([-d.wz, 2 * d.wc], 1), np.concatenate([-d.uz, 2 * d.uc], 1)
    h = np.zeros((x.shape[1], HIDDEN), np.float32)
    states = np.empty((*x.shape, HIDDEN), np.float32)
    for t in range(len(x)):
        # tanh by exp: both parts take one call over one array
        e = into[x[t]]
        e += h @ between
        np.clip(e, -30, 30, out=e)
        np.exp(e, out=e)
        z = 1 / (1 + e[:, :HIDDEN])
        c = 1 - 2 / (1 + e[:, HIDDEN:])
        h = h + z * (c - h)
        states[t] = h
    return states


def _train(x: np.ndarray, y: np.ndarray, names: list[str], steps: int, seed: int) -> Network:
    """``x`` (window x time) bytes, ``y`` the language of each window."""
    rng = np.random.default_rng(seed)
    shape = {"wz": (256, HIDDEN), "wc": (256, HIDDEN), "uz": (HIDDEN, HIDDEN), "uc": (HIDDEN, HIDDEN)}
    p = [rng.normal(0, 0.3, s).astype(np.float32) for _ in range(2) for s in shape.values()]
    p.append(np.zeros((2 * HIDDEN + 1, len(names)), np.float32))
    p[-1][:-1] = rng.normal(0, 0.3, (2 * HIDDEN, len(names)))
    first, second = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p]
    batch = min(192, len(x))
    for step in range(1, steps + 1):
        pick = rng.choice(len(x), batch, replace=False)
        xb, yb = x[pick].T, y[pick]
        T = len(xb)
        grads = [np.zeros_like(w) for w in p]
        kept = []
        for way in range(2):
            wz, wc, uz, uc = p[4 * way : 4 * way + 4]
            seen = xb if way == 0 else xb[::-1]
            h, trace = np.zeros((batch, HIDDEN), np.float32), []
            for t in range(T):
                z = _sigmoid(wz[seen[t]] + h @ uz)
                c = np.tanh(wc[seen[t]] + h @ uc)
                trace.append((h, z, c))
                h = h + z * (c - h)
            hs = np.stack([*(a[0] for a in trace[1:]), h])
            kept.append((seen, trace, hs if way == 0 else hs[::-1]))
        both = np.concatenate([kept[0][2], kept[1][2], np.ones((T, batch, 1), np.float32)], 2)
        logit = both @ p[-1]
        logit -= logit.max(2, keepdims=True)
        prob = np.exp(logit)
        prob /= prob.sum(2, keepdims=True)
        prob[:, np.arange(batch), yb] -= 1
        prob /= T * batch
        grads[-1] = both.reshape(-1, both.shape[2]).T @ prob.reshape(-1, len(names))
        back = prob @ p[-1][:-1].T
        for way in range(2):
            wz, wc, uz, uc = p[4 * way : 4 * way + 4]
            gz, gc, guz, guc = grads[4 * way : 4 * way + 4]
            seen, trace, _ = kept[way]
            gh = back[..., way * HIDDEN : (way + 1) * HIDDEN]
            gh = gh if way == 0 else gh[::-1]
            g = np.zeros((batch, HIDDEN), np.float32)
            az, ac = np.empty((T, batch, HIDDEN), np.float32), np.empty((T, batch, HIDDEN), np.float32)
            for t in range(T - 1, -1, -1):
                h, z, c = trace[t]
                g = g + gh[t]
                az[t] = g * (c - h) * z * (1 - z)
                ac[t] = g * z * (1 - c * c)
                guz += h.T @ az[t]
                guc += h.T @ ac[t]
                g = g * (1 - z) + az[t] @ uz.T + ac[t] @ uc.T
            flat = seen.ravel()
            for k in range(HIDDEN):
                gz[:, k] = np.bincount(flat, az[..., k].ravel(), 256)
                gc[:, k] = np.bincount(flat, ac[..., k].ravel(), 256)
        rate = 0.03 * min(1, step / 10) * (1 - 0.9 * step / steps)
        for w, g, m, v in zip(p, grads, first, second, strict=True):
            np.clip(g, -1, 1, out=g)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Network(names, (Direction(*p[:4]), Direction(*p[4:8])), p[-1])


def train(docs: DataFrame, per_language: int = 512, window: int = 96, steps: int = 150, seed: int = 0) -> Network:
    """A network from ``docs`` (text, lang), rows with null lang left out.

    The sample is bounded: at most ``per_language`` windows of ``window`` characters for each language, at a place
    and in an order given by a hash of the text; each of STRATA slots of a language gives its first ones.
    """
    h = F.xxhash64(F.lit(seed), "text")
    place = F.expr(f"int(pmod(xxhash64({seed}, text, 1), greatest(length(text) - {window}, 0) + 1)) + 1")
    piece = docs.where("lang is not null and text rlike '\\\\p{L}'").select(
        "lang", h.alias("h"), F.expr(f"pmod(xxhash64({seed}, text), {STRATA})").alias("slot"), F.substring("text", place, F.lit(window)).alias("piece")
    )
    rank = F.row_number().over(Window.partitionBy("lang", "slot").orderBy("h", "piece"))
    rows = piece.withColumn("r", rank).where(F.col("r") <= max(per_language // STRATA, 1)).select("lang", "h", "piece").toArrow()
    rows = sorted(zip(*(rows[c].to_pylist() for c in ("lang", "h", "piece")), strict=True))
    names = sorted({r[0] for r in rows})
    x = np.zeros((len(rows), window), np.uint8)
    for at, (_, _, piece) in enumerate(rows):
        raw = np.frombuffer(piece.encode()[:window], np.uint8)
        x[at, : len(raw)] = raw
    y = np.array([names.index(r[0]) for r in rows], np.int64)
    if len(names) < 2:
        zero = Direction(*(np.zeros((n, HIDDEN), np.float32) for n in (256, 256, HIDDEN, HIDDEN)))
        return Network(names, (zero, zero), np.zeros((2 * HIDDEN + 1, len(names)), np.float32))
    return _train(x, y, names, steps, seed)


def position_logs(data: np.ndarray, offs: np.ndarray, net: Network) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, byte, probabilities) of every byte, in groups of stretches."""
    size = np.diff(offs)
    pieces = -(-size // STRIDE)
    text = np.repeat(np.arange(len(size)), pieces)
    start = (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * STRIDE
    span = np.arange(-WARM, STRIDE + WARM)
    for at in range(0, len(text), 2048):
        who, begin = text[at : at + 2048], start[at : at + 2048]
        byte = begin[None, :] + span[:, None]  # time x stretch
        inside = (byte >= 0) & (byte < size[who])
        x = np.where(inside, data[np.where(inside, offs[who] + byte, 0)], NOTHING)
        forth = _states(x, net.ways[0])
        back = _states(x[::-1], net.ways[1])[::-1]
        own = inside.copy()
        own[:WARM] = own[WARM + STRIDE :] = False
        logit = forth[own] @ net.out[:HIDDEN] + back[own] @ net.out[HIDDEN:-1] + net.out[-1]
        np.exp(logit - logit.max(1, keepdims=True), out=logit)
        logit /= logit.sum(1, keepdims=True)
        yield np.broadcast_to(who, own.shape)[own], byte[own], logit


def identify_languages(docs: DataFrame, net: Network, spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, bytes_by_lang of every row of ``docs`` (doc_id, text).

    Every byte of a text is labelled; ``bytes_by_lang`` counts the labels by language. The mean of the
    bytes' probabilities gives ``lang_pred``, the language of the greatest (at ties the first by name), and
    ``score``, that mean. A text that is null or has no letter is ``und`` with score 0, as is every
    text if nothing was learnt. With ``spans`` a column of (start, end, lang) gives the labels of all
    bytes as runs. Repeated rows are labelled each. Other columns are ignored.
    """
    names, schema = net.names, "doc_id bigint, lang_pred string, score double, bytes_by_lang map<string,bigint>"
    if spans:
        schema += ", spans array<struct<start:bigint,end:bigint,lang:string>>"
    many = max(len(names), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wd.slices(batches):
            n = part.batch.num_rows
            total, labels = np.zeros((n, many)), np.zeros(n * many, np.int64)
            runs: list[list[dict]] = [[] for _ in range(n)]
            for text, byte, prob in position_logs(part.data, part.offs, net) if names else ():
                best = prob.argmax(1)
                for k in range(many):
                    total[:, k] += np.bincount(text, prob[:, k], n)
                labels += np.bincount(text * many + best, minlength=n * many)
                if spans:
                    order = np.lexsort((byte, text))
                    t, b, k = text[order], byte[order], best[order]
                    edge = np.flatnonzero(np.r_[True, (np.diff(t) != 0) | (np.diff(k) != 0)])
                    for i, j in zip(edge.tolist(), [*edge[1:].tolist(), len(t)], strict=True):
                        own = runs[t[i]]
                        if own and own[-1]["lang"] == names[k[i]] and own[-1]["end"] == b[i]:
                            own[-1]["end"] = int(b[j - 1]) + 1
                        else:
                            own.append({"start": int(b[i]), "end": int(b[j - 1]) + 1, "lang": names[k[i]]})
            share = total / np.maximum(np.diff(part.offs), 1)[:, None]
            share = np.round(share, 6)
            letters = pc.match_substring_regex(part.batch.column(1), r"\p{L}").fill_null(False).to_numpy(zero_copy_only=False)
            known = letters & bool(names)
            best = share.argmax(1)
            pred = [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            counts = labels.reshape(n, many).tolist()
            columns = [
                part.batch.column(0),
                pa.array(pred),
                pa.array(np.where(known, share[np.arange(n), best], 0.0)),
                pa.array([[(a, c) for a, c in zip(names, row, strict=True) if c] if names else [] for row in counts], pa.map_(pa.string(), pa.int64())),
            ]
            out = ["doc_id", "lang_pred", "score", "bytes_by_lang"]
            if spans:
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
                columns.append(pa.array(runs, kind))
                out.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names=out)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
