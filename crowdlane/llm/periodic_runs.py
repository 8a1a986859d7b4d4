"""Periodic runs of words, found in the Re-Pair grammar of the texts.

A run is a stretch of words with smallest period q, at least 2 q and LEAST words long,
that no neighbouring word extends. The texts of a slice are compressed together:
frequent pairs of neighbouring symbols become nonterminals, round by round. Every run
lies in some symbol's expansion and crosses the seam of its two halves there, or crosses
a seam between symbols that are left at the top. So runs are computed once per
nonterminal and top seam, translated to all places the nonterminal derives, and pieces
of one period that overlap by a period are merged to maximal intervals.

A run of 12 words or more repeats six neighbouring words of itself, so texts without
six words that come twice have none and are not compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import words as wd

LEAST = 12
#: words of the shortest window that is looked up around a seam; see :func:`_seam_periods`
WINDOW = 3
_SAME_CASE = np.arange(256, dtype=np.uint8)
SCHEMA = "doc_id bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _dense(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number from 0 for each different value, and how often each number comes."""
    _, number, count = np.unique(x, return_inverse=True, return_counts=True)
    return number, count


class Grammar:
    """Symbols 0 .. terminals - 1 are words; symbol terminals + i derives ``left[i]`` and ``right[i]``."""

    def __init__(self, ids: np.ndarray, first: np.ndarray) -> None:
        """``ids`` are the words of all texts; a text is ids[first[t]:first[t + 1]]."""
        terminals = int(ids.max(initial=-1)) + 1
        symbol, start = ids.astype(np.int64), np.arange(len(ids))
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        left, right, many = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], terminals
        # a pair that comes once comes once for ever, until one of its symbols is replaced
        open_ = np.ones(max(len(ids) - 1, 0), bool)
        while True:
            pair = symbol[:-1] * many + symbol[1:]
            at = np.flatnonzero(open_ & (text[:-1] == text[1:]))
            number, count = _dense(pair[at])
            often = at[count[number] > 1]
            if not len(often):
                break
            rate = count[number][count[number] > 1]
            # priority: the more frequent pair, then the one that a hash of it prefers
            rank = np.zeros(len(pair) + 2, np.int64)
            rank[often + 1] = (rate << 32) | (wd.mix(pair[often].astype(np.uint64)) >> np.uint64(33)).astype(np.int64)
            # in a block of one symbol every second pair counts, from its beginning
            again = np.zeros(len(pair) + 1, bool)
            again[1:-1] = (pair[1:] == pair[:-1]) & (rank[2:-1] > 0)
            index = np.arange(len(pair))
            even = (index - np.maximum.accumulate(np.where(again[:-1], 0, index))) % 2 == 0
            here, before, after = rank[1:-1], np.where(again[:-1], 0, rank[:-2]), np.where(again[1:], 0, rank[2:])
            pick = (here > 0) & even & (here > before) & (here >= after)
            # equal hashes of different pairs: the left one of two neighbours is taken
            pick[1:] &= ~pick[:-1]
            made, new = np.unique(pair[pick], return_inverse=True)
            left.append(made // many)
            right.append(made % many)
            symbol[:-1][pick] = many + new
            stay, changed = np.ones(len(symbol), bool), np.zeros(len(symbol), bool)
            stay[1:][pick] = False
            changed[:-1][pick] = True
            open_ = np.append(rank[1:-1] > 0, False)[stay] | changed[stay]
            symbol, start, text, changed = symbol[stay], start[stay], text[stay], changed[stay]
            open_ = open_[:-1] | changed[1:]
            many += len(made)
        self.terminals = terminals
        self.left, self.right = np.concatenate(left), np.concatenate(right)
        size = np.ones(many, np.int64)
        at = terminals
        for a, b in zip(left[1:], right[1:], strict=True):  # a round uses symbols of earlier rounds only
            size[at : at + len(a)] = size[a] + size[b]
            at += len(a)
        self.size = size
        self.symbol, self.start, self.text = symbol, start, text

    def derived(self) -> tuple[np.ndarray, np.ndarray]:
        """(nonterminal from 0, where its expansion begins) of every node of all derivations."""
        symbol, start = self.symbol, self.start
        found = []
        while True:
            inner = symbol >= self.terminals
            rule, begin = symbol[inner] - self.terminals, start[inner]
            if not len(rule):
                break
            found.append((rule, begin))
            halves = self.left[rule]
            symbol = np.concatenate([halves, self.right[rule]])
            start = np.concatenate([begin, begin + self.size[halves]])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rule, begin = (np.concatenate(x) for x in zip(*found, strict=True))
        return rule, begin


class Windows:
    """For word windows of 1, 3, 6, 12, ... words: equal numbers for equal windows, -1 for those that come once."""

    def __init__(self, ids: np.ndarray, first: np.ndarray) -> None:
        n = len(ids)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        rest = first[1:][text] - np.arange(n)  # words up to the end of the text
        one, count = _dense(text * (int(ids.max(initial=0)) + 1) + ids)
        one = np.where(count[one] > 1, one, -1)
        self.n, self.levels, number = n, [(1, one)], one
        size, grow = 1, 1
        while True:
            # windows of size + grow words: a window of size words, and the one of grow words behind it
            ahead = number if grow == size else one
            alive = np.flatnonzero((number >= 0) & (rest >= size + grow))
            alive = alive[ahead[alive + size] >= 0]
            key = number[alive] * (n + 1) + ahead[alive + size]
            kept, count = _dense(key)
            more = count[kept] > 1
            number = np.full(n, -1)
            number[alive[more]] = kept[more]
            size += grow
            if not more.any():
                break
            if size >= WINDOW:
                self.levels.append((size, number))
                grow = size

    def forth(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and from b on agree, within their text."""
        out = np.zeros(len(a), np.int64)
        for size, number in [*self.levels[:0:-1], *[self.levels[0]] * (WINDOW - 1)]:
            x, y = a + out, b + out
            inside = (x < self.n) & (y < self.n)
            x, y = number[np.where(inside, x, 0)], number[np.where(inside, y, 0)]
            out += size * (inside & (x == y) & (x >= 0))
        return out

    def back(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and before b agree."""
        out = np.zeros(len(a), np.int64)
        for size, number in [*self.levels[:0:-1], *[self.levels[0]] * (WINDOW - 1)]:
            x, y = a - out - size, b - out - size
            inside = (x >= 0) & (y >= 0)
            x, y = number[np.where(inside, x, 0)], number[np.where(inside, y, 0)]
            out += size * (inside & (x == y) & (x >= 0))
        return out


def _seam_periods(w: Windows, low: np.ndarray, seam: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of a seam, period) of all periods that a run across a seam within low .. high can have.

    Let a run have L words before the seam and R behind it, L + R >= max(12, 2 q). For
    windows of l words and 2 l <= q < 4 l (or l = 3 and q < 12), the l words before the seam or the
    l words behind it lie in the run and come again q words earlier or later in it:
    behind it, if R >= l and L >= q (earlier) or L < l (later, as then R >= q + l); before it,
    if R < l (earlier, as then L >= q + l) or l <= L < q (later, as then R > q).
    """
    for size, number in w.levels[1:]:
        least, most = (1 if size == WINDOW else 2 * size), 4 * size - 1
        order = np.flatnonzero(number >= 0)
        key = number[order] * (w.n + 1) + order
        key.sort()
        place = key % (w.n + 1)
        for shift in (0, -size):
            at = seam + shift
            fits = (at >= low) & (at + size <= high)
            which = np.flatnonzero(fits)
            which = which[number[at[which]] >= 0]
            base, mid = number[at[which]] * (w.n + 1), at[which]
            for begin, end in (
                (base + np.maximum(mid - most, low[which]), base + np.maximum(mid - least + 1, 0)),
                (base + mid + least, base + np.minimum(mid + most, high[which] - size) + 1),
            ):
                i = np.searchsorted(key, begin)
                j = np.searchsorted(key, end)
                many = np.maximum(j - i, 0)
                # in pieces, so that memory is bounded where a window comes very often
                edges = np.concatenate([[0], np.cumsum(many)])
                cut = 0
                while cut < len(many):
                    stop = max(int(np.searchsorted(edges, edges[cut] + (1 << 18), "right")) - 1, cut + 1)
                    part = many[cut:stop]
                    if part.any():
                        who = np.repeat(np.arange(cut, stop), part)
                        found = place[i[who] + np.arange(part.sum()) - np.repeat(edges[cut:stop] - edges[cut], part)]
                        yield which[who], np.abs(found - mid[who])
                    cut = stop


def _crossing(w: Windows, low: np.ndarray, seam: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """(index of a seam, start, end, period) of the runs within low .. high that cross the seam."""
    out = []
    known = np.zeros((3, len(seam)), np.int64)  # start, end, period of the longest run found at each seam
    known[2] = 1
    for who, q in _seam_periods(w, low, seam, high):
        pair = np.unique(who * (w.n + 1) + q)
        who, q = pair // (w.n + 1), pair % (w.n + 1)
        # a multiple of a known run's period gives that run again
        fresh = (q % known[2, who] != 0) | (2 * q > known[1, who] - known[0, who])
        who, q = who[fresh], q[fresh]
        # as far as words q apart agree, seen from q words before the seam (L >= q) and from the seam (R >= q)
        for t in (seam[who] - q, seam[who]):
            at = np.flatnonzero((t >= low[who]) & (t + q <= high[who]))
            i, p, t = who[at], q[at], t[at]
            start = np.maximum(t - w.back(t, t + p), low[i])
            end = np.minimum(t + p + w.forth(t, t + p), high[i])
            keep = (end - start >= np.maximum(LEAST, 2 * p)) & (start < seam[i]) & (end > seam[i])
            found = (i[keep], start[keep], end[keep], p[keep])
            out.append(found)
            order = np.argsort(found[2] - found[1], kind="stable")
            i, start, end, p = (x[order] for x in found)
            longer = end - start > known[1, i] - known[0, i]
            known[:, i[longer]] = start[longer], end[longer], p[longer]
    if not out:
        return (np.zeros(0, np.int64),) * 4
    who, start, end, q = (np.concatenate(x) for x in zip(*out, strict=True))
    # a stretch that was also found with a multiple of its smallest period
    order = np.lexsort((q, end, start, who))
    who, start, end, q = who[order], start[order], end[order], q[order]
    keep = np.ones(len(q), bool)
    keep[1:] = (who[1:] != who[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return who[keep], start[keep], end[keep], q[keep]


def find_runs(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of every run, by text, start and period; starts count from the text's beginning.

    ``ids`` are numbers of words, a text is ids[first[t]:first[t + 1]].
    """
    none = (np.zeros(0, np.int64),) * 4
    w = Windows(ids, first)
    if len(w.levels) < 2:
        return none
    g = Grammar(ids, first)
    rule, begin = g.derived()
    some, at = np.unique(rule, return_index=True)
    low = begin[at]
    seam, high = low + g.size[g.left[some]], low + g.size[some + g.terminals]
    # seams between neighbours at the top, within the whole text
    inner = np.flatnonzero(g.text[1:] == g.text[:-1]) + 1
    top = g.text[inner]
    who, start, end, q = _crossing(
        w, np.concatenate([low, first[top]]), np.concatenate([seam, g.start[inner]]), np.concatenate([high, first[top + 1]])
    )
    inside = who < len(some)
    # the runs of a nonterminal stand wherever it is derived
    order = np.argsort(rule, kind="stable")
    by_rule, places = rule[order], begin[order]
    owner = some[who[inside]]
    i, j = np.searchsorted(by_rule, owner), np.searchsorted(by_rule, owner, "right")
    many = j - i
    piece = np.repeat(np.arange(len(owner)), many)
    to = places[i[piece] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)] - low[who[inside]][piece]
    start = np.concatenate([start[inside][piece] + to, start[~inside]])
    end = np.concatenate([end[inside][piece] + to, end[~inside]])
    q = np.concatenate([q[inside][piece], q[~inside]])
    if not len(q):
        return none
    text = np.searchsorted(first, start, "right") - 1
    # runs of one period overlap by less than it: what overlaps by more is one run
    order = np.lexsort((start, q, text))
    text, start, end, q = text[order], start[order], end[order], q[order]
    span = len(ids) + 1
    group = np.concatenate([[0], np.cumsum((text[1:] != text[:-1]) | (q[1:] != q[:-1]))])
    reach = np.maximum.accumulate(group * span + end) - group * span
    new = np.ones(len(q), bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] > reach[:-1] - q[1:])
    edge = np.flatnonzero(new)
    text, start, q, end = text[edge], start[edge], q[edge], np.maximum.reduceat(end, edge)
    order = np.lexsort((q, start, text))
    return text[order], (start - first[text])[order], (end - start)[order], q[order]


def _repeating(w: wd.Words) -> np.ndarray:
    """The texts in which LEAST / 2 neighbouring words come twice."""
    k = LEAST // 2
    count = np.diff(w.first)
    h = wd.runs(w.hash, k)
    if not len(h):
        return np.zeros(0, np.int64)
    # windows within one text
    at = np.flatnonzero(w.text[: len(h)] == w.text[k - 1 :])
    h, text = h[at] ^ wd.mix(w.text[at].astype(np.uint64)), w.text[at]
    order = np.argsort(h)
    h, text = h[order], text[order]
    twice = np.zeros(len(count), bool)
    twice[text[1:][h[1:] == h[:-1]]] = True
    return np.flatnonzero(twice)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (start, length, period by start and period), collapsed of every row of ``docs`` (doc_id, text).

    A word is a run of bytes other than space and tab to carriage return, compared as it is;
    starts count words from 0. ``collapsed`` has the words that no run contains after its
    first period, joined by one space. Null, empty and blank texts have no words, no run
    and an empty ``collapsed``. Texts of any length are compressed whole. Repeated rows come back
    each; doc_id may be null. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wd.slices(batches):
            w = wd.words(part.data, part.offs, _SAME_CASE)
            n_texts = part.batch.num_rows
            chosen = _repeating(w)
            count = np.diff(w.first)[chosen]
            first = np.concatenate([[0], np.cumsum(count)])
            at = np.repeat(w.first[chosen] - first[:-1], count) + np.arange(first[-1])
            text, start, length, period = find_runs(_dense(w.hash[at])[0], first)
            text = chosen[text] if len(text) else text
            # words that fall out, by the places where such stretches begin and end
            gone = np.zeros(len(w.hash) + 1, np.int64)
            np.add.at(gone, w.first[text] + start + period, 1)
            np.add.at(gone, w.first[text] + start + length, -1)
            keep = np.cumsum(gone)[:-1] == 0
            raw, offs = part.data.tobytes(), part.offs.tolist()
            has = np.zeros(n_texts, bool)
            has[text] = True
            collapsed = []
            for t in range(n_texts):
                own = raw[offs[t] : offs[t + 1]].split()
                if has[t]:
                    own = [x for x, k in zip(own, keep[w.first[t] : w.first[t + 1]].tolist(), strict=True) if k]
                collapsed.append(b" ".join(own))
            begin = np.searchsorted(text, np.arange(n_texts + 1)).astype(np.int32)
            spans = pa.StructArray.from_arrays(
                [pa.array(x.astype(np.int64)) for x in (start, length, period)], names=["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [part.batch.column(0), pa.ListArray.from_arrays(pa.array(begin), spans), pa.array(collapsed, pa.binary()).cast(pa.string())],
                names=["doc_id", "runs", "collapsed"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
