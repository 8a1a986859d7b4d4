"""Words, shingles and hashes of whole Arrow batches of texts, in numpy.

A word is a run of bytes other than space and tab to carriage return, A-Z in lower
case. All functions work on the flat bytes of a slice of texts, so no Python loop
runs over words or characters. Hashes have 64 bits: two different words or shingles
among a billion meet with a chance of about 3 in 100.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
#: bytes whose sums are made at once, so that they stay in a core's cache
BLOCK = 1 << 14

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit value for each value."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Slice(NamedTuple):
    batch: pa.RecordBatch
    data: np.ndarray  # bytes of all texts of the slice
    offs: np.ndarray  # where each text begins; one more for the end


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[Slice]:
    """Each batch in slices of half a megabyte of text, so that memory does not depend on lengths."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offs = flat(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offs, offs[start] + SLICE_BYTES, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            part = offs[start : stop + 1]
            yield Slice(batch.slice(start, stop - start), data[part[0] : part[-1]], part - part[0])
            start = stop
        del data, offs
    pa.default_memory_pool().release_unused()


class Words(NamedTuple):
    start: np.ndarray  # byte where each word begins
    end: np.ndarray  # and ends
    text: np.ndarray  # index of its text, ascending
    hash: np.ndarray
    first: np.ndarray  # index of each text's first word; one more for the end


def lines(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each line begins (one more for the end), its text, and its number in the text from 0.

    An empty text, and what follows a last line break, has no line.
    """
    ends = np.flatnonzero(data == 10)
    text = np.searchsorted(offs, ends, "right") - 1
    more = ends + 1 < offs[text + 1]
    start = np.sort(np.concatenate([offs[:-1][np.diff(offs) > 0], ends[more] + 1]))
    text = np.searchsorted(offs, start, "right") - 1
    before = np.searchsorted(ends, start) - np.searchsorted(ends, offs[text])
    return np.append(start, len(data)), text, before


def words(data: np.ndarray, offs: np.ndarray, table: np.ndarray = _LOWER) -> Words:
    """``table`` maps bytes to bytes before anything else."""
    n, texts = len(data), len(offs) - 1
    low = data.tobytes().translate(table.tobytes())
    space = np.frombuffer(low.translate(_SPACE.tobytes()), bool)
    low = np.frombuffer(low, np.uint8)
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    begins, ends = offs[:-1][offs[:-1] < n], offs[1:][offs[1:] > 0] - 1
    before[begins] = True
    after[ends] = True
    start = np.flatnonzero(before > space)
    end = np.flatnonzero(after > space) + 1
    first = np.searchsorted(start, offs)
    power, sums = _power(_BASE, n), np.zeros(n + 1, np.uint64)
    for at in range(0, n, BLOCK):
        term = low[at : at + BLOCK].astype(np.uint64)
        term += np.uint64(1)
        term *= power[at : at + BLOCK]
        term[:1] += sums[at]
        np.cumsum(term, out=sums[at + 1 : at + 1 + BLOCK])
    h = (sums[end] - sums[start]) * _power(_UNBASE, n + 1)[start]
    h = mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return Words(start, end, np.repeat(np.arange(texts), np.diff(first)), h, first)


def sequences(h: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of the values first .. last - 1 of each unit, in order."""
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _power(_BASE, len(h)), out=total[1:])
    out = (total[last] - total[first]) * _power(_UNBASE, len(h) + 1)[first]
    return mix(out + (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k neighbouring values, in order; k - 1 fewer than values."""
    n = max(len(h) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out *= np.uint64(0xFF51AFD7ED558CCD)
        out += h[i : i + n]
    return mix(out + np.uint64(k))


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each unit, and where each unit's begin.

    A unit with fewer words has its whole sequence as one shingle; one without
    words has none.
    """
    count = np.diff(first)
    size = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    begin = np.concatenate([[0], np.cumsum(size)])
    unit = np.repeat(np.arange(len(count)), size)
    at = first[:-1][unit] + np.arange(begin[-1]) - begin[:-1][unit]
    full = runs(h, k)
    out = np.zeros(begin[-1], np.uint64)
    whole = count[unit] >= k
    out[whole] = full[at[whole]]
    for n in range(1, k):
        short = count[unit] == n
        if short.any():
            out[short] = runs(h, n)[at[short]]
    return out, begin


def distinct(h: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each unit, ascending, and where each unit's begin."""
    h = h.copy()
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        if b - a > 1:
            h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = h[1:] != h[:-1]
    keep[begin[:-1][begin[:-1] < len(h)]] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    return h[keep], total[begin]


def sums(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The wrapped sum of each unit's values."""
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h, out=total[1:])
    return total[begin[1:]] - total[begin[:-1]]


def binaries(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """Each unit's values as one binary value."""
    offs = (begin * values.itemsize).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(begin) - 1, [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())]
    ).cast(pa.binary())


def lists(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """Each unit's values as one list of longs."""
    return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values.view(np.int64)))
