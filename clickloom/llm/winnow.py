"""Exact partition of all fixed-length windows of a text by their minimal q-gram hash.

Equal windows have equal minima, so windows with different minima can never be equal: grouping
by the minimum brings all copies of a window together, at about one row for every half window
instead of one row a position. Consecutive windows whose first minimum is the same occurrence form
one *run*; the text of a run (its *context*) holds exactly the windows of that run, all different.
"""

from __future__ import annotations

import numpy as np

from .common import mix64

_MULT = [np.uint64(k * 2 + 1) for k in np.random.default_rng(11).integers(2**61, 2**62, 16)]
_BASE = np.uint64(0x5851F42D4C957F2D)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the words up to each document's end."""
    inside = ~_SEPARATOR[data]
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
        firsts = np.concatenate([[0], ends[:-1]])
        before[firsts[firsts < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    if len(data):
        after[-1] = False
        after[:-1] = inside[1:]
        after[ends[ends > 0] - 1] = False
    stops = np.flatnonzero(inside & ~after) + 1
    return starts, stops, np.searchsorted(starts, ends)


def span_hashes(units: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span of units, from one running sum over them."""
    power = np.full(len(units) + 1, _BASE)
    power[:1] = 1
    np.multiply.accumulate(power, out=power)
    total = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    inverse = np.uint64(pow(int(_BASE), -1, 2**64))
    unpower = np.full(len(units) + 1, inverse)
    unpower[:1] = 1
    np.multiply.accumulate(unpower, out=unpower)
    return mix64((total[stops] - total[starts]) * unpower[starts] + (stops - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word."""
    return span_hashes(data, starts, stops)


def mixed_grams(units: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every gram of units."""
    h, n, k = units.astype(np.uint64), 1, 0
    h += np.uint64(1)
    while n < gram:
        step = min(n, gram - n)
        h = h[:-step] * _MULT[k] + h[step:]
        h ^= h >> np.uint64(29)
        n, k = n + step, k + 1
    return mix64(h)


def _minima(units: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The minimal gram hash of each window of units, and whether it is that of the window's first gram."""
    h = mixed_grams(units, gram)
    width = window - gram + 1
    low, w = h, 1
    while w * 2 <= width:
        low, w = np.minimum(low[:-w], low[w:]), w * 2
    if w < width:
        low = np.minimum(low[: len(h) - width + 1], low[width - w :])
    return low, h[: len(low)] == low


#: Windows whose hashes are made at a time, so that they stay in a core's cache.
_BLOCK = 1 << 15


def runs(units: np.ndarray, ends: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimum, first window, one past the last window) of each run over units of documents that end at ends.

    A window never crosses a document's end.
    """
    none = np.zeros(0, np.int64)
    if len(units) < window:
        return np.zeros(0, np.uint64), none, none
    count = len(units) - window + 1
    low, own = np.empty(count, np.uint64), np.empty(count, bool)
    for at in range(0, count, _BLOCK):
        stop = min(at + _BLOCK, count)
        low[at:stop], own[at:stop] = _minima(units[at : stop + window - 1], window, gram)
    lengths = np.diff(np.concatenate([[0], ends]))
    fits = lengths >= window
    # Valid window starts: all but the last window-1 of each document.
    mark = np.zeros(count + 1, np.int32)
    firsts = (ends - lengths)[fits]
    np.add.at(mark, firsts, 1)
    np.add.at(mark, np.minimum(ends[fits] - window + 1, count), -1)
    valid = np.cumsum(mark[:-1]) > 0
    turn = np.ones(count, bool)
    # A new minimum, or the first one just left: so a run's windows all hold one occurrence, and differ.
    turn[1:] = (low[1:] != low[:-1]) | own[:-1]
    turn[firsts] = True
    turn &= valid
    first = np.flatnonzero(turn)
    # A run ends where the next begins, or where its document has no further window.
    document = np.searchsorted(ends, first, side="right")
    stop = np.minimum(np.append(first[1:], count), ends[document] - window + 1)
    return low[first], first, stop
