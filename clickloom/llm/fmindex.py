"""An FM-index over an integer text: Burrows-Wheeler transform in a wavelet matrix, backward search.

Every query walks in step with all others of its batch, so that one step is a few array operations.
"""

from __future__ import annotations

import numpy as np

from .suffix import suffix_array


class Bits:
    """A bit vector with constant-time rank: 64-bit words and a running count for each."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(packed) // 8 + 2, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each position i."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Counts occurrences of patterns in a text of symbols from 1 to sigma (0 ends the text)."""

    def __init__(self, text: np.ndarray, sigma: int):
        order = suffix_array(text)
        last = np.zeros(len(text) + 1, np.int64)  # the row of the empty suffix comes first
        last[0] = text[-1] if len(text) else 0
        last[1:] = np.where(order > 0, text[order - 1], 0)
        self.size = len(last)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(last, minlength=sigma + 2))])
        self.bits: list[Bits] = []
        self.zeros: list[int] = []
        for level in range(max(1, int(sigma).bit_length()) - 1, -1, -1):
            bit = (last >> level) & 1 == 1
            self.bits.append(Bits(bit))
            self.zeros.append(int((~bit).sum()))
            last = np.concatenate([last[~bit], last[bit]])
        self.levels = len(self.bits)

    def step(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of symbol + pattern, from those of the patterns."""
        start = np.zeros(len(low), np.int64)
        for k, bits in enumerate(self.bits):
            one = (symbol >> (self.levels - 1 - k)) & 1 == 1
            a, b, c = bits.rank(low), bits.rank(high), bits.rank(start)
            low = np.where(one, self.zeros[k] + a, low - a)
            high = np.where(one, self.zeros[k] + b, high - b)
            start = np.where(one, self.zeros[k] + c, start - c)
        first = self.before[symbol]
        return first + low - start, first + high - start


def occurrences(index: FMIndex, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How often each pattern text[start : start + length] occurs in the index, once under two counted as it is left."""
    query = np.argsort(-lengths, kind="stable")
    low, high = np.zeros(len(query), np.int64), np.full(len(query), index.size, np.int64)
    out = np.full(len(query), index.size, np.int64)
    done = np.zeros(len(query), np.int64)
    while len(query):
        going = done < lengths[query]
        if not going.all():
            out[query[~going]] = (high - low)[~going]
            query, low, high, done = query[going], low[going], high[going], done[going]
            continue
        low, high = index.step(low, high, text[starts[query] + lengths[query] - 1 - done])
        done += 1
        few = high - low < 2
        if few.any():
            out[query[few]] = (high - low)[few]
            query, low, high, done = query[~few], low[~few], high[~few], done[~few]
    return out


def repeated_windows(index: FMIndex, text: np.ndarray, starts: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """Which windows of the queries occur at least twice in the index.

    Query k has counts[k] windows of width symbols, at text[starts[k]], text[starts[k] + 1] and so on. The matching
    statistic of a window's end is the longest suffix of the window that still occurs twice; where
    it falls short of width, no window that holds one symbol more can repeat, so the query moves on
    past that symbol. Returns one flag a window, queries in order.
    """
    base = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(base[-1], bool)
    query = np.flatnonzero(counts > 0)
    at = np.zeros(len(query), np.int64)  # the window under test
    length = np.zeros(len(query), np.int64)  # symbols matched, from its end
    low = np.zeros(len(query), np.int64)
    high = np.full(len(query), index.size, np.int64)
    while len(query):
        symbol = text[starts[query] + at + width - 1 - length]
        low, high = index.step(low, high, symbol)
        failed = high - low < 2
        length += ~failed
        full = length == width
        out[base[query[full]] + at[full]] = True
        ended = failed | full
        at = np.where(failed, at + width - length, at + full)
        length[ended], low[ended], high[ended] = 0, 0, index.size
        going = at < counts[query]
        query, at, length, low, high = query[going], at[going], length[going], low[going], high[going]
    return out
