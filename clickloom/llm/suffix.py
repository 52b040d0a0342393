"""Difference-cover suffix sorting (period 3) of an integer sequence, all in array operations.

Triples at positions 1 and 2 modulo 3 are sorted and named; if names repeat, the sequence of
names is sorted by recursion; the remaining suffixes are sorted by (symbol, rank of the next
suffix) and merged. Comparing a remaining suffix with a sampled one takes at most two symbols
and a rank, so every merge position is one binary search over 64-bit keys.
"""

from __future__ import annotations

import numpy as np


def _ranks(key: np.ndarray) -> np.ndarray:
    """Dense ranks (from 1) of uint64 keys."""
    order = np.argsort(key)
    ordered = key[order]
    names = np.empty(len(key), np.uint64)
    names[order] = np.cumsum(np.concatenate([[1], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
    return names


def _order(key: np.ndarray, bits: int) -> np.ndarray:
    """The order of keys under 2**bits; with the places packed below the keys where both fit, as plain sorts are the faster ones."""
    low = len(key).bit_length()
    if bits + low > 64:
        return np.argsort(key)
    packed = (key << np.uint64(low)) | np.arange(len(key), dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << low) - 1)).astype(np.int64)


def _joined(columns: list[np.ndarray], bits: int) -> np.ndarray:
    """One key for columns of values under 2**bits (32 at most) that compares as they do: packed, or ranked where that needs over 64 bits."""
    key, width = columns[0], bits
    for column in columns[1:]:
        if width + bits > 64:
            key = _ranks(key)
            width = int(len(key)).bit_length()
        key, width = (key << np.uint64(bits)) | column, width + bits
    return key


def _names(triple: list[np.ndarray], base: int) -> np.ndarray:
    """Dense ranks (from 1) of triples of symbols under base, given as three columns."""
    if base**3 > 1 << 25:
        return _ranks(_joined(triple, (base - 1).bit_length()))
    # Few triples are possible: they are ranked by a table of those that occur.
    key = ((triple[0] * np.uint64(base) + triple[1]) * np.uint64(base) + triple[2]).astype(np.int64)
    seen = np.zeros(base**3, bool)
    seen[key] = True
    return np.cumsum(seen, dtype=np.int32)[key].astype(np.uint64)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of symbols (each from 1 up to 2**32 - 2) in lexicographic order."""
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: tuple(symbols[i:])), np.int64)
    s = np.zeros(n + 3, np.uint64)
    s[:n] = symbols
    # One extra position of padding where n is 1 modulo 3 keeps the two sampled classes apart.
    n_ones, n_twos, n_zeros = (n + 1) // 3 + (n % 3 == 1), n // 3, (n + 2) // 3
    third = [s[k : k + 3 * n_zeros : 3] for k in range(3)] + [s[3::3], s[4::3]]
    triple = [np.concatenate([third[1 + k][:n_ones], third[2 + k][:n_twos]]) for k in range(3)]
    names = _names(triple, int(s.max()) + 1)
    if int(names.max()) < len(names):
        order = suffix_array(names)
        rank_of = np.empty(len(names), np.uint64)
        rank_of[order] = np.arange(1, len(names) + 1, dtype=np.uint64)
    else:
        order, rank_of = _order(names, int(len(names)).bit_length()), names
    rank = np.zeros(n + 3, np.uint64)
    rank[1::3][:n_ones], rank[2::3][:n_twos] = rank_of[:n_ones], rank_of[n_ones:]
    in1 = order < n_ones
    sampled = np.where(in1, 3 * order + 1, 3 * (order - n_ones) + 2)
    bits, low = int(s.max()).bit_length(), len(names).bit_length()
    # A remaining suffix is compared with one of either class by a symbol, or two, and a rank.
    key0 = (third[0][:n_zeros] << np.uint64(low)) | rank[1::3][:n_zeros]
    by_key = _order(key0, bits + low)
    key0, zeros = key0[by_key], 3 * by_key
    one, two = sampled[in1], sampled[~in1]
    one = one[one < n]
    key1 = (s[one] << np.uint64(low)) | rank[one + 1]
    pair = (s[:-1] << np.uint64(bits)) | s[1:]
    pair0, pair2 = pair[zeros], pair[two]
    # The pairs of symbols are ranked first where the three do not fit into 64 bits.
    if 2 * bits + low > 64:
        both, low = _ranks(np.concatenate([pair0, pair2])), 32
        pair0, pair2 = both[: len(zeros)], both[len(zeros) :]
    pair0 = (pair0 << np.uint64(low)) | rank[zeros + 2]
    pair2 = (pair2 << np.uint64(low)) | rank[two + 2]
    out = np.empty(n, np.int64)
    at_zero = np.arange(n_zeros) + np.searchsorted(key1, key0) + np.searchsorted(pair2, pair0)
    free = np.ones(n, bool)
    free[at_zero] = False
    out[at_zero] = zeros
    out[free] = sampled[sampled < n]
    return out


def equal_windows(data: np.ndarray, order: np.ndarray, width: int) -> np.ndarray:
    """For suffixes in order, a group number that changes where the first width bytes of neighbours differ."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.zeros(len(data), np.uint64)
    for k in range(8):
        words |= padded[k : k + len(data)].astype(np.uint64) << np.uint64(8 * k)
    offsets = [*range(0, width - 7, 8)] + ([width - 8] if width % 8 else [])
    differ = np.zeros(max(len(order) - 1, 0), bool)
    for k in offsets:
        column = words[order + k]
        differ |= column[1:] != column[:-1]
    return np.concatenate([[0], np.cumsum(differ)]) if len(order) else np.zeros(0, np.int64)
