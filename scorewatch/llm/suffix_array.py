"""Suffix arrays by prefix doubling, and permuted longest common prefixes.

Suffixes are ordered by as many symbols as fit into one number, then by twice as many in each round. A
round sorts only the suffixes that are still equal to another, all with one array operation.
"""

from __future__ import annotations

import numpy as np


def _first_keys(text: np.ndarray, symbols: int) -> tuple[np.ndarray, int]:
    """The first symbols of every suffix as one number, and how many these are."""
    bits = max(1, (symbols - 1).bit_length())
    size = 63 // bits
    padded = np.concatenate([text, np.zeros(size - 1, np.int64)])
    keys = np.zeros(len(text), np.int64)
    for k in range(size):
        keys = (keys << bits) | padded[k : k + len(text)]
    return keys, size


def _firsts(keys: np.ndarray) -> np.ndarray:
    """True where a run of equal keys starts."""
    return np.concatenate([[True], keys[1:] != keys[:-1]])


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of all suffixes in order. ``text`` ends with 0, which occurs nowhere else."""
    n = len(text)
    keys, size = _first_keys(text.astype(np.int64), symbols)
    order = np.argsort(keys)
    rank = np.empty(n, np.int64)
    places, some, keys = np.arange(n), order, keys[order]
    while True:
        # A suffix has the first place of those that are equal so far as its rank.
        first = _firsts(keys)
        rank[some] = np.maximum.accumulate(np.where(first, places, 0))
        shared = np.flatnonzero(~(first & np.concatenate([first[1:], [True]])))
        if not len(shared):
            return order
        places, some = places[shared], some[shared]
        # Equal suffixes do not reach the last symbol, so something follows.
        keys = rank[some] * n + rank[some + size]
        by = np.argsort(keys)
        some, keys = some[by], keys[by]
        order[places] = some
        size *= 2


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Permuted common prefixes: for each text position, with the suffix before it in the order.

    A position whose left neighbour equals that of the suffix before it continues the prefix found one
    position earlier, shorter by one. Only the others are compared, eight symbols at a time.
    """
    n = len(text)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    padded = np.zeros(n + 8, np.uint16)
    padded[:n] = text
    at = np.arange(n)
    own = np.maximum(before, 0)
    starts = (before <= 0) | (at == 0) | (text[np.maximum(at - 1, 0)] != text[np.maximum(own - 1, 0)])
    a = np.flatnonzero(starts & (before >= 0))
    b = before[a]
    low = padded.astype(np.uint64)
    words = low[:n].copy()
    for k in range(1, 4):
        words |= low[k : n + k] << np.uint64(16 * k)
    length = np.zeros(n, np.int64)
    left = np.arange(len(a))
    offset = 0
    while len(left):
        x, y = a[left] + offset, b[left] + offset
        inside = (x < n) & (y < n)
        differ = np.where(inside, words[np.minimum(x, n - 1)] ^ words[np.minimum(y, n - 1)], np.uint64(1))
        lowest = differ & (~differ + np.uint64(1))
        ended = differ != 0
        more = (np.log2(lowest[ended].astype(np.float64)).astype(np.int64)) >> 4
        length[a[left[ended]]] = offset + more
        left = left[~ended]
        offset += 4
    reach = np.where(starts, length + at, -1)
    # Positions after a start without a predecessor begin a chain of their own.
    last = np.maximum.accumulate(np.where(starts, at, 0))
    return np.maximum(reach[last] - at, 0)
