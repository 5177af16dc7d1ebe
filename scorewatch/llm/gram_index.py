"""Variable-length grams of words: decomposition, affected-gram bounds and list merging, in numpy.

A word is read between two end marks. The gram that starts at a position is the shortest run of at least
``SHORTEST`` characters that is not in the dictionary of frequent grams, or of ``LONGEST`` characters, or up
to the end. It depends on its own characters alone, so one edit at a position changes only the grams over
that position; all others stay, moved by one place at most behind the edit. The largest number of grams over
one position is the word's affected-gram bound: two words within one edit share at least all grams of either
but so many. The bound of two grams that do not overlap is one, so such a pair is enough to look a word up: one
of the two is in the other word's list at about the same place.

Words are rows of a matrix of Latin-1 bytes (all letters of the words fit), padded with zeros.
"""

from __future__ import annotations

import numpy as np

SHORTEST = 2
#: At most 7: a gram then fits a 64-bit number, and a word of 7 letters has two grams that do not overlap.
LONGEST = 7
START, END = 1, 2
#: Words are looked up by grams that start before this place.
WINDOW = 24
SKETCH_BITS = 4

_MIX = np.uint64(0x9E3779B97F4A7C15)


def matrix_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words between their marks as padded rows, and the rows' lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    width = int(lengths.max(initial=2))
    rows = np.zeros((len(words), width), np.uint8)
    data = np.frombuffer(b"".join(words), np.uint8)
    row = np.repeat(np.arange(len(words)), lengths - 2)
    starts = np.cumsum(lengths - 2) - (lengths - 2)
    rows[row, np.arange(len(data)) - np.repeat(starts, lengths - 2) + 1] = data
    rows[:, 0] = START
    rows[np.arange(len(words)), lengths - 1] = END
    return rows, lengths


def gram_codes(rows: np.ndarray, size: int) -> np.ndarray:
    """The gram of ``size`` characters from every position as a number; the length is its highest byte."""
    wide = rows.astype(np.uint64)
    n = rows.shape[1] - size + 1
    out = np.full((len(rows), max(n, 0)), np.uint64(size) << np.uint64(56))
    for k in range(size if n > 0 else 0):
        out |= wide[:, k : k + n] << np.uint64(8 * k)
    return out


def all_grams(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Codes of all grams of ``SHORTEST`` to ``LONGEST`` characters of the words."""
    found = []
    for size in range(SHORTEST, LONGEST + 1):
        codes = gram_codes(rows, size)
        found.append(codes[np.arange(codes.shape[1])[None, :] + size <= lengths[:, None]])
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def frequency_of(codes: np.ndarray, dictionary: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Count of each gram in the dictionary (sorted codes), 0 for others."""
    if not len(dictionary):
        return np.zeros(codes.shape, np.int64)
    at = np.minimum(np.searchsorted(dictionary, codes), len(dictionary) - 1)
    return np.where(dictionary[at] == codes, counts[at], 0)


def decompose(rows: np.ndarray, lengths: np.ndarray, dictionary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram from every start, its size, affected-gram bound of the word); starts without a gram hold 0.

    ``dictionary`` has the sorted codes of the frequent grams.
    """
    known = np.ones(len(dictionary), np.int64)
    n_words, width = rows.shape
    starts = np.arange(width)[None, :]
    grams = np.zeros((n_words, width), np.uint64)
    sizes = np.zeros((n_words, width), np.int64)
    open_ = starts + SHORTEST <= lengths[:, None]
    for size in range(SHORTEST, LONGEST + 1):
        codes = gram_codes(rows, size)
        w = codes.shape[1]
        fits = open_[:, :w] & (starts[:, :w] + size <= lengths[:, None])
        grams[:, :w] = np.where(fits, codes, grams[:, :w])
        sizes[:, :w] = np.where(fits, size, sizes[:, :w])
        longer = np.zeros_like(open_)
        longer[:, :w][fits] = frequency_of(codes[fits], dictionary, known) > 0
        open_ = longer
    edges = np.zeros((n_words, width + 1), np.int64)
    held = sizes > 0
    edges[:, :width] += held
    row, start = np.nonzero(held)
    np.subtract.at(edges, (row, start + sizes[row, start]), 1)
    return grams, sizes, np.cumsum(edges, axis=1).max(axis=1)


def two_apart(sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Starts before ``WINDOW`` of two grams of every word that do not overlap, those of the least weight together.

    Every word has two: the gram at its start has at most seven characters, the last one two.
    """
    sizes, weights = sizes[:, :WINDOW], weights[:, :WINDOW]
    n_words, width = sizes.shape
    starts = np.arange(width)
    # The best gram that ends at or before each place, by weight and start in one number.
    packed = weights * width + starts[None, :]
    best = np.full((n_words, width + LONGEST), np.iinfo(np.int64).max // 4)
    row, start = np.nonzero(sizes > 0)
    np.minimum.at(best, (row, start + sizes[row, start]), packed[row, start])
    best = np.minimum.accumulate(best, axis=1)[:, :width]
    second = np.where(sizes > 0, best // width + weights, np.iinfo(np.int64).max // 4).argmin(axis=1)
    first = best[np.arange(n_words), second] % width
    return np.stack([first, second], axis=1)


def common_grams(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Grams of words ``a`` that words ``b`` have at the same start or one later: an upper bound of those kept."""
    ours, theirs = grams[a], grams[b]
    later = np.zeros_like(theirs)
    later[:, :-1] = theirs[:, 1:]
    return (((ours == theirs) | (ours == later)) & (ours != 0)).sum(axis=1)


def pair_sketch(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64 bits per word: for each bit, whether the word has an odd number of the two-letter grams that fall on it.

    One edit takes away and adds at most two such grams, so it changes at most ``SKETCH_BITS`` bits.
    """
    bits = np.uint64(1) << ((gram_codes(rows, 2) * _MIX) >> np.uint64(58))
    bits[np.arange(bits.shape[1])[None, :] + 2 > lengths[:, None]] = 0
    return np.bitwise_xor.reduce(bits, axis=1)


def one_edit_apart(rows: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact test of pairs; words ``b`` are as long as words ``a`` or one character longer."""
    left, right = rows[a], rows[b]
    differ = left != right
    same_length = lengths[a] == lengths[b]
    replaced = same_length & (differ.sum(axis=1) == 1)
    # One character more: up to the first difference both agree, behind it they agree shifted by one.
    shifted = np.zeros_like(right)
    shifted[:, :-1] = right[:, 1:]
    places = np.arange(rows.shape[1])[None, :]
    behind = places >= differ.argmax(axis=1)[:, None]
    wrong = (left != shifted) & behind & (places < lengths[a][:, None])
    inserted = (lengths[b] == lengths[a] + 1) & ~wrong.any(axis=1)
    return replaced | inserted


def _candidates(keys: np.ndarray, left: np.ndarray, chunk: int):
    """Pairs of a word looked up in a list and a word of the list, as indexes into the sorted entries, in chunks."""
    looked, held = np.flatnonzero(left), np.flatnonzero(~left)
    firsts = np.searchsorted(keys[held], keys[looked], "left")
    sizes = np.searchsorted(keys[held], keys[looked], "right") - firsts
    ends = np.cumsum(sizes)
    done = 0
    while done < len(looked):
        before = ends[done - 1] if done else 0
        upto = max(int(np.searchsorted(ends, before + chunk, "right")), done + 1)
        part = slice(done, upto)
        n = int(ends[upto - 1] - before)
        shift = firsts[part] - (ends[part] - sizes[part] - before)
        yield np.repeat(looked[part], sizes[part]), held[np.repeat(shift, sizes[part]) + np.arange(n)]
        done = upto


def merge_lists(
    keys: np.ndarray, left: np.ndarray, word: np.ndarray, rows: np.ndarray, lengths: np.ndarray,
    dictionary: np.ndarray, chunk: int = 1 << 18, cells: int = 1 << 21,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words one edit apart among the entries of the lists ``keys``; (a, b) as indexes into ``rows``.

    An entry belongs to a list as a word that is looked up there (``left``) or as a word that has the gram;
    ``word`` is its row, and rows are in the order of the words. The lists looked up give candidates. A candidate stays if its two-letter grams allow
    one edit; then the other lists are probed, and it stays if the words share at least as many grams as the
    bounds of both leave. What stays is tested exactly. About ``chunk`` candidates are held at a time, of which
    those left are read in parts of ``cells`` characters.
    """
    order = np.argsort(keys, kind="stable")
    keys, left, word = keys[order], left[order], word[order]
    grams, sizes, bounds = decompose(rows, lengths, dictionary)
    least = (sizes > 0).sum(axis=1) - bounds
    sketch = pair_sketch(rows, lengths)[word]
    step = max(cells // rows.shape[1], 1)
    found_a, found_b = [], []
    for at_a, at_b in _candidates(keys, left, chunk):
        near = np.bitwise_count(sketch[at_a] ^ sketch[at_b]) <= SKETCH_BITS
        all_a, all_b = word[at_a[near]], word[at_b[near]]
        # Of two words of one length it is enough to look up the first.
        fit = (lengths[all_b] > lengths[all_a]) | (all_a < all_b)
        all_a, all_b = all_a[fit], all_b[fit]
        for start in range(0, len(all_a), step):
            a, b = all_a[start : start + step], all_b[start : start + step]
            fit = common_grams(grams, a, b) >= np.maximum(least[a], least[b])
            a, b = a[fit], b[fit]
            fit = one_edit_apart(rows, lengths, a, b)
            found_a.append(a[fit])
            found_b.append(b[fit])
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.stack([np.concatenate(found_a), np.concatenate(found_b)]), axis=1)
    return pairs[0], pairs[1]
