"""Signature trees over sets of hashed tokens, and a self join of their leaves by dual traversal."""

from __future__ import annotations

import numpy as np

BITS = 4096
FANOUT = 4
#: Node pairs that are looked at together.
FRONT = 4096


class UnionFind:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = self.parent[k]
        return k

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted sets."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    common = int((y[at] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


class SignatureTree:
    """Levels of nodes; a node holds the OR of its leaves' bitmaps, their sizes and bit collisions.

    Leaves are ordered by their smallest tokens, so similar sets are neighbours and share nodes.
    """

    def __init__(self, sets: list[np.ndarray]):
        n = len(sets)
        sizes = np.array([len(s) for s in sets], np.int64)
        bits = np.zeros((n, BITS // 64), np.uint64)
        for k, s in enumerate(sets):
            at = s % np.uint64(BITS)
            np.bitwise_or.at(bits[k], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        lost = sizes - np.bitwise_count(bits).sum(1).astype(np.int64)
        self.levels = [(bits, sizes, sizes, lost)]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, lost = self.levels[-1]
            starts = np.arange(0, len(low), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, starts, axis=0), np.minimum.reduceat(low, starts),
                    np.maximum.reduceat(high, starts), np.maximum.reduceat(lost, starts),
                )
            )

    def possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Node pairs in which some two sets may still be linked.

        Common tokens lie on common bits, and on one bit a set has at most one token more than it has
        collisions; so the overlap is at most the common bits plus the collisions, and at most the
        larger size on either side.
        """
        bits, low, high, lost = self.levels[level]
        least = low[a] + low[b]
        most = np.minimum(high[a], high[b])
        fits = (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a])
        fits &= (100 + percent) * most >= percent * least
        at = np.flatnonzero(fits)
        if len(at):
            common = np.bitwise_count(bits[a[at]] & bits[b[at]]).sum(1).astype(np.int64)
            common += np.minimum(lost[a[at]], lost[b[at]])
            fits[at] = (100 + percent) * common >= percent * least[at]
        return fits


def join_groups(sets: list[np.ndarray], percent: int) -> list[int]:
    """Smallest index that each set reaches by links; equal-sized work for one block of sets.

    The traversal starts with the root against itself and goes down through the children of the node
    pairs that may hold a link. Leaf pairs are verified on the sets. A pair of nodes whose leaves are
    all in one group already is left out, as a link there changes nothing.
    """
    n = len(sets)
    order = sorted(range(n), key=lambda k: (sets[k][:2].tolist(), len(sets[k])))
    own = [sets[k] for k in order]
    groups = UnionFind(n)
    for k in range(n - 1):
        if linked(own[k], own[k + 1], percent):
            groups.join(k, k + 1)
    if n > 2:
        _traverse(SignatureTree(own), own, groups, percent)
    least: dict[int, int] = {}
    for k in range(n):
        root = groups.find(k)
        least[root] = min(least.get(root, n), order[k])
    out = [0] * n
    for k in range(n):
        out[order[k]] = least[groups.find(k)]
    return out


def _labels(tree: SignatureTree, groups: UnionFind) -> list[tuple[np.ndarray, np.ndarray]]:
    """Smallest and largest group of the leaves of every node."""
    low = np.array([groups.find(k) for k in range(len(tree.levels[0][1]))])
    out = [(low, low)]
    for _ in tree.levels[1:]:
        low, high = out[-1]
        starts = np.arange(0, len(low), FANOUT)
        out.append((np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))
    return out


def _traverse(tree: SignatureTree, sets: list[np.ndarray], groups: UnionFind, percent: int) -> None:
    top = len(tree.levels) - 1
    labels = _labels(tree, groups)
    work = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while work:
        level, a, b = work.pop()
        if len(a) > FRONT:
            work += [(level, a[k : k + FRONT], b[k : k + FRONT]) for k in range(0, len(a), FRONT)]
            continue
        low, high = labels[level]
        same = (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
        a, b = a[~same], b[~same]
        fits = tree.possible(level, a, b, percent) | ((a == b) & (level > 0))
        a, b = a[fits], b[fits]
        if level == 0:
            changed = False
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                if groups.find(i) != groups.find(j) and linked(sets[i], sets[j], percent):
                    changed |= groups.join(i, j)
            if changed and work:
                labels = _labels(tree, groups)
            continue
        steps = np.arange(FANOUT)
        below = len(tree.levels[level - 1][1])
        i = np.repeat(a[:, None] * FANOUT + steps, FANOUT, axis=1).ravel()
        j = np.tile(b[:, None] * FANOUT + steps, (1, FANOUT)).ravel()
        ok = (i < below) & (j < below) & ((i < j) | ((i == j) & (level > 1)))
        ok |= (np.repeat(a != b, FANOUT * FANOUT)) & (i < below) & (j < below)
        work.append((level - 1, i[ok], j[ok]))
