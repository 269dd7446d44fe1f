"""A HAT-trie of n-gram counts: burstable hash containers under a shallow word-id trie.

Words are 64-bit ids, an n-gram is a row of n ids. A node of the trie cuts the
ids of one position into ranges; under each range hangs a container or, where a
range is one id only and its container has burst, a node of the next position.

A container buffers n-grams and hashes them together (one 64-bit hash a row)
when its buffer is full. With more than ``burst`` different n-grams it bursts: a
container over several ids is cut in two at its median id, one over a single id
becomes a node of the next position. Whole subtrees are taken out as sorted
runs (``spill``), the largest first, when the trie holds more than ``limit`` rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import mix

_MUL = np.uint64(0x9E3779B97F4A7C15)


def gram_hash(grams: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of ids."""
    h = np.zeros(len(grams), dtype=np.uint64)
    for c in range(grams.shape[1]):
        h = mix(h * _MUL + grams[:, c] + np.uint64(c + 1))
    return h


def summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows in ascending order of their ids, and the sum of each one's counts."""
    if not len(grams):
        return grams, counts
    order = np.lexsort(grams.T[::-1])
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]).any(axis=1)]))
    return grams[first], np.add.reduceat(counts, first)


class Container:
    """Hash container of the n-grams that fall into one range of ids."""

    def __init__(self, burst: int):
        self.burst, self.parts, self.rows, self.known = burst, [], 0, 0

    def add(self, grams: np.ndarray, counts: np.ndarray) -> bool:
        """Takes rows; tells whether the container has to burst."""
        self.parts.append((grams, counts))
        self.rows += len(grams)
        if self.rows <= self.burst + 2 * self.known:
            return False
        self._hash()
        return self.known > self.burst

    def _hash(self) -> None:
        grams, counts = self.take()
        _, first, at = np.unique(gram_hash(grams), return_index=True, return_inverse=True)
        self.parts = [(grams[first], np.bincount(at, counts, len(first)).astype(np.int64))]
        self.rows = self.known = len(first)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """All rows held, different or not; they stay."""
        if len(self.parts) > 1:
            self.parts = [(np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts]))]
        return self.parts[0]


class Node:
    """Ranges of the ids at one position: child i has the ids from ``bounds[i]`` to below ``bounds[i + 1]``."""

    def __init__(self, position: int, width: int, burst: int):
        self.position, self.width, self.burst = position, width, burst
        self.bounds, self.children = np.zeros(1, dtype=np.uint64), [Container(burst)]

    def add(self, grams: np.ndarray, counts: np.ndarray) -> None:
        to = np.searchsorted(self.bounds, grams[:, self.position], side="right") - 1
        order = np.argsort(to, kind="stable")
        cut = np.searchsorted(to[order], np.arange(len(self.children) + 1))
        full = []
        for i in np.flatnonzero(np.diff(cut)).tolist():
            rows, child = order[cut[i]:cut[i + 1]], self.children[i]
            if child.add(grams[rows], counts[rows]):
                full.append(i)
        for i in reversed(full):
            self._burst(i)

    def _burst(self, i: int) -> None:
        grams, counts = self.children[i].take()
        ids = np.sort(grams[:, self.position])
        low, high = ids[0], ids[-1]
        if low < high:
            middle = ids[len(ids) // 2] if ids[len(ids) // 2] > low else ids[np.searchsorted(ids, low, side="right")]
            parts, bounds = [grams[:, self.position] < middle, grams[:, self.position] >= middle], [middle]
            fresh: list = [Container(self.burst), Container(self.burst)]
        elif self.position + 1 < self.width:
            # the range is one id from now on, and ids beside it get ranges of their own
            upper = self.bounds[i + 1] if i + 1 < len(self.bounds) else None
            fresh, bounds, parts = [Node(self.position + 1, self.width, self.burst)], [], [np.ones(len(grams), dtype=bool)]
            if low > self.bounds[i]:
                fresh.insert(0, Container(self.burst))
                bounds.append(low)
                parts.insert(0, np.zeros(len(grams), dtype=bool))
            if low < np.uint64(2**64 - 1) and (upper is None or low + np.uint64(1) < upper):
                fresh.append(Container(self.burst))
                bounds.append(low + np.uint64(1))
                parts.append(np.zeros(len(grams), dtype=bool))
        else:  # one n-gram only
            return
        for child, rows in zip(fresh, parts):
            if rows.any():
                child.add(grams[rows], counts[rows])
        self.children[i:i + 1] = fresh
        self.bounds = np.concatenate([self.bounds[:i + 1], np.array(bounds, dtype=np.uint64), self.bounds[i + 1:]])

    @property
    def rows(self) -> int:
        return sum(c.rows for c in self.children)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        held = [c.take() for c in self.children if c.rows]
        return np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])


class HatTrie:
    """Counts n-grams of ``width`` ids. ``add`` yields sorted runs where memory is short, ``drain`` the rest."""

    def __init__(self, width: int, burst: int = 1 << 15, limit: int = 3_000_000):
        self.root, self.limit = Node(0, width, burst), limit

    def add(self, grams: np.ndarray, counts: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.root.add(grams, np.ones(len(grams), dtype=np.int64) if counts is None else counts)
        if self.root.rows > self.limit:
            yield from self.spill(self.limit // 2)

    def spill(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Takes whole subtrees out, the largest first, until at most ``keep`` rows stay."""
        children = self.root.children
        left = self.root.rows
        for i in sorted(range(len(children)), key=lambda j: -children[j].rows):
            if left <= keep or not children[i].rows:
                break
            left -= children[i].rows
            yield summed(*children[i].take())
            children[i] = Container(self.root.burst)

    def drain(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield from self.spill(0)
