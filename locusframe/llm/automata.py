"""Weighted acyclic automata over sequences of labels, as sorted arrays.

An automaton accepts sequences of k labels and gives each a weight, its count. States of
one depth stand in the order of the sequences that lead to them; a state has the label
of its arc and the range of its children. Final states with the same weight are one:
an arc of the last depth has the number of its final state only.
"""

from __future__ import annotations

import numpy as np


def _small(x: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest unsigned type."""
    most = int(x.max()) if len(x) else 0
    return x.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))


class Automaton:
    """labels[d]: of the states at depth d + 1; children[d]: how many each has; final: which weight a last state has."""

    def __init__(self, labels: list[np.ndarray], children: list[np.ndarray], final: np.ndarray, weights: np.ndarray):
        self.labels, self.children, self.final, self.weights = labels, children, final, weights

    @classmethod
    def build(cls, columns: list[np.ndarray], counts: np.ndarray) -> Automaton:
        """From distinct sequences in ascending order: a sequence adds states behind what it shares with the one before."""
        n = len(counts)
        new, begins = np.zeros(n, bool), []
        new[:1] = True
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
            begins.append(np.flatnonzero(new))
        children = []
        for above, below in zip(begins, begins[1:]):
            first = np.searchsorted(below, above)
            children.append(_small(np.diff(np.append(first, len(below)))))
        weights, final = np.unique(counts, return_inverse=True)
        return cls([c[b] for c, b in zip(columns, begins)], children, _small(final), weights.astype(np.int64))

    def sequences(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Columns of labels and the counts, in ascending order."""
        columns = [self.labels[-1]]
        leaves = np.ones(len(self.labels[-1]), np.int64)
        for labels, children in zip(self.labels[-2::-1], self.children[::-1]):
            ends = np.cumsum(children, dtype=np.int64)
            before = np.concatenate([[0], np.cumsum(leaves)])
            leaves = before[ends] - before[ends - children]
            columns.append(np.repeat(labels, leaves))
        return columns[::-1], self.weights[self.final]

    def compose(self, columns: list[np.ndarray]) -> np.ndarray:
        """The counts of some sequences, 0 where one is not accepted; all are followed arc by arc at the same time."""
        n = len(columns[0])
        low, high = np.zeros(n, np.int64), np.full(n, len(self.labels[0]), np.int64)
        alive = np.ones(n, bool)
        for d, column in enumerate(columns):
            labels, last = self.labels[d], high
            while (open_ := low < high).any():
                middle = (low + high) >> 1
                less = open_ & (labels[np.minimum(middle, len(labels) - 1)] < column)
                low, high = np.where(less, middle + 1, low), np.where(open_ & ~less, middle, high)
            alive &= low < last
            state = np.where(alive, low, 0)
            alive[alive] = labels[state[alive]] == column[alive]
            if d < len(self.children):
                ends = np.cumsum(self.children[d], dtype=np.int64)
                high = np.where(alive, ends[state] if len(ends) else 0, 0)
                low = high - np.where(alive, self.children[d][state] if len(ends) else 0, 0)
        out = np.zeros(n, np.int64)
        out[alive] = self.weights[self.final[state[alive]]]
        return out

    def pack(self) -> bytes:
        arrays = [*self.labels, *self.children, self.final, self.weights]
        head = np.array([len(self.labels), *(x for a in arrays for x in (a.dtype.itemsize, len(a)))], np.int64)
        return np.int64(len(head)).tobytes() + head.tobytes() + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def unpack(cls, data: bytes) -> Automaton:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        head = np.frombuffer(data, np.int64, n, 8).tolist()
        k, at, arrays = head[0], 8 + 8 * n, []
        for size, length in zip(head[1::2], head[2::2]):
            arrays.append(np.frombuffer(data, f"<u{size}", length, at))
            at += size * length
        return cls(arrays[:k], arrays[k : 2 * k - 1], arrays[-2], arrays[-1].astype(np.int64))


def union(automata: list[Automaton]) -> tuple[list[np.ndarray], np.ndarray]:
    """The sequences of all, in ascending order, each with the sum of its counts."""
    parts = [a.sequences() for a in automata]
    columns = [np.concatenate(x) for x in zip(*(p[0] for p in parts))]
    counts = np.concatenate([p[1] for p in parts])
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.zeros(len(counts), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.add.reduceat(counts[order], first) if len(first) else counts
