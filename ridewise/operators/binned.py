"""What both growers of boosted trees (``boosting``, ``growth``) do with blocks of binned rows.

Features of few bins share a column of joint values, so a task counts a few
joint values a row and not every feature. A row's way through a tree is looked
up, not walked: a joint value names the leaves that its column's splits leave
open, and the leaf open in every column is where the row ends.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import RDD

#: Bins a feature.
BINS = 32
#: Joint values that a column of several features may take, and rows of a task that make one of them worth its sums.
JOINT, ROWS_A_VALUE = 1 << 12, 1 << 8
#: Levels of a tree whose leaves are the bits of a number.
BIT_LEVELS = 5


@dataclass(frozen=True)
class Columns:
    """Where a feature's bins stand: (column, stride, bins) by feature, and joint values by column."""

    place: tuple
    sizes: tuple

    @classmethod
    def of(cls, cuts: list, task_rows: int | None = None) -> Columns:
        """Columns of at most JOINT values, of fewer where a task has few rows."""
        most = JOINT if task_rows is None else min(JOINT, max(BINS, task_rows // ROWS_A_VALUE))
        place, sizes = [None] * len(cuts), []
        for i in sorted(range(len(cuts)), key=lambda i: -len(cuts[i])):
            bins = len(cuts[i]) + 1
            at = next((c for c, size in enumerate(sizes) if size * bins <= most), len(sizes))
            sizes += [1] * (at == len(sizes))
            place[i] = (at, sizes[at], bins)
            sizes[at] *= bins
        return cls(tuple(place), tuple(sizes))

    def joint(self, bins: Sequence[np.ndarray]) -> np.ndarray:
        """Columns x rows, from each feature's bins."""
        out = np.zeros((len(self.sizes), len(bins[0])), np.uint16)
        for (at, stride, _), b in zip(self.place, bins):
            out[at] += b.astype(np.uint16) * np.uint16(stride)
        return out

    def beyond(self, feature: int, cut: int) -> np.ndarray:
        """For each joint value of the feature's column whether it lies in a bin of the feature beyond ``cut``."""
        at, stride, bins = self.place[feature]
        return np.arange(self.sizes[at]) // stride % bins > cut

    def right(self, x: np.ndarray, rows: np.ndarray, feature: int, cut: int) -> np.ndarray:
        """Whether each of the rows lies in a bin of the feature beyond ``cut``."""
        return self.beyond(feature, cut).take(x[self.place[feature][0]].take(rows))

    def apart(self, sums: list[np.ndarray]) -> np.ndarray:
        """(kind, node, feature, bin) from (kind, node, joint value) of each column."""
        kinds, nodes, _ = sums[0].shape
        out = np.zeros((kinds, nodes, len(self.place), BINS))
        for f, (at, stride, bins) in enumerate(self.place):
            out[:, :, f, :bins] = sums[at].reshape(kinds, nodes, -1, bins, stride).sum(axis=(2, 4))
        return out


class Paths:
    """Where rows end in a tree given by split feature (-1: leaf) and last bin that goes left by node (children of i: 2i+1, 2i+2)."""

    def __init__(self, feature: np.ndarray, cut: np.ndarray, levels: int, columns: Columns):
        self.feature, self.cut, self.levels, self.columns = feature, cut, levels, columns
        #: by place on the deepest level, the node in which a row of that place ends
        self.ends = np.zeros(1 << levels, np.intp)
        self.open: dict[int, np.ndarray] = {}
        waiting = [(0, 0, 1 << levels)]
        while waiting:
            node, low, high = waiting.pop()
            f, middle = (feature[node], (low + high) // 2) if high - low > 1 else (-1, low)
            if f < 0:
                self.ends[low:high] = node
                continue
            waiting += [(2 * node + 1, low, middle), (2 * node + 2, middle, high)]
            if levels <= BIT_LEVELS:
                at, bits = columns.place[f][0], [np.uint32(((1 << (b - a)) - 1) << a) for a, b in ((low, middle), (middle, high))]
                known = self.open.setdefault(at, np.full(columns.sizes[at], 2 ** 32 - 1, np.uint32))
                known &= ~np.where(columns.beyond(f, cut[node]), *bits)

    def places(self, x: np.ndarray) -> np.ndarray:
        """The first place on the deepest level under the node in which each row of ``x`` (column x row) ends."""
        if self.levels > BIT_LEVELS:
            return self._walked(x)
        left = None
        for at, known in self.open.items():
            here = known.take(x[at])
            left = here if left is None else np.bitwise_and(left, here, out=left)
        if left is None:
            return np.zeros(x.shape[1], np.uint32)
        left &= -left                                                    # the lowest open leaf, a power of two
        return (left.astype(np.float32).view(np.uint32) >> np.uint32(23)) - np.uint32(127)

    def _walked(self, x: np.ndarray) -> np.ndarray:
        out, waiting = np.zeros(x.shape[1], np.intp), [(0, 0, 1 << self.levels, np.arange(x.shape[1]))]
        while waiting:
            node, low, high, rows = waiting.pop()
            f = self.feature[node] if high - low > 1 else -1
            if f < 0 or not len(rows):
                out[rows] = low
                continue
            right, middle = self.columns.right(x, rows, f, self.cut[node]), (low + high) // 2
            waiting += [(2 * node + 1, low, middle, rows[~right]), (2 * node + 2, middle, high, rows[right])]
        return out


def lighter_slots(ends: np.ndarray, light: np.ndarray) -> np.ndarray:
    """By the place at which a row ends, its parent's number if the row lies in a split's lighter child, else -1.

    light: for each node of the level above the deepest 0 if its left child is the lighter one, 1 if the right one is, -1 for a leaf.
    """
    first = 2 * len(light) - 1
    parent = (ends - first) >> 1
    return np.where((ends >= first) & ((ends - first) & 1 == light.take(np.maximum(parent, 0))), parent, -1).astype(np.int16)


def taken(paths: Paths | None, slots: np.ndarray | None, x: np.ndarray, drawn: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """The drawn rows of ``x`` that a level adds up, and the slot of each; all drawn rows without paths."""
    if paths is None:
        return np.arange(x.shape[1]) if drawn is None else np.flatnonzero(drawn), None
    slot = slots.take(paths.places(x))
    here = slot >= 0
    use = np.flatnonzero(here if drawn is None else np.logical_and(here, drawn, out=here))
    return use, slot.take(use).astype(np.intp)


def add(x: np.ndarray, use: np.ndarray, slot: np.ndarray | None, *values: tuple[list[np.ndarray], np.ndarray]) -> None:
    """Adds numbers of the rows ``use`` to sums by slot and joint value of each column; a complex one is two numbers at once."""
    for c in range(len(x)):
        at = x[c].take(use).astype(np.intp)
        if slot is not None:
            at += slot * values[0][0][c].shape[-1]
        for total, numbers in values:
            np.add.at(total[c].reshape(-1), at, numbers)


def dealt(rows: RDD, parts: int) -> RDD:
    """``rows``, blocks of a hundred thousand rows or so, in ``parts`` partitions of equal numbers."""
    return rows.zipWithIndex().map(lambda r: (r[1], r[0])).partitionBy(parts, lambda i: i).values()


def paired(first: np.ndarray | float, second: np.ndarray) -> np.ndarray:
    out = np.empty(len(second), complex)
    out.real, out.imag = first, second
    return out
