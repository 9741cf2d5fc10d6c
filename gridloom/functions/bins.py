"""Boosting over binned rows: what a task does with a chunk of rows.

Runs inside tasks on numpy arrays; it imports nothing else of this package, so that
it can be sent to executors by value. A chunk has its bins slot by slot, a byte for each row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

import numpy as np

#: A tree that grows: node → (slot, last bin that goes left, left, right); a leaf has slot -1.
Shape = list[tuple[int, int, int, int]]


def binned(x: np.ndarray, thresholds: Sequence[np.ndarray]) -> np.ndarray:
    """Slots × rows: the number of thresholds below each value."""
    out = np.zeros((len(thresholds), len(x)), dtype=np.uint8)
    for slot, limits in enumerate(thresholds):
        if len(limits):
            out[slot] = np.searchsorted(limits, x[:, slot], side="left")
    return out


def places(shape: Shape, bins: np.ndarray) -> np.ndarray:
    """The node in which each row of a chunk ends, in bytes: sides are chosen by masks."""

    def of(node: int) -> Any:
        slot, last, left, right = shape[node]
        if slot < 0:
            return np.uint8(node)
        below, above = of(left), of(right)
        goes_left = np.negative((bins[slot] <= last).view(np.uint8))
        return above ^ ((below ^ above) & goes_left)

    return np.broadcast_to(of(0), bins.shape[1:])


def grouped(sizes: Sequence[int]) -> list[list[int]]:
    """Slots of few bins together, as long as a byte holds the number of their combinations."""
    groups: list[tuple[int, list[int]]] = []
    for slot in sorted(range(len(sizes)), key=lambda s: -sizes[s]):
        for i, (cells, members) in enumerate(groups):
            if cells * sizes[slot] <= 256:
                groups[i] = (cells * sizes[slot], [*members, slot])
                break
        else:
            groups.append((sizes[slot], [slot]))
    return [members for _, members in groups]


def residuals(label: np.ndarray, bins: np.ndarray, forest: Sequence[tuple[float, Shape, np.ndarray]]) -> np.ndarray:
    """What the next tree is fitted to: the label as -1 or 1, then the negative gradient of the log loss."""
    signs = 2.0 * label - 1.0
    if not forest:
        return signs
    margin = np.zeros(len(label))
    for weight, shape, values in forest:
        margin += (weight * values).take(places(shape, bins))
    return 4.0 * signs / (1.0 + np.exp(2.0 * signs * margin))


def histograms(
    label: np.ndarray, bins: np.ndarray, forest: Sequence[tuple[float, Shape, np.ndarray]], shape: Shape, nodes: Sequence[int], sizes: Sequence[int], groups: Sequence[Sequence[int]]
) -> np.ndarray:
    """Number, sum and sum of squares of the residuals for each of ``nodes`` and each combination of bins of the slots of each group, one group after the other."""
    target = residuals(label, bins, forest)
    at = places(shape, bins)
    number = np.full(len(shape), -1, dtype=np.intp)
    number[list(nodes)] = np.arange(len(nodes))
    node = number.take(at)
    inside = np.flatnonzero(node >= 0)
    if len(inside) < len(node):
        node, target, bins = node[inside], target[inside], bins.take(inside, axis=1)
    weights, start = (None, target, target * target), 0
    out = np.empty((3, len(nodes), sum(math.prod(sizes[slot] for slot in members) for members in groups)))
    for members in groups:
        cell, cells = bins[members[0]], math.prod(sizes[slot] for slot in members)
        for slot in members[1:]:
            cell = cell * np.uint8(sizes[slot]) + bins[slot]
        cell = node * cells + cell
        for i, weight in enumerate(weights):
            out[i, :, start : start + cells] = np.bincount(cell, weight, len(nodes) * cells).reshape(len(nodes), cells)
        start += cells
    return out


def by_slot(sums: np.ndarray, sizes: Sequence[int], groups: Sequence[Sequence[int]]) -> np.ndarray:
    """The sums for each bin of each slot, one slot after the other."""
    starts, start = np.cumsum([0, *sizes]), 0
    out = np.empty((*sums.shape[:2], starts[-1]))
    for members in groups:
        dims = [sizes[slot] for slot in members]
        block = sums[:, :, start : start + math.prod(dims)].reshape(*sums.shape[:2], *dims)
        start += math.prod(dims)
        for axis, slot in enumerate(members):
            out[:, :, starts[slot] : starts[slot + 1]] = block.sum(axis=tuple(a + 2 for a in range(len(dims)) if a != axis))
    return out
