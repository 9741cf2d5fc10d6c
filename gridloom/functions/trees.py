"""Contributions of one batch of rows to the margin of a tree ensemble.

Runs inside tasks on numpy arrays; it imports nothing else of this package, so that
it can be sent to executors by value.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np

SHAP_TABLE_CELLS = 8_000_000  # solved patterns a task keeps between batches: at most 64 MB

Batch = Callable[[np.ndarray], tuple[float, np.ndarray]]  # rows × slots → bias, contributions


@dataclass
class Tree:
    """Node arrays of one tree; ``left < 0`` marks a leaf."""

    weight: float
    left: np.ndarray
    right: np.ndarray
    slot: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    nominal: np.ndarray
    left_codes: np.ndarray  # node × code: does the code go left

    def goes_left(self, nodes: np.ndarray, x: np.ndarray) -> np.ndarray:
        below = x <= self.threshold[nodes]
        if self.left_codes.shape[1] == 0:
            return below
        codes = np.clip(x, 0, self.left_codes.shape[1] - 1).astype(np.int64)
        return np.where(self.nominal[nodes], self.left_codes[nodes, codes], below)


def staged_batches(arrays: Sequence[dict[str, Any]], depth: int) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Margins of the first 1, 2, … trees of every row, and which of them are missing: those of a tree whose leaf or weight has
    no value, after which the sum starts anew. ``arrays`` has ``weight, left, right, slot, threshold, value`` and, for trees with
    splits by codes, ``known`` (the sorted codes) and ``left_codes`` (node × known code); a missing slot is -1.
    """

    def goes_left(tree: dict[str, Any], node: np.ndarray, value: np.ndarray) -> np.ndarray:
        left = value <= tree["threshold"][node]
        known = tree["known"]
        if not len(known):
            return left
        place = np.minimum(np.searchsorted(known, value), len(known) - 1)
        return np.where(tree["nominal"][node], (known[place] == value) & tree["left_codes"][node, place], left)

    def run(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # the last column stands for slots that a row does not have: no value there goes left
        x = np.hstack([x, np.full((len(x), 1), np.nan)])
        sums, missing = np.empty((len(x), len(arrays))), np.empty((len(x), len(arrays)), dtype=bool)
        for t, tree in enumerate(arrays):
            at = np.zeros(len(x), dtype=np.int64)
            active = np.arange(len(x))
            for _ in range(max(1, depth)):
                active = active[tree["left"][at[active]] >= 0]
                if not len(active):
                    break
                node = at[active]
                slot = tree["slot"][node]
                value = x[active, np.where((slot >= 0) & (slot < x.shape[1]), slot, x.shape[1] - 1)]
                at[active] = np.where(goes_left(tree, node, value), tree["left"][node], tree["right"][node])
            margin = tree["weight"] * tree["value"][at]
            missing[:, t] = np.isnan(tree["weight"]) | tree["empty"][at]
            sums[:, t] = margin if t == 0 else np.where(missing[:, t - 1], 0.0, sums[:, t - 1]) + margin
        return sums, missing

    return run


def path_batches(arrays: Sequence[dict[str, Any]]) -> Batch:
    """Bias and contributions: each split credits the change of the node value to its feature."""
    trees = [Tree(**fields) for fields in arrays]
    bias = float(sum(tree.weight * tree.value[0] for tree in trees))

    def run(x: np.ndarray) -> tuple[float, np.ndarray]:
        rows, out = np.arange(len(x)), np.zeros_like(x)
        for tree in trees:
            at = np.zeros(len(x), dtype=np.int64)
            active = rows[tree.left[at] >= 0]
            while len(active):
                node = at[active]
                slot = tree.slot[node]
                child = np.where(tree.goes_left(node, x[active, slot]), tree.left[node], tree.right[node])
                out[active, slot] += tree.weight * (tree.value[child] - tree.value[node])
                at[active] = child
                active = active[tree.left[child] >= 0]
        return bias, out

    return run


@dataclass
class _Leaf:
    """A leaf with the steps to it, grouped by the feature they test."""

    scale: float  # tree weight times leaf value
    slots: list[int]
    steps: list[list[tuple[int, bool]]]  # per slot: (node, leaf is on the left)
    absent: np.ndarray  # per slot: share of training rows that follow the leaf's branches


def _leaves(tree: Tree) -> list[_Leaf]:
    leaves, stack = [], [(0, {}, {})]
    while stack:
        node, steps, absent = stack.pop()
        if tree.left[node] < 0:
            slots = list(steps)
            leaves.append(_Leaf(tree.weight * tree.value[node], slots, [steps[s] for s in slots], np.array([absent[s] for s in slots])))
            continue
        slot = int(tree.slot[node])
        for child, left in ((tree.left[node], True), (tree.right[node], False)):
            share = absent.get(slot, 1.0) * tree.cover[child] / tree.cover[node]
            stack.append((child, {**steps, slot: [*steps.get(slot, []), (node, left)]}, {**absent, slot: share}))
    return leaves


def _shapley(hits: np.ndarray, absent: np.ndarray) -> np.ndarray:
    """Shapley values of a unit leaf for each pattern of fulfilled features.

    ``hits`` is patterns × features (0/1). A coalition's value is the product of the
    hits of its members and the absent shares of the others.
    """
    n = hits.shape[1]
    values = np.zeros(hits.shape)
    order = np.array([math.factorial(s) * math.factorial(n - 1 - s) / math.factorial(n) for s in range(n)])
    for i in range(n):
        by_size = np.zeros((len(hits), n))
        by_size[:, 0] = 1.0
        for j in range(n):
            if j != i:
                shifted = by_size[:, :-1] * hits[:, j : j + 1]
                by_size *= absent[j]
                by_size[:, 1:] += shifted
        values[:, i] = (hits[:, i] - absent[i]) * (by_size @ order)
    return values


def _bits(patterns: np.ndarray, n: int) -> np.ndarray:
    return ((patterns[:, None] >> np.arange(n)) & 1).astype(float)


def shap_batches(arrays: Sequence[dict[str, Any]]) -> Batch:
    """Bias and path-dependent SHAP values in margin space."""
    trees = [Tree(**fields) for fields in arrays]
    leaves = [_leaves(tree) for tree in trees]
    bias = sum(leaf.scale * float(np.prod(leaf.absent)) for group in leaves for leaf in group)
    tables: dict[tuple[int, int], np.ndarray] = {}
    room = SHAP_TABLE_CELLS

    def run(x: np.ndarray) -> tuple[float, np.ndarray]:
        nonlocal room
        out = np.zeros_like(x)
        for t, tree in enumerate(trees):
            went = {int(n): tree.goes_left(np.full(len(x), n), x[:, tree.slot[n]]) for n in np.flatnonzero(tree.left >= 0)}
            for k, leaf in enumerate(leaves[t]):
                n = len(leaf.slots)
                if n == 0:
                    continue
                pattern = np.zeros(len(x), dtype=np.int64)
                for bit, steps in enumerate(leaf.steps):
                    hit = went[steps[0][0]] == steps[0][1]
                    for node, left in steps[1:]:
                        hit = hit & (went[node] == left)
                    pattern |= hit.astype(np.int64) << bit
                # rows share few patterns, so each pattern is solved once
                table = tables.get((t, k))
                if table is None and 2**n <= max(len(x), 64):
                    table = leaf.scale * _shapley(_bits(np.arange(2**n), n), leaf.absent)
                    if table.size <= room:
                        tables[(t, k)] = table
                        room -= table.size
                if table is None:
                    patterns, pattern = np.unique(pattern, return_inverse=True)
                    table = leaf.scale * _shapley(_bits(patterns, n), leaf.absent)
                out[:, leaf.slots] += table[pattern]
        return bias, out

    return run
