"""A minimal perfect hash over the nodes of a shard, and sums over their subtrees."""

from __future__ import annotations

import numpy as np

ROUNDS = 100  # each places over half of what is left; equal keys are never placed


class NodeTable:
    """Slots 0 to n - 1 for n distinct (depth, first, second), each key verified when looked up.

    Keys are thrown into twice as many cells as there are keys; whoever is alone in a cell has
    found its slot, all others try again with another salt.
    """

    def __init__(self, depth: np.ndarray, first: np.ndarray, second: np.ndarray):
        n = len(depth)
        self.slots_of_cells: list[np.ndarray] = []
        self.slots = np.full(n, -1, dtype=np.int64)
        left, placed = np.arange(n), 0
        while len(left):
            if len(self.slots_of_cells) == ROUNDS:
                raise ValueError("nodes are not distinct")
            n_cells = 2 * len(left)
            cells = _cells(depth[left], first[left], second[left], len(self.slots_of_cells), n_cells)
            alone = np.bincount(cells, minlength=n_cells) == 1
            slots = np.where(alone, placed + np.cumsum(alone) - 1, -1)
            self.slots_of_cells.append(slots)
            self.slots[left] = slots[cells]
            placed += int(alone.sum())
            left = left[self.slots[left] < 0]
        at = np.empty(n, dtype=np.int64)
        at[self.slots] = np.arange(n)
        self.keys = depth[at], first[at], second[at]

    def find(self, depth: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are not in the table."""
        found = np.full(len(depth), -1, dtype=np.int64)
        if not self.slots_of_cells:
            return found
        left = np.arange(len(depth))
        for salt, slots in enumerate(self.slots_of_cells):
            tried = slots[_cells(depth[left], first[left], second[left], salt, len(slots))]
            found[left] = tried
            left = left[tried < 0]
        hit = found >= 0
        for own, asked in zip(self.keys, (depth, first, second)):
            hit &= own[found] == asked
        return np.where(hit, found, -1)


def _cells(depth: np.ndarray, first: np.ndarray, second: np.ndarray, salt: int, n_cells: int) -> np.ndarray:
    z = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z ^= (second.astype(np.uint64) + np.uint64(salt)) * np.uint64(0xC2B2AE3D27D4EB4F)
    z ^= (depth.astype(np.uint64) + np.uint64(salt << 8)) * np.uint64(0x165667B19E3779F9)
    z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) % np.uint64(n_cells)).astype(np.int64)


def subtree_sums(
    depth: np.ndarray, own: tuple[np.ndarray, np.ndarray], parent: tuple[np.ndarray, np.ndarray], values: list[np.ndarray]
) -> tuple[list[np.ndarray], np.ndarray]:
    """Each of ``values`` summed over the node's subtree as far as it is in this table, and whether
    the node's parent is outside."""
    table = NodeTable(depth, *own)
    n = len(depth)
    above = np.empty(n, dtype=np.int64)
    above[table.slots] = table.find(depth - 1, *parent)
    totals = []
    for value in values:
        flat = np.zeros(n, dtype=np.int64)
        flat[table.slots] = value
        totals.append(flat)
    by_depth = np.argsort(-table.keys[0], kind="stable")
    starts = np.flatnonzero(np.diff(table.keys[0][by_depth], prepend=-1))
    for slots in np.split(by_depth, starts[1:]):
        slots = slots[above[slots] >= 0]
        for flat in totals:
            np.add.at(flat, above[slots], flat[slots])
    return [flat[table.slots] for flat in totals], above[table.slots] < 0
