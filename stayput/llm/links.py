"""Spanning forests of link lists inside one task."""

from __future__ import annotations

import numpy as np


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for every node that is not the smallest of its component in the links a-b: as connected, at most one per node."""
    if not len(a):
        return a, b
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = np.minimum(new, new[new])
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]
