"""Helpers for pairs inside blocks, run in tasks on numpy arrays of bounded size."""

from __future__ import annotations

import numpy as np


def spanning_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For n nodes and edges by index, the smallest index of each node's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, root):
            return root
        root = new
