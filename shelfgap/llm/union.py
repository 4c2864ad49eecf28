"""Classes of numbered members that links join, in one task."""

from __future__ import annotations

import numpy as np


def roots(labels: np.ndarray, of: np.ndarray) -> np.ndarray:
    found = labels[of]
    while True:
        above = labels[found]
        if np.array_equal(above, found):
            return found
        found = above


def unite(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Joins the classes of u[k] and v[k] for all k; ``labels`` points to smaller members."""
    while True:
        a, b = roots(labels, u), roots(labels, v)
        differ = a != b
        if not differ.any():
            return
        u, v, a, b = u[differ], v[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
