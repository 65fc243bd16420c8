"""Small gradient-boosted trees, fitted on the driver over a bounded sample and compiled into column expressions.

A tree is a leaf value (float) or (feature, threshold, below, above); `below` holds where x <= threshold.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _cuts(x: np.ndarray, most: int) -> np.ndarray:
    values = np.unique(x)
    if len(values) < 2:
        return np.zeros(0)
    middle = (values[1:] + values[:-1]) / 2
    return middle if len(middle) <= most else np.unique(np.quantile(middle, np.linspace(0, 1, most)))


def fit_tree(bins: np.ndarray, cuts: list, g: np.ndarray, h: np.ndarray, depth: int, least: float, l2: float = 1.0):
    """A regression tree on gradients g and second derivatives h; bins[i, f] counts the cuts below x."""
    total_g, total_h = g.sum(), h.sum()
    value = float(-total_g / (total_h + l2))
    best = (1e-6, None, None)
    if depth and len(g) > 1:
        for f in range(bins.shape[1]):
            n = len(cuts[f])
            if not n:
                continue
            left_g = np.cumsum(np.bincount(bins[:, f], g, n + 1))[:-1]
            left_h = np.cumsum(np.bincount(bins[:, f], h, n + 1))[:-1]
            gain = left_g**2 / (left_h + l2) + (total_g - left_g) ** 2 / (total_h - left_h + l2) - total_g**2 / (total_h + l2)
            gain[(left_h < least) | (total_h - left_h < least)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k)
    if best[1] is None:
        return value
    _, f, k = best
    low = bins[:, f] <= k
    return (f, float(cuts[f][k]), fit_tree(bins[low], cuts, g[low], h[low], depth - 1, least, l2), fit_tree(bins[~low], cuts, g[~low], h[~low], depth - 1, least, l2))


def value_of(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, cut, below, above = tree
    return np.where(x[:, f] <= cut, value_of(below, x), value_of(above, x))


def boost(x: np.ndarray, y: np.ndarray, rounds: int, depth: int, rate: float = 0.3, share: float = 1.0, least: float = 2.0, seed: int = 0) -> tuple[float, list]:
    """(start, trees) of a logistic model; each tree sees a random share of the rows. Values include the rate."""
    p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    start = float(np.log(p / (1 - p)))
    cuts = [_cuts(x[:, f], 64) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    score, trees, rng = np.full(len(y), start), [], np.random.default_rng(seed)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        rows = np.flatnonzero(rng.random(len(y)) < share) if share < 1 else np.arange(len(y))
        tree = _scaled(fit_tree(bins[rows], cuts, (p - y)[rows], (p * (1 - p))[rows], depth, least), rate)
        if not isinstance(tree, tuple):
            break
        trees.append(tree)
        score += value_of(tree, x)
    return start, trees


def _scaled(tree, rate: float):
    return (*tree[:2], _scaled(tree[2], rate), _scaled(tree[3], rate)) if isinstance(tree, tuple) else tree * rate


def paths(tree, so_far: tuple = ()) -> list[tuple]:
    """Every path from the root, as conditions (feature, whether above, threshold); inner nodes included."""
    if not isinstance(tree, tuple):
        return [so_far] if so_far else []
    f, cut, below, above = tree
    own = [so_far] if so_far else []
    return own + paths(below, (*so_far, (f, False, cut))) + paths(above, (*so_far, (f, True, cut)))


def tree_column(tree, features: list[Column]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    f, cut, below, above = tree
    return F.when(features[f] <= cut, tree_column(below, features)).otherwise(tree_column(above, features))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))
