"""One classification tree over counted cells, in numpy.

A cell is a vector of bin numbers (at most ``BINS`` per feature) with the rows of both classes that share it: equal rows are the
same to a tree. ``bins`` has one row per feature and one column per cell, ``counts`` one row per class. A tree is a set
of arrays over its nodes, level by level; children are neighbours, the left one takes bins up to ``cut``.
"""

from __future__ import annotations

import numpy as np

# Candidate intervals of a feature, as in Spark ML.
BINS = 32
# Histograms of so many nodes are held at once.
NODES_AT_ONCE = 4096


def thresholds(low: np.ndarray, high: np.ndarray, weight: np.ndarray) -> list[float]:
    """Borders between sorted values (or short ranges of values): all of them, or ``BINS - 1`` of about equal weight between."""
    if len(low) <= BINS:
        return [float(x) for x in (high[:-1] + low[1:]) / 2.0]
    stride = float(weight.sum()) / BINS
    borders, upto, target = [], float(weight[0]), stride
    for i in range(1, len(low)):
        before, upto = upto, upto + float(weight[i])
        if abs(before - target) < abs(upto - target):
            borders.append(float((high[i - 1] + low[i]) / 2.0))
            target += stride
    return borders


def bagged(counts: np.ndarray, seed: int, tree: int, block: int, bootstrap: bool) -> np.ndarray:
    """How often each cell's rows are drawn for a tree: a sum of Poisson(1) draws is Poisson(n)."""
    return np.random.default_rng([seed % 2**63, tree, block]).poisson(counts) if bootstrap else counts


def chosen_features(rng: np.random.Generator, nodes: int, features: int, slots: int) -> np.ndarray:
    """So many features of each node, in their order: the first of equal splits is taken."""
    return np.sort(rng.random((nodes, features)).argsort(axis=1)[:, :slots], axis=1)


def histograms(bins: np.ndarray, counts: np.ndarray, at: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Counts by slot, kind of count, node and bin; ``at`` is the node of a cell, ``chosen`` has the feature of each node and slot."""
    nodes, slots = chosen.shape
    cells = bins.shape[1]
    flat, own = bins.ravel(), np.arange(cells)
    found = np.empty((slots, len(counts), nodes, BINS))
    for s in range(slots):
        where = at * BINS + flat[chosen[at, s] * cells + own]
        for y, n in enumerate(counts):
            found[s, y] = np.bincount(where, n, nodes * BINS).reshape(nodes, BINS)
    return found


def _impurity(weight: np.ndarray) -> np.ndarray:
    total = weight[0] + weight[1]
    return 1.0 - (weight[0] / total) ** 2 - (weight[1] / total) ** 2


def best_splits(found: np.ndarray, chosen: np.ndarray, weights: np.ndarray, least: int):
    """Per node the feature (-1 for none), bin and gain of the purest split, and the counts that go left; the first two are rows by class."""
    nodes = found.shape[2]
    feature, cut = np.full(nodes, -1, np.int16), np.zeros(nodes, np.uint8)
    gain, left, own = np.zeros(nodes), np.zeros((found.shape[1], nodes)), np.arange(nodes)
    w = weights[:, None, None]
    for s in range(found.shape[0]):
        below = found[s].cumsum(axis=2)
        above = below[:, :, -1:] - below
        low, high = w * below[:2], w * above[:2]
        n_low, n_high = low.sum(axis=0), high.sum(axis=0)
        with np.errstate(divide="ignore", invalid="ignore"):
            value = (_impurity((low + high)[:, :, -1:]) - n_low / (n_low + n_high) * _impurity(low)
                     - n_high / (n_low + n_high) * _impurity(high))
        value[(below[:2].sum(axis=0) < least) | (above[:2].sum(axis=0) < least)] = -1.0
        at_bin = value.argmax(axis=1)
        top = value[own, at_bin]
        better = top > gain
        feature[better], cut[better], gain[better] = chosen[better, s], at_bin[better], top[better]
        left[:, better] = below[:, own, at_bin][:, better]
    return feature, cut, gain, left


def grow(bins: np.ndarray, counts: np.ndarray, weights: np.ndarray, rng: np.random.Generator, depth: int, slots: int,
         least: int) -> dict[str, np.ndarray]:
    """Split level by level until nodes are pure, ``depth`` levels deep, or no split of their features helps."""
    totals, at, size = counts.sum(axis=1, keepdims=True).astype(float), np.zeros(bins.shape[1], np.int64), 0
    levels = []
    while True:
        q = totals.shape[1]
        level = {"feature": np.full(q, -1, np.int8), "cut": np.zeros(q, np.uint8), "left": np.zeros(q, np.int32),
                 "gain": np.zeros(q), "rows": totals}
        levels.append(level)
        size += q
        is_open = (totals > 0).all(axis=0) & (len(levels) <= depth)
        if not is_open.any():
            break
        kept = np.flatnonzero(is_open[at])
        at = (np.cumsum(is_open) - 1)[at[kept]]
        order = np.argsort(at, kind="stable")
        kept, at = kept[order], at[order]
        bins, counts = np.ascontiguousarray(bins[:, kept]), counts[:, kept]
        opened = np.flatnonzero(is_open)
        chosen = chosen_features(rng, len(opened), len(bins), slots)
        parts = []
        for first in range(0, len(opened), NODES_AT_ONCE):
            a, b = np.searchsorted(at, [first, first + NODES_AT_ONCE])
            some = chosen[first:first + NODES_AT_ONCE]
            parts.append(best_splits(histograms(np.ascontiguousarray(bins[:, a:b]), counts[:, a:b], at[a:b] - first, some),
                                     some, weights, least))
        feature, cut, gain, left = (np.concatenate(x, axis=-1) for x in zip(*parts))
        split = feature >= 0
        place = np.cumsum(split) - 1
        level["feature"][opened], level["cut"][opened], level["gain"][opened] = feature, cut, gain
        level["left"][opened[split]] = size + 2 * place[split]
        totals = np.stack([left[:, split], totals[:, opened[split]] - left[:, split]], axis=2).reshape(2, -1)
        kept = np.flatnonzero(split[at])
        bins, counts, at = bins[:, kept], counts[:, kept], at[kept]
        at = 2 * place[at] + (bins[feature[at], np.arange(len(at))] > cut[at])
    return {k: np.concatenate([x[k] for x in levels], axis=-1) for k in levels[0]}


def inner_levels(tree: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Inner nodes by level."""
    found, nodes = [], np.zeros(1, np.int64)
    while True:
        nodes = nodes[tree["feature"][nodes] >= 0]
        if not len(nodes):
            return found
        found.append(nodes)
        left = tree["left"][nodes].astype(np.int64)
        nodes = np.stack([left, left + 1], axis=1).ravel()


def votes(tree: dict[str, np.ndarray], weights: np.ndarray) -> np.ndarray:
    return tree["rows"][1] * weights[1] > tree["rows"][0] * weights[0]


def pruned(tree: dict[str, np.ndarray], weights: np.ndarray) -> dict[str, np.ndarray]:
    """Two leaves of one vote become one leaf, from below; what is cut off leaves the arrays."""
    feature, left, vote = tree["feature"].copy(), tree["left"], votes(tree, weights)
    levels = inner_levels(tree)
    for nodes in reversed(levels):
        a, b = left[nodes], left[nodes] + 1
        feature[nodes[(feature[a] < 0) & (feature[b] < 0) & (vote[a] == vote[b])]] = -1
    stays = np.zeros(len(feature), bool)
    stays[0] = True
    for nodes in levels:
        nodes = nodes[stays[nodes] & (feature[nodes] >= 0)]
        stays[left[nodes]] = stays[left[nodes] + 1] = True
    number = np.cumsum(stays) - 1
    slim = {k: v[..., stays] for k, v in tree.items()}
    slim["feature"] = feature[stays]
    slim["left"] = np.where(slim["feature"] >= 0, number[slim["left"]], 0).astype(np.int32)
    return slim


def importances(tree: dict[str, np.ndarray], weights: np.ndarray, features: int) -> np.ndarray:
    """Gain times weight, summed by feature."""
    inner = tree["feature"] >= 0
    worth = tree["gain"] * (weights @ tree["rows"])
    return np.bincount(tree["feature"][inner], worth[inner], features)


def shares(tree: dict[str, np.ndarray], weights: np.ndarray) -> np.ndarray:
    """The positive class's share of each node's weight."""
    return weights[1] * tree["rows"][1] / (weights @ tree["rows"])


def walk(tree: dict[str, np.ndarray], bins: np.ndarray) -> np.ndarray:
    """The leaf of each cell."""
    at = np.zeros(bins.shape[1], np.int64)
    moving = np.arange(bins.shape[1])
    while True:
        moving = moving[tree["feature"][at[moving]] >= 0]
        if not len(moving):
            return at
        here = at[moving]
        at[moving] = tree["left"][here] + (bins[tree["feature"][here], moving] > tree["cut"][here])
