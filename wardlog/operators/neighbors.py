"""Exact nearest neighbours by spatial cells.

Space is cut into boxes of about equal population. A row first looks for
neighbours in its own box; the distance found bounds the search, and only boxes
within that distance are asked as well. Identical vectors are merged with a
multiplicity beforehand, so no box is crowded with copies, and a task returns at
most ``k`` neighbours per row, never pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.session import materialize

SAMPLES_PER_CELL = 64
HASH_STEPS = 1 << 20
CANDIDATE = "struct<distance:double,vid:string,mult:bigint,x:array<double>>"


@dataclass
class Cells:
    """A tree of axis cuts and the boxes of its leaves."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def locate(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), dtype=int), np.arange(len(x))
        while True:
            inner = self.leaf[at] < 0
            if not inner.any():
                return self.leaf[at]
            f = np.where(inner, self.feature[at], 0)
            down = np.where(x[rows, f] < self.cut[at], self.left[at], self.right[at])
            at = np.where(inner, down, at)

    def within(self, point: np.ndarray, radius: float) -> np.ndarray:
        """Leaves whose box comes as near as ``radius``."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0.0)
        return np.flatnonzero(np.sqrt((gap ** 2).sum(axis=1)) <= radius)


def build_cells(sample: np.ndarray, cells: int) -> Cells:
    """Cut the sample at medians of the widest axis until each leaf is small."""
    width = sample.shape[1]
    size = max(1, len(sample) // max(1, cells))
    feature, cut, left, right, leaf, lows, highs = [], [], [], [], [], [], []
    pending = [(sample, np.full(width, -np.inf), np.full(width, np.inf), None, 0)]
    while pending:
        points, low, high, parent, side = pending.pop()
        node = len(feature)
        for column, empty in ((feature, 0), (cut, 0.0), (left, -1), (right, -1), (leaf, -1)):
            column.append(empty)
        if parent is not None:
            (left, right)[side][parent] = node
        spread = np.ptp(points, axis=0) if len(points) else np.zeros(width)
        axis = int(spread.argmax())
        if cells <= 1 or len(points) <= size or spread[axis] <= 0:
            leaf[node] = len(lows)
            lows.append(low)
            highs.append(high)
            continue
        middle = np.median(points[:, axis])
        if middle <= points[:, axis].min():
            middle = np.unique(points[:, axis])[1]
        below = points[:, axis] < middle
        feature[node], cut[node] = axis, middle
        upper, lower = high.copy(), low.copy()
        upper[axis] = lower[axis] = middle
        pending.append((points[below], low, upper, node, 0))
        pending.append((points[~below], lower, high, node, 1))
    return Cells(np.array(feature), np.array(cut), np.array(left), np.array(right), np.array(leaf),
                 np.array(lows), np.array(highs))


def nearest(queries: np.ndarray, points: np.ndarray, k: int):
    """Yield, per query, indices and distances of its ``k`` nearest points."""
    step = max(1, 2_000_000 // max(1, len(points)))
    for start in range(0, len(queries), step):
        block = queries[start:start + step]
        squared = np.zeros((len(block), len(points)))
        for axis in range(points.shape[1]):
            squared += (block[:, axis, None] - points[None, :, axis]) ** 2
        take = min(k, len(points))
        best = np.argpartition(squared, take - 1, axis=1)[:, :take] if take else np.zeros((len(block), 0), int)
        for i, chosen in enumerate(best):
            distance = np.sqrt(squared[i, chosen])
            order = np.lexsort((chosen, distance))
            yield chosen[order], distance[order]


def _candidates(chosen, distance, ids, mult, x) -> list[dict]:
    return [{"distance": float(d), "vid": ids[j], "mult": int(mult[j]), "x": x[j].tolist()}
            for j, d in zip(chosen, distance)]


def nearest_vectors(vectors: DataFrame, k: int = 5, cell_rows: int = 2000) -> DataFrame:
    """``vid, x, mult, near`` for distinct vectors ``vid, x, mult``.

    ``near`` lists the ``k`` nearest other vectors by distance. ``vectors`` is
    read several times and should be a stored table. Cells hold about ``cell_rows`` vectors whatever
    the number of vectors; the driver keeps one small record, and draws ``SAMPLES_PER_CELL`` vectors, per cell.
    """
    stored = vectors.select("vid", "x", F.col("mult").cast("bigint").alias("mult"))
    n = stored.count()
    cells = max(1, -(-n // cell_rows))
    share = min(1.0, cells * SAMPLES_PER_CELL / max(1, n))
    # About cells * SAMPLES_PER_CELL vectors, however many there are.
    picked = stored.where(F.pmod(F.xxhash64("vid"), F.lit(HASH_STEPS)) < F.lit(int(share * HASH_STEPS) + 1))
    sample = picked.select("x").toPandas()["x"]
    if not len(sample):
        sample = stored.select("x").limit(1).toPandas()["x"]
    if not len(sample):
        return stored.withColumn("near", F.lit(None).cast(f"array<{CANDIDATE}>"))
    tree = build_cells(np.stack(sample.to_numpy()), cells)

    @F.pandas_udf("int")
    def cell_of(x: pd.Series) -> pd.Series:
        return pd.Series(tree.locate(np.stack(x.to_numpy())) if len(x) else [], dtype="int32")

    placed = stored.withColumn("cell", cell_of("x"))

    def inside(rows: pd.DataFrame) -> pd.DataFrame:
        x, ids, mult = np.stack(rows["x"].to_numpy()), rows["vid"].to_numpy(), rows["mult"].to_numpy()
        near, radius, asked = [], [], []
        for i, (chosen, distance) in enumerate(nearest(x, x, k + 1)):
            own = chosen != i
            chosen, distance = chosen[own][:k], distance[own][:k]
            near.append(_candidates(chosen, distance, ids, mult, x))
            reach = float(distance[-1]) if len(distance) == k else float("inf")
            radius.append(reach)
            asked.append([int(c) for c in tree.within(x[i], reach) if c != rows["cell"].iat[i]])
        return rows.assign(near=near, radius=radius, asked=asked)

    schema = f"vid string, x array<double>, mult bigint, cell int, near array<{CANDIDATE}>, radius double, asked array<int>"
    local = materialize(placed.groupBy("cell").applyInPandas(inside, schema), "local-neighbors")
    questions = local.select("vid", "x", "radius", F.explode("asked").alias("cell"))

    def across(asking: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(there):
            return pd.DataFrame({"vid": [], "near": []}, dtype=object)
        x, ids, mult = np.stack(there["x"].to_numpy()), there["vid"].to_numpy(), there["mult"].to_numpy()
        limits = asking["radius"].to_numpy()
        near = []
        for i, (chosen, distance) in enumerate(nearest(np.stack(asking["x"].to_numpy()), x, k)):
            inside_ball = distance <= limits[i]
            near.append(_candidates(chosen[inside_ball], distance[inside_ball], ids, mult, x))
        return pd.DataFrame({"vid": asking["vid"].to_numpy(), "near": near})

    remote = questions.groupBy("cell").cogroup(placed.groupBy("cell")).applyInPandas(
        across, f"vid string, near array<{CANDIDATE}>")
    found = remote.groupBy("vid").agg(F.flatten(F.collect_list("near")).alias("more"))
    joined = local.select("vid", "x", "mult", "near").join(found, "vid", "left")
    everything = F.concat("near", F.coalesce("more", F.array().cast(f"array<{CANDIDATE}>")))
    return joined.select("vid", "x", "mult", F.slice(F.array_sort(everything), 1, k).alias("near"))
