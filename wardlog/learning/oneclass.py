"""Approximate RBF one-class SVM.

The kernel is replaced by random Fourier features (Rahimi and Recht, 2007) and
the dual problem (least squared norm of a weighted mean of the feature vectors, no
row above ``1 / (nu * n)``) is solved by Frank-Wolfe steps with exact line search. A step moves
towards the mean of the ``nu`` share of rows that score lowest now: one pass over the
data, reduced to the sums of a few score bins before it leaves the executors. The bins also
bound the duality gap, at which the steps stop. The gap is that of the problem over random features;
scores approximate those of the exact kernel, they are not equal to them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.session import materialize

# Bins of scores that a pass tells apart.
BINS = 64


def fourier_features(x: np.ndarray, omega: np.ndarray, phase: np.ndarray) -> np.ndarray:
    return np.sqrt(2.0 / len(phase)) * np.cos(x @ omega + phase)


@dataclass
class OneClassModel:
    """Weights over random features; inputs are expected to be scaled."""

    features: list[str]
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    gap: float | None = None  # bound of the duality gap at the stop, relative to the squared norm of the weights

    def score(self, df: DataFrame, column: str = "score") -> DataFrame:
        """Add the score of each row; lower is more anomalous."""
        omega, phase, weights = self.omega, self.phase, self.weights

        @F.pandas_udf("double")
        def scored(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype="float64")
            return pd.Series(fourier_features(np.stack(vectors.to_numpy()), omega, phase) @ weights)

        return df.withColumn(column, scored(F.array(*[F.col(c).cast("double") for c in self.features])))

    def to_dict(self) -> dict:
        return {"omega": self.omega.tolist(), "phase": self.phase.tolist(), "weights": self.weights.tolist(), "gap": self.gap}

    @classmethod
    def from_dict(cls, features: list[str], state: dict) -> OneClassModel:
        return cls(features, np.array(state["omega"]), np.array(state["phase"]), np.array(state["weights"]), state.get("gap"))


def fit_one_class(df: DataFrame, features: list[str], nu: float = 0.1, components: int = 256, iterations: int = 32,
                  seed: int = 42, tolerance: float = 0.01) -> OneClassModel:
    """Fit on scaled columns; ``gamma`` is 1 / (number of features * variance).

    Steps stop once the duality gap is at most ``tolerance`` times the squared norm of the weights, after ``iterations`` at the
    latest; ``gap`` of the model tells the bound reached. Rows are stored in the shared folder once and read once a step.
    No rows give weights of zero.
    """
    spread = [F.coalesce(F.var_pop(c), F.lit(0.0)) for c in features]
    moments = df.agg(*[s.alias(f"v{i}") for i, s in enumerate(spread)],
                     *[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"m{i}") for i, c in enumerate(features)]).first()
    means = np.array([moments[f"m{i}"] for i in range(len(features))])
    # Variance of all matrix cells taken together.
    variance = float(np.mean([moments[f"v{i}"] for i in range(len(features))]) + np.var(means)) or 1.0
    rng = np.random.default_rng(seed)
    omega = rng.normal(0.0, np.sqrt(2.0 / (len(features) * variance)), (len(features), components))
    phase = rng.uniform(0.0, 2.0 * np.pi, components)
    vectors = materialize(df.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x")), "one-class")

    counts, sums = _binned_sums(vectors, omega, phase, np.zeros(components), -1.0, 1.0)
    rows = counts.sum()
    weights, gap = sums.sum(axis=0) / max(rows, 1.0), 0.0
    # No score lies outside: a feature vector is at most sqrt(2) long.
    high = np.sqrt(2.0) * float(np.linalg.norm(weights)) or 1.0
    low = -high
    for _ in range(iterations if rows else 0):
        counts, sums = _binned_sums(vectors, omega, phase, weights, low, high)
        lowest, place, slack = _lowest_mean(counts, sums, nu * rows, (high - low) / BINS)
        step = lowest - weights
        gap = (float(-weights @ step) + float(slack)) / max(float(weights @ weights), 1e-30)
        if gap <= tolerance:
            break
        share = float(np.clip(-weights @ step / max(float(step @ step), 1e-30), 0.0, 1.0))
        # Scores move by no more than this, so the bound of the lowest rows stays between the next limits.
        moved = np.sqrt(2.0) * share * float(np.linalg.norm(step))
        width = (high - low) / BINS
        low, high = low + (place - 1) * width - moved, low + (place + 2) * width + moved
        weights = weights + share * step
    return OneClassModel(features, omega, phase, weights, gap)


def _binned_sums(vectors: DataFrame, omega: np.ndarray, phase: np.ndarray, weights: np.ndarray, low: float,
                 high: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and summed feature vectors by bin of scores, in one pass: the first bin is below ``low``, the last from ``high``."""
    components, width = len(phase), (high - low) / BINS

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((BINS + 2, components + 1))
        for batch in batches:
            if len(batch):
                phi = fourier_features(np.stack(batch["x"].to_numpy()), omega, phase)
                at = np.clip(np.floor((phi @ weights - low) / width), -1, BINS).astype(np.int64) + 1
                order = np.argsort(at, kind="stable")
                met, first = np.unique(at[order], return_index=True)
                sums[met, :-1] += np.add.reduceat(phi[order], first, axis=0)
                sums[:, -1] += np.bincount(at, minlength=BINS + 2)
        for place in np.flatnonzero(sums[:, -1]):
            yield pd.DataFrame({"bin": place, "j": np.arange(components + 1), "v": sums[place]})

    # (BINS + 2) * (components + 1) rows at most, by construction.
    totals = vectors.mapInPandas(partial, "bin long, j long, v double").groupBy("bin", "j").agg(F.sum("v").alias("v"))
    sums = np.zeros((BINS + 2, components + 1))
    for row in totals.collect():
        sums[row["bin"], row["j"]] = row["v"]
    return sums[:, -1], sums[:, :-1]


def _lowest_mean(counts: np.ndarray, sums: np.ndarray, wanted: float, width: float) -> tuple[np.ndarray, int, float]:
    """Mean feature vector of the ``wanted`` lowest rows, the bin in which they end, and by how much their mean score
    may exceed the least possible: all rows of that last bin take part with an equal share."""
    upto = np.cumsum(counts)
    last = min(int(np.searchsorted(upto, wanted - 1e-9)), len(counts) - 1)
    share = min(1.0, (wanted - (upto[last] - counts[last])) / max(counts[last], 1.0))
    mean = (sums[:last].sum(axis=0) + share * sums[last]) / wanted
    return mean, last - 1, share * (1.0 - share) * counts[last] / wanted * width
