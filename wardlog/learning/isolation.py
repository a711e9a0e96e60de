"""Isolation forest (Liu, Ting and Zhou, 2008) on Spark.

Every tree grows from a fixed-size subsample, so the trees are small however
large the table is: one task builds one tree from at most ``sample`` rows, and
the finished forest is a few thousand nodes that scoring tasks carry along.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlog.operators.keyed import hash_order, lowest_by_hash

NODE = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("cut", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("path", T.DoubleType())])
EULER_GAMMA = 0.5772156649


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def grow_tree(tree: int, x: np.ndarray, seed: int) -> pd.DataFrame:
    """One random tree as node rows; a leaf has feature -1 and its path length."""
    rng = np.random.default_rng([seed, tree])
    limit = max(1, math.ceil(math.log2(max(2, len(x)))))
    rows: list[list[float]] = []
    pending = [(np.arange(len(x)), 0, None, 0)]
    while pending:
        members, depth, parent, side = pending.pop()
        node = len(rows)
        rows.append([tree, node, -1, 0.0, -1, -1, depth + average_path(len(members))])
        if parent is not None:
            rows[parent][4 + side] = node
        if depth >= limit or len(members) < 2:
            continue
        low, high = x[members].min(axis=0), x[members].max(axis=0)
        usable = np.flatnonzero(high > low)
        if not len(usable):
            continue
        feature = int(rng.choice(usable))
        cut = rng.uniform(low[feature], high[feature])
        goes_left = x[members, feature] < cut
        rows[node][2:4] = [feature, cut]
        pending.append((members[goes_left], depth + 1, node, 0))
        pending.append((members[~goes_left], depth + 1, node, 1))
    return pd.DataFrame(rows, columns=NODE.names)


@dataclass
class IsolationForestModel:
    """A fitted forest; ``nodes`` has one row per tree node."""

    features: list[str]
    sample: int
    nodes: pd.DataFrame

    def arrays(self) -> dict[str, np.ndarray]:
        """Nodes of all trees in one numbering: children point past their tree's base."""
        ordered = self.nodes.sort_values(["tree", "node"])
        sizes = ordered.groupby("tree").size()
        base = (sizes.cumsum() - sizes).reindex(ordered["tree"]).to_numpy()
        leaf = ordered["feature"].to_numpy() < 0
        own = np.arange(len(ordered))
        return {
            "roots": (sizes.cumsum() - sizes).to_numpy(),
            "feature": np.where(leaf, 0, ordered["feature"].to_numpy()),
            "cut": ordered["cut"].to_numpy(),
            "left": np.where(leaf, own, ordered["left"].to_numpy() + base),
            "right": np.where(leaf, own, ordered["right"].to_numpy() + base),
            "path": ordered["path"].to_numpy()}

    def score(self, df: DataFrame, column: str = "score") -> DataFrame:
        """Add the score of each row: between -1 and 0, lower is more anomalous."""
        a, unit, depth = self.arrays(), average_path(self.sample), math.ceil(math.log2(max(2, self.sample)))

        @F.pandas_udf("double")
        def scored(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype="float64")
            x = np.stack(features.to_numpy())
            rows = np.arange(len(x))
            total = np.zeros(len(x))
            for root in a["roots"]:
                at = np.full(len(x), root)
                for _ in range(depth):
                    left = x[rows, a["feature"][at]] < a["cut"][at]
                    at = np.where(left, a["left"][at], a["right"][at])
                total += a["path"][at]
            return pd.Series(-np.exp2(-total / len(a["roots"]) / unit))

        vector = F.array(*[F.col(c).cast("double") for c in self.features])
        return df.withColumn(column, scored(vector))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODE).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: list[str], sample: int) -> IsolationForestModel:
        return cls(features, sample, spark.read.parquet(path).toPandas())


def fit_isolation_forest(df: DataFrame, features: list[str], key: str, trees: int = 100, sample: int = 256,
                         seed: int = 42) -> IsolationForestModel:
    """Fit on hash-drawn subsamples of the whole table.

    A hash bound draws ``trees * sample`` rows without a shuffle, and each tree gets its own ``sample`` of
    them; a table with fewer rows is dealt to the trees in turn, every tree drawing from all its rows.
    """
    spark = df.sparkSession
    slim = df.select(F.col(key).cast("string").alias("_key"),
                     F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    wanted = trees * sample
    total = slim.count()
    quota = spark.range(1).select(F.lit(min(wanted, total)).alias("rank"), F.lit(total).alias("n"))
    order = hash_order(F.col("_key"), seed)
    if total > wanted:
        # Bounded by trees * sample rows from here on; consecutive places in hash order make one tree's sample.
        drawn = lowest_by_hash(slim, [], order, quota).where("_picked")
        place = F.row_number().over(Window.orderBy(order)) - 1
        subsamples = drawn.select("_key", "x", place.alias("_place")).select(
            "_key", "x", F.floor(F.col("_place") / sample).cast("int").alias("tree"), "_place").withColumnRenamed("_place", "_nth")
    else:
        spread = slim.select("_key", "x", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
        nth = F.row_number().over(Window.partitionBy("tree").orderBy(F.md5(F.concat_ws("#", "_key", "tree"))))
        subsamples = spread.withColumn("_nth", nth).where(F.col("_nth") <= sample)

    def build(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values("_nth")
        return grow_tree(int(group[0]), np.stack(ordered["x"].to_numpy()), seed)

    nodes = subsamples.groupBy("tree").applyInPandas(build, NODE)
    # At most trees * (2 * sample - 1) rows by construction.
    collected = nodes.toPandas()
    largest = int(min(sample, total))
    return IsolationForestModel(features, largest, collected)
