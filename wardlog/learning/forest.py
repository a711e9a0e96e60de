"""Random forest: training by cells, cross-validation, and grid search on Spark ML.

Trees read a feature through at most 32 bins, so rows with the same bins and label are the same to them. ``train_forest`` counts
rows by cell (a vector of bins), which Spark does in one aggregation, deals the counted cells of every tree to tasks and grows
subtrees there (``trees``). A table with more cells than a task holds has the upper levels of its trees split by
histograms of all tasks first. The rules are those of Spark ML's forest: bins by weighted quantiles, Poisson bagging, the
features of a node drawn anew, weighted Gini gain, leaves of one vote merged, probabilities averaged over trees.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wardlog.learning import trees as tr
from wardlog.operators import metrics as M
from wardlog.operators.balance import SEED, stratified_folds
from wardlog.operators.keyed import running_totals, scalar
from wardlog.session import materialize

# Spark bounds the depth of a tree at 30; an unlimited depth is asked for as that.
MAX_DEPTH = 30
# The hyper-parameter grid (None stands for unlimited depth).
GRID_TREES = (50, 100, 200)
GRID_DEPTHS = (10, 20, None)
GRID_MIN_SPLIT = (2, 5)
# Statistics of so many megabytes are gathered at once for the open nodes of all trees; deep forests have hundreds of thousands.
NODE_MEMORY_MB = 1024
# Every partition sends the statistics of every open node, so there is one for so many rows and not one for each small file.
ROWS_PER_PARTITION = 100_000
# A feature's borders come from all its values, or from so many ranges of about equal numbers of rows.
VALUES = 10_000
# Cells are dealt to so many blocks by a hash; a block's draws depend on its number, not on the layout of the table.
BLOCKS = 64
# A task grows a subtree of so many cells at most.
SUBTREE_CELLS = 2_000_000
# So many cells, counted once for each tree, are shuffled at once.
DEALT_CELLS = 200_000_000
# Dealt cells leave a worker in batches of so many bytes.
BATCH_BYTES = 4 << 20


def gathered(df: DataFrame) -> DataFrame:
    """A stored table in few partitions for training; large tables keep theirs."""
    return df.coalesce(max(1, df.count() // ROWS_PER_PARTITION))


def with_label(df: DataFrame, label: str) -> DataFrame:
    """Numeric ``_label`` and balanced class weights ``_weight``."""
    y = F.col(label).cast("int").cast("double")
    counts = scalar(df, F.struct(F.count(F.lit(1)).alias("n"), F.sum(y).alias("pos")))
    own = F.when(y == 1, counts["pos"]).otherwise(counts["n"] - counts["pos"])
    return df.withColumn("_label", y).withColumn("_weight", counts["n"] / (2.0 * own))


def classifier(trees: int = 100, depth: int | None = None, min_split: int = 2, seed: int = SEED) -> RandomForestClassifier:
    # A node of fewer than min_split rows is not split: both halves need a row at least.
    return RandomForestClassifier(
        featuresCol="_features", labelCol="_label", weightCol="_weight", numTrees=trees,
        maxDepth=min(depth or MAX_DEPTH, MAX_DEPTH), maxMemoryInMB=NODE_MEMORY_MB, minInstancesPerNode=max(1, min_split // 2),
        featureSubsetStrategy="sqrt", seed=seed)


def pipeline(features: list[str], stage: RandomForestClassifier) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep"), stage])


@dataclass
class ForestModel:
    """A trained forest. ``subtrees`` has one row per subtree: its nodes below the end ``part`` of the tree's upper levels."""

    features: list[str]
    borders: list[list[float]]
    trees: int
    tops: list[dict[str, list]]
    merged: dict[str, float]
    importances: list[float]
    subtrees: DataFrame

    def state(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "subtrees"}

    def save(self, path: str) -> None:
        self.subtrees.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, state: dict) -> ForestModel:
        return cls(subtrees=spark.read.schema(SUBTREE).parquet(path), **state)


SUBTREE = "tree int, part int, feature binary, cut binary, left binary, share binary"
GROWN = f"{SUBTREE}, leaf boolean, rows binary, worth binary"
BLOCK = "block int, bins binary, counts binary"
DEALT = "tree int, part int, block int, place binary, bins binary, counts binary"


def _bin(value: Column, borders: list[float], low: int = 0) -> Column:
    """The number of borders below a value, by bisection; a missing value is above all."""
    if not borders:
        return F.lit(low).cast("byte")
    middle = len(borders) // 2
    above = _bin(value, borders[middle + 1:], low + middle + 1)
    return F.when(value > F.lit(borders[middle]), above).otherwise(_bin(value, borders[:middle], low))


def _number(feature: str) -> Column:
    return F.coalesce(F.col(feature).cast("double"), F.lit(float("nan")))


def _binned(df: DataFrame, features: list[str], borders: list[list[float]]) -> DataFrame:
    # Two steps: the borders are compared with a column, not with its expression again and again.
    numbers = df.withColumns({f"_x{i}": _number(c) for i, c in enumerate(features)})
    return numbers.withColumns({f"_b{i}": _bin(F.col(f"_x{i}"), x) for i, x in enumerate(borders)}).drop(
        *[f"_x{i}" for i in range(len(features))])


def _bins(features: list[str]) -> list[str]:
    return [f"_b{i}" for i in range(len(features))]


def _class_counts(label: str) -> list[Column]:
    y = F.col(label).cast("int")
    wrong = F.raise_error(F.lit(f"{label} must be 0 or 1")).cast("int")
    checked = F.when(y.isin(0, 1), y).otherwise(wrong)
    return [F.count_if(checked == 0).alias("n0"), F.count_if(checked == 1).alias("n1")]


def feature_borders(df: DataFrame, features: list[str], label: str) -> tuple[list[list[float]], np.ndarray]:
    """The borders of every feature's bins, and the rows of both classes; one scan counts all values."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), _number(c).alias("x")) for i, c in enumerate(features)]))
    tall = df.select(F.col(label).alias("_y"), pairs.alias("_p")).select("_y", "_p.f", "_p.x")
    values = materialize(tall.groupBy("f", "x").agg(*_class_counts("_y")), "feature-values")
    sizes = {r.f: r for r in values.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect()}
    if not sizes:
        raise ValueError("no rows to train on")
    rows = np.array([sizes[0].n0, sizes[0].n1], float)
    known = values.where(~F.isnan("x"))
    large = [f for f, r in sizes.items() if r.n > VALUES]
    ranges = known.where(~F.col("f").isin(large)).select("f", F.col("x").alias("low"), F.col("x").alias("high"), "n0", "n1")
    if large:
        upto = running_totals(known.where(F.col("f").isin(large)).withColumn("n", F.col("n0") + F.col("n1")), ["f", "x"], {"upto": "n"})
        step = max(1, int(rows.sum()) // VALUES)
        ranges = ranges.unionByName(upto.groupBy("f", F.floor(F.col("upto") / step)).agg(
            F.min("x").alias("low"), F.max("x").alias("high"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).select(
            "f", "low", "high", "n0", "n1"))
    found = ranges.toPandas().sort_values(["f", "low"])
    weights = class_weights(rows)
    borders = []
    for f in range(len(features)):
        own = found[found["f"] == f]
        weight = own["n0"].to_numpy() * weights[0] + own["n1"].to_numpy() * weights[1]
        borders.append(tr.thresholds(own["low"].to_numpy(), own["high"].to_numpy(), weight))
    return borders, rows


def class_weights(rows: np.ndarray) -> np.ndarray:
    """Both classes weigh the same in all."""
    return np.divide(rows.sum() / 2.0, rows, out=np.zeros(2), where=rows > 0)


def _spread(df: DataFrame) -> int:
    """Blocks go to a few tasks for each core."""
    return min(BLOCKS, 3 * df.sparkSession.sparkContext.defaultParallelism)


def _blocks(cells: DataFrame, features: list[str]) -> DataFrame:
    """Cells by block, in order of their bins; ``counts`` holds both classes."""
    names, k = _bins(features), len(features)

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        bins = np.stack([table[c].to_numpy() for c in names]).astype(np.uint8)
        counts = np.stack([table[c].to_numpy() for c in ("n0", "n1")]).astype(np.int64)
        order = np.lexsort(bins[::-1])
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "bins": [bins[:, order].tobytes()],
                         "counts": [counts[:, order].tobytes()]})
    slim = cells.select(*names, "n0", "n1", F.pmod(F.xxhash64(*names), F.lit(BLOCKS)).cast("int").alias("_block"))
    return slim.repartition(_spread(cells), "_block").groupBy("_block").applyInArrow(pack, BLOCK)


def _read(row: dict, k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["bins"], np.uint8).reshape(k, -1), np.frombuffer(row["counts"], np.int64).reshape(2, -1)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(schema))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), schema.types)], schema=schema)


def _arrays(top: dict[str, list]) -> dict[str, np.ndarray]:
    kinds = {"feature": np.int64, "cut": np.int64, "left": np.int64}
    return {name: np.array(top[name], kind) for name, kind in kinds.items()}


def _upper_levels(blocks: DataFrame, k: int, trees: int, depth: int, slots: int, least: int, weights: np.ndarray, seed: int,
                  cells: int, bootstrap: bool) -> list[dict[str, list]]:
    """The levels of every tree above nodes of ``SUBTREE_CELLS`` cells; histograms of all blocks are summed for each level."""
    tops = [{"feature": [-1], "cut": [0], "left": [0], "gain": [0.0], "level": [0], "rows": [None]} for _ in range(trees)]
    opened = {t: [0] for t in range(trees)} if cells > SUBTREE_CELLS else {}
    level = 0
    while opened:
        chosen = {t: tr.chosen_features(np.random.default_rng([seed % 2**63, t, BLOCKS + level]), len(x), k, slots) for t, x in opened.items()}
        upper = {t: _arrays(tops[t]) for t in opened}

        def summed(batches):
            sums = {}
            for row in _rows(batches):
                bins, given = _read(row, k)
                for t, nodes in opened.items():
                    counts = tr.bagged(given, seed, t, row["block"], bootstrap)
                    counts = np.concatenate([counts, counts.any(axis=0, keepdims=True)])  # rows of both classes, and cells
                    number = np.full(len(upper[t]["feature"]), -1)
                    number[nodes] = np.arange(len(nodes))
                    at = number[tr.walk(upper[t], bins)]
                    kept = np.flatnonzero((at >= 0) & (counts[2] > 0))
                    found = tr.histograms(np.ascontiguousarray(bins[:, kept]), counts[:, kept], at[kept], chosen[t])
                    sums[t] = sums[t] + found if t in sums else found
            yield from _batches(((t, x.tobytes()) for t, x in sums.items()), sums_schema)

        def choose(key, table):
            t = key[0].as_py()
            found = sum(np.frombuffer(x.as_py()).reshape(slots, 3, -1, tr.BINS) for x in table["found"])
            feature, cut, gain, left = tr.best_splits(found, chosen[t], weights, least)
            split = [feature.tolist(), cut.tolist(), gain.tolist(), left.tolist(), found[0].sum(axis=2).tolist()]
            return pa.table([[t], *[[x] for x in split]], schema=split_schema)
        sums_schema = _arrow("tree int, found binary")
        split_ddl = "tree int, feature array<int>, cut array<int>, gain array<double>, lower array<array<double>>, total array<array<double>>"
        split_schema = _arrow(split_ddl)
        sums = blocks.mapInArrow(summed, "tree int, found binary")
        level += 1
        next_opened = {}
        for r in sums.repartition(min(trees, 200), "tree").groupBy("tree").applyInArrow(choose, split_ddl).collect():
            top, children = tops[r.tree], []
            for i, node in enumerate(opened[r.tree]):
                low, total = np.array(r.lower)[:, i], np.array(r.total)[:, i]
                top["rows"][node] = total[:2].tolist()
                if r.feature[i] < 0:
                    continue
                top["feature"][node], top["cut"][node], top["gain"][node] = r.feature[i], r.cut[i], r.gain[i]
                top["left"][node] = len(top["feature"])
                for part in (low, total - low):
                    if part[2] > SUBTREE_CELLS and part.all() and level < depth:
                        children.append(len(top["feature"]))
                    for name, x in (("feature", -1), ("cut", 0), ("left", 0), ("gain", 0.0), ("level", level), ("rows", part[:2].tolist())):
                        top[name].append(x)
            if children:
                next_opened[r.tree] = children
        opened = next_opened
    return tops


def _tasks(tops: list[dict[str, list]], some: range) -> int:
    """A task for each subtree; beyond a thousand they share."""
    return min(1000, sum(1 for t in some for x in tops[t]["feature"] if x < 0))


def _dealt(blocks: DataFrame, tops: list[dict[str, list]], k: int, some: range, seed: int | None = None,
           bootstrap: bool = False) -> DataFrame:
    """The cells of each subtree; drawn for training, or all as they are without ``seed``. ``place`` is a cell's place in its block."""
    upper, schema = [_arrays(t) for t in tops], _arrow(DEALT)

    def rows(batches):
        for row in _rows(batches):
            bins, given = _read(row, k)
            for t in some:
                counts = given if seed is None else tr.bagged(given, seed, t, row["block"], bootstrap)
                drawn = np.arange(bins.shape[1]) if seed is None else np.flatnonzero(counts.any(axis=0))
                at = tr.walk(upper[t], bins[:, drawn])
                for part in np.unique(at):
                    own = drawn[at == part]
                    place = own.astype(np.int32).tobytes() if seed is None else b""
                    yield t, int(part), row["block"], place, bins[:, own].tobytes(), b"" if seed is None else counts[:, own].tobytes()
    return blocks.mapInArrow(lambda batches: _batches(rows(batches), schema), DEALT).repartition(_tasks(tops, some), "tree", "part")


def _joined(table: pa.Table, k: int, counted: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """The cells of a subtree, block by block."""
    bins = np.concatenate([np.frombuffer(x.as_py(), np.uint8).reshape(k, -1) for x in table["bins"]], axis=1)
    counts = np.concatenate([np.frombuffer(x.as_py(), np.int64).reshape(2, -1) for x in table["counts"]], axis=1) if counted else None
    return bins, counts


def train_forest(df: DataFrame, features: list[str], label: str, trees: int = 100, depth: int | None = None,
                 seed: int = SEED, min_split: int = 2, bootstrap: bool = True) -> ForestModel:
    """Train on all rows; a rerun over the same rows gives the same forest, whatever their layout."""
    k, slots, depth, least = len(features), math.ceil(math.sqrt(len(features))), min(depth or MAX_DEPTH, MAX_DEPTH), max(1, min_split // 2)
    borders, rows = feature_borders(df, features, label)
    weights = class_weights(rows)
    cells = _binned(df.select(*dict.fromkeys([*features, label])), features, borders).groupBy(*_bins(features)).agg(*_class_counts(label))
    blocks = materialize(_blocks(cells, features), "forest-cells")
    n_cells = blocks.agg(F.sum(F.length("bins"))).first()[0] // k
    tops = _upper_levels(blocks, k, trees, depth, slots, least, weights, seed, n_cells, bootstrap)
    levels = [t["level"] for t in tops]
    schema = _arrow(GROWN)

    def build(key: tuple, table: pa.Table) -> pa.Table:
        t, part = (x.as_py() for x in key)
        bins, counts = _joined(table.sort_by("block"), k, True)
        rng = np.random.default_rng([seed % 2**63, t, part, BLOCKS])
        tree = tr.pruned(tr.grow(bins, counts, weights, rng, depth - levels[t][part], slots, least), weights)
        return pa.table([[t], [part], *[[tree[c].tobytes()] for c in ("feature", "cut", "left")], [tr.shares(tree, weights).tobytes()],
                         [bool(tree["feature"][0] < 0)], [tree["rows"][:, 0].tobytes()],
                         [tr.importances(tree, weights, k).tobytes()]], schema=schema)
    at_once = max(1, DEALT_CELLS // max(1, n_cells))
    waves = [_dealt(blocks, tops, k, range(a, min(a + at_once, trees)), seed, bootstrap).groupBy("tree", "part").applyInArrow(build, GROWN)
             for a in range(0, trees, at_once)]
    subtrees = reduce(DataFrame.unionByName, [materialize(x, "forest-trees") for x in waves])
    merged, worth = _finished(tops, subtrees.select("tree", "part", "leaf", "rows", "worth").collect(), weights, k)
    slim = [{name: t[name] for name in ("feature", "cut", "left")} for t in tops]
    return ForestModel(features, borders, trees, slim, merged, worth, subtrees.select(*[f.name for f in T.StructType.fromDDL(SUBTREE)]))


def _finished(tops: list[dict[str, list]], ends: list, weights: np.ndarray, k: int) -> tuple[dict[str, float], list[float]]:
    """The share of subtrees that merge into a leaf of the upper levels, by ``tree:part``, and the importance of every feature."""
    worth, leaves, merged = np.zeros((len(tops), k)), defaultdict(dict), {}
    for r in ends:
        worth[r.tree] += np.frombuffer(r.worth)
        if r.leaf:
            leaves[r.tree][r.part] = np.frombuffer(r.rows)
    for t, top in enumerate(tops):
        own, under = leaves[t], {part: [part] for part in leaves[t]}
        for node in reversed(range(len(top["feature"]))):
            if top["feature"][node] < 0:
                continue
            total = np.array(top["rows"][node])
            pair = [top["left"][node], top["left"][node] + 1]
            vote = lambda x: x[1] * weights[1] > x[0] * weights[0]
            if all(x in own for x in pair) and vote(own[pair[0]]) == vote(own[pair[1]]):
                own[node], under[node] = total, under[pair[0]] + under[pair[1]]
                merged |= {f"{t}:{part}": float(total[1] * weights[1] / (total @ weights)) for part in under[node]}
            else:
                worth[t, top["feature"][node]] += top["gain"][node] * (total @ weights)
    totals = worth.sum(axis=1, keepdims=True)
    each = np.divide(worth, totals, out=np.zeros_like(worth), where=totals > 0).sum(axis=0)
    return merged, (each / each.sum() if each.sum() > 0 else each).tolist()


def _scored_cells(model: ForestModel, cells: DataFrame) -> DataFrame:
    """Cells with ``_share``, the mean share of the positive class over trees."""
    k, names, merged = len(model.features), _bins(model.features), model.merged
    blocks = _blocks(cells.withColumns({"n0": F.lit(0), "n1": F.lit(0)}), model.features)
    told = "tree int, block int, place binary, bins binary, share binary"
    schema = _arrow(told)
    out = ", ".join([*[f"{c} byte" for c in names], "_share double"])
    out_schema = _arrow(out)

    def score(key: tuple, dealt: pa.Table, nodes: pa.Table) -> pa.Table:
        if not (dealt.num_rows and nodes.num_rows):  # a part that no cell asks, or a tree that drew no rows
            share = None
        else:
            row = {c: nodes[c][0].as_py() for c in ("feature", "cut", "left", "share")}
            tree = {"feature": np.frombuffer(row["feature"], np.int8), "cut": np.frombuffer(row["cut"], np.uint8),
                    "left": np.frombuffer(row["left"], np.int32)}
            whole = merged.get(f"{key[0].as_py()}:{key[1].as_py()}")
            share = np.frombuffer(row["share"]) if whole is None else np.full(len(tree["feature"]), whole)
        rows = []
        for i in range(dealt.num_rows):
            bins = dealt["bins"][i].as_py()
            found = b""
            if share is not None:
                found = share[tr.walk(tree, np.frombuffer(bins, np.uint8).reshape(k, -1))].tobytes()
            rows.append((key[0].as_py(), dealt["block"][i].as_py(), dealt["place"][i].as_py(), bins if key[0].as_py() == 0 else b"", found))
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 5, schema.types)], schema=schema)

    def add_up(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("tree")
        places = [np.frombuffer(x.as_py(), np.int32) for x in table["place"]]
        size = 1 + max(int(x.max()) for x in places)
        bins, total, seen = np.zeros((k, size), np.int8), np.zeros(size), np.zeros(size)
        for i, place in enumerate(places):
            if own := table["bins"][i].as_py():
                bins[:, place] = np.frombuffer(own, np.uint8).reshape(k, -1)
            if found := table["share"][i].as_py():
                total[place] += np.frombuffer(found)
                seen[place] += 1
        return pa.table([*bins, total / np.maximum(seen, 1)], schema=out_schema)
    dealt = _dealt(blocks, model.tops, k, range(model.trees))
    nodes = model.subtrees.repartition(_tasks(model.tops, range(model.trees)), "tree", "part")
    shares = dealt.groupBy("tree", "part").cogroup(nodes.groupBy("tree", "part")).applyInArrow(score, told)
    return shares.repartition(_spread(cells), "block").groupBy("block").applyInArrow(add_up, out)


def predict_forest(model: ForestModel | PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``ml_anomaly`` and the attack probability ``ml_anomaly_score``; every cell that occurs is scored once."""
    if isinstance(model, PipelineModel):
        scored = model.transform(df)
        return (scored.withColumn("ml_anomaly", F.col("prediction") == 1.0)
                .withColumn("ml_anomaly_score", vector_to_array("probability")[1])
                .drop("_features", "rawPrediction", "probability", "prediction"))
    names = _bins(model.features)
    rows = _binned(df, model.features, model.borders)
    found = rows.join(_scored_cells(model, rows.select(*names).distinct()), names, "left")
    return found.select(*df.columns, (F.col("_share") > 0.5).alias("ml_anomaly"), F.col("_share").alias("ml_anomaly_score"))


def feature_importance(model: ForestModel | PipelineModel, df: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` features by importance."""
    if isinstance(model, PipelineModel):
        names, weights = model.stages[0].getInputCols(), model.stages[-1].featureImportances.toArray()
    else:
        names, weights = model.features, model.importances
    rows = sorted(zip(names, (float(w) for w in weights)), key=lambda r: (-r[1], r[0]))[:top]
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    return df.sparkSession.createDataFrame(rows, schema)


def f1_evaluator() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol="_label", predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0)


def search(df: DataFrame, features: list[str], label: str, key: str, folds: int = 5, trees=GRID_TREES,
           depths=GRID_DEPTHS, min_split=GRID_MIN_SPLIT, parallelism: int = 2, seed: int = SEED):
    """Cross-validate a grid on hash-stratified folds; returns Spark's model with
    ``avgMetrics`` and ``stdMetrics`` (F1) per grid point and the refitted best model."""
    stage = classifier(seed=seed)
    grid = (ParamGridBuilder()
            .addGrid(stage.numTrees, list(trees))
            .addGrid(stage.maxDepth, [min(d or MAX_DEPTH, MAX_DEPTH) for d in depths])
            .addGrid(stage.minInstancesPerNode, [max(1, m // 2) for m in min_split]).build())
    # Written once: every fold and grid point reads the same assignment.
    split = gathered(materialize(with_label(stratified_folds(df, label, key, folds, seed), label), "folds"))
    validator = CrossValidator(
        estimator=pipeline(features, stage), estimatorParamMaps=grid, evaluator=f1_evaluator(),
        numFolds=folds, foldCol="fold", parallelism=parallelism, seed=seed)
    return validator.fit(split), grid


def search_report(fitted, grid, df: DataFrame) -> DataFrame:
    """One row per grid point: ``trees, depth, min_instances, mean_f1, two_std``."""
    named = [{p.name: v for p, v in point.items()} for point in grid]
    rows = [(p["numTrees"], p["maxDepth"], p["minInstancesPerNode"], float(mean), 2.0 * float(std))
            for p, mean, std in zip(named, fitted.avgMetrics, fitted.stdMetrics)]
    return df.sparkSession.createDataFrame(
        rows, "trees int, depth int, min_instances int, mean_f1 double, two_std double")


def cross_validate(df: DataFrame, features: list[str], label: str, key: str, folds: int = 5, trees: int = 100,
                   depth: int | None = None, seed: int = SEED, parallelism: int = 4) -> DataFrame:
    """Mean F1 and twice its deviation over stratified folds, ``parallelism`` of them trained at a time.

    The folds are stored once and read by every fit; no model is fitted on all rows.
    """
    split = materialize(stratified_folds(df, label, key, folds, seed), "folds")

    def f1(fold: int) -> float:
        model = train_forest(split.where(F.col("fold") != fold), features, label, trees, depth, seed)
        return M.binary_metrics(predict_forest(model, split.where(F.col("fold") == fold)), label, "ml_anomaly").first()["f1"]
    with ThreadPool(parallelism) as pool:
        scores = pool.map(inheritable_thread_target(df.sparkSession)(f1), range(folds))
    return df.sparkSession.createDataFrame(
        [(float(np.mean(scores)), 2.0 * float(np.std(scores)))], "mean_f1 double, two_std double")
