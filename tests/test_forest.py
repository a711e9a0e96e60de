"""The forest against Spark ML where nothing is drawn, and against itself elsewhere."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlog.learning import forest
from wardlog.learning import trees as tr
from wardlog.learning.detector import Detector
from wardlog.operators.balance import stratified_folds


@pytest.fixture(scope="module")
def noisy(spark):
    """Rows whose labels hardly follow their features, so trees go deep. As many of each class: weights are 1, sums exact."""
    rng = np.random.default_rng(3)
    hour, user = rng.integers(0, 24, 3000), rng.integers(0, 300, 3000)
    hostile = (rng.random(3000) + 0.3 * (user % 7 == 0)).argsort().argsort() >= 1500
    data = [(i, int(h), float(u), bool(y)) for i, (h, u, y) in enumerate(zip(hour, user, hostile))]
    return spark.createDataFrame(data, "id long, hour int, user double, y boolean").cache()


def scores(frame):
    return np.array([r.ml_anomaly_score for r in frame.select("id", "ml_anomaly_score").orderBy("id").collect()])


def jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def exhaustive(x, y, w):
    """The best Gini gain of all splits of all columns."""
    gini = lambda y: 1 - sum((w[c] * (y == c).sum() / w[y].sum()) ** 2 for c in (0, 1))
    best = (0.0, -1, 0)
    for f in range(x.shape[1]):
        for cut in range(x[:, f].max()):
            low = x[:, f] <= cut
            if low.any() and not low.all():
                a, b = w[y[low]].sum() / w[y].sum(), w[y[~low]].sum() / w[y].sum()
                gain = gini(y) - a * gini(y[low]) - b * gini(y[~low])
                if gain > best[0] + 1e-12:
                    best = (gain, f, cut)
    return best


def test_tree_takes_the_best_split_of_every_node():
    rng = np.random.default_rng(1)
    x, y, w = rng.integers(0, 9, (200, 3)), rng.integers(0, 2, 200), np.array([0.7, 1.6])
    tree = tr.grow(np.ascontiguousarray(x.T.astype(np.uint8)), np.stack([y == 0, y == 1]).astype(int), w, np.random.default_rng(0), 4, 3, 1)
    pending, inner = [(0, np.arange(200))], 0
    while pending:
        node, rows = pending.pop()
        assert tree["rows"][:, node].tolist() == [(y[rows] == 0).sum(), (y[rows] == 1).sum()]
        if tree["feature"][node] < 0:
            continue
        inner += 1
        gain, _, _ = exhaustive(x[rows], y[rows], w)
        assert tree["gain"][node] == pytest.approx(gain)
        low = x[rows, tree["feature"][node]] <= tree["cut"][node]
        pending += [(tree["left"][node], rows[low]), (tree["left"][node] + 1, rows[~low])]
    assert inner > 8


def test_borders_are_sparks():
    """All midpoints of few values; of many, about equal weight between."""
    few = np.array([1.0, 2.0, 5.0])
    assert tr.thresholds(few, few, np.ones(3)) == [1.5, 3.5]
    many = np.arange(320.0)
    assert tr.thresholds(many, many, np.ones(320)) == [10 * i + 9.5 for i in range(31)]


def test_levels_of_a_tree_need_no_jobs(spark, noisy):
    """A hundred trees of any depth are grown in one stage, not in a job for each level."""
    model, flat = jobs(spark, "flat", lambda: forest.train_forest(noisy, ["hour", "user"], "y", depth=2))
    model, deep = jobs(spark, "deep", lambda: forest.train_forest(noisy, ["hour", "user"], "y"))
    assert deep <= flat + 2 and len({r.tree for r in model.subtrees.select("tree").collect()}) == 100


def test_cross_validation_trains_each_fold_on_the_others(spark, noisy):
    """The mean over folds of forests trained by hand, in a number of jobs that does not follow the depth."""
    (got,), n = jobs(spark, "folds", lambda: forest.cross_validate(noisy, ["hour", "user"], "y", "id", folds=3, trees=7).collect())
    folds, by_hand = stratified_folds(noisy, "y", "id", 3).cache(), []
    for i in range(3):
        model = forest.train_forest(folds.where(F.col("fold") != i), ["hour", "user"], "y", trees=7)
        told = forest.predict_forest(model, folds.where(F.col("fold") == i)).select("y", "ml_anomaly").collect()
        hit, flagged, hostile = (sum(x) for x in zip(*[(r.y and r.ml_anomaly, r.ml_anomaly, r.y) for r in told]))
        by_hand.append(2 * hit / (flagged + hostile))
    assert got.mean_f1 == pytest.approx(np.mean(by_hand)) and got.two_std == pytest.approx(2 * np.std(by_hand))
    assert n < 3 * 45



@pytest.mark.parametrize("cells,dealt", [(2_000_000, 200_000_000), (60, 200_000_000), (8, 1)])
def test_one_tree_of_two_features_equals_spark_ml(noisy, monkeypatch, cells, dealt):
    """Without bagging, and with both of two features at every node, nothing is drawn. Also with levels split by all tasks."""
    monkeypatch.setattr(forest, "SUBTREE_CELLS", cells)
    monkeypatch.setattr(forest, "DEALT_CELLS", dealt)
    other = forest.pipeline(["hour", "user"], forest.classifier(1).setBootstrap(False)).fit(forest.with_label(noisy, "y").coalesce(1))
    model = forest.train_forest(noisy, ["hour", "user"], "y", trees=1, bootstrap=False)
    assert (len(model.tops[0]["feature"]) > 3) == (cells < 100)
    assert np.allclose(scores(forest.predict_forest(model, noisy)), scores(forest.predict_forest(other, noisy)), atol=1e-12)
    told = [{r.feature: r.importance for r in forest.feature_importance(m, noisy).collect()} for m in (model, other)]
    assert told[0] == pytest.approx(told[1])



def test_saved_forest_keeps_split_levels(spark, noisy, tmp_path, monkeypatch):
    monkeypatch.setattr(forest, "SUBTREE_CELLS", 8)
    detector = Detector("random_forest", ["hour", "user"])
    detector.model = forest.train_forest(noisy, detector.features, "y", trees=2)
    detector.save(spark, str(tmp_path / "m"))
    back = Detector.load(spark, str(tmp_path / "m")).model
    assert back.merged and back.state() == detector.model.state()
    assert (scores(forest.predict_forest(back, noisy)) == scores(forest.predict_forest(detector.model, noisy))).all()



def test_forest_does_not_depend_on_the_layout(noisy):
    """Draws belong to cells, not to partitions."""
    some = [forest.train_forest(rows, ["hour", "user"], "y", trees=5) for rows in (noisy, noisy.orderBy("user").repartition(5))]
    assert some[0].importances == some[1].importances
    assert (scores(forest.predict_forest(some[0], noisy)) == scores(forest.predict_forest(some[1], noisy.repartition(3)))).all()


def test_rows_without_a_drawn_tree(spark):
    """With two rows some trees draw none; they take no part in the mean."""
    rows = spark.createDataFrame([(1, 0.0, False), (2, 5.0, True)], "id long, a double, y boolean")
    model = forest.train_forest(rows, ["a"], "y", trees=30)
    assert model.subtrees.count() < 30
    low, high = scores(forest.predict_forest(model, rows))
    assert 0 <= low < 0.5 < high <= 1


def test_missing_values_and_wrong_labels(spark, noisy):
    rows = noisy.withColumn("user", F.when(F.col("id") % 4 > 0, F.col("user")))
    model = forest.train_forest(rows, ["hour", "user"], "y", trees=3)
    assert len(scores(forest.predict_forest(model, rows))) == 3000
    with pytest.raises(Exception, match="y must be 0 or 1"):
        forest.train_forest(noisy.withColumn("y", F.lit(2)), ["hour"], "y", trees=2)
    with pytest.raises(ValueError, match="no rows"):
        forest.train_forest(noisy.limit(0), ["hour"], "y", trees=2)
    one = forest.train_forest(noisy.withColumn("y", F.lit(False)), ["hour"], "y", trees=2)
    assert not scores(forest.predict_forest(one, noisy)).any()



def test_borders_of_many_values(noisy, monkeypatch):
    """Beyond ``VALUES`` distinct values borders come from ranges of about equal numbers of rows."""
    rows = noisy.withColumn("user", F.col("user") + F.col("id") / 10_000)
    exact, counts = forest.feature_borders(rows, ["user", "hour"], "y")
    monkeypatch.setattr(forest, "VALUES", 500)
    near, again = forest.feature_borders(rows.repartition(7), ["user", "hour"], "y")
    assert near[1] == exact[1] and len(near[1]) == 23 and (counts == again).all() and counts.sum() == 3000
    assert len(near[0]) == len(exact[0]) == 31 and np.allclose(near[0], exact[0], atol=3)


def test_split_levels_and_whole_trees_agree(noisy, monkeypatch):
    """Forests differ in what they draw, not in what they tell."""
    train = lambda: forest.train_forest(noisy, ["hour", "user"], "y", trees=40)
    whole = train()
    monkeypatch.setattr(forest, "SUBTREE_CELLS", 100)
    split = train()
    assert split.subtrees.count() > 100 and split.importances == pytest.approx(whole.importances, abs=0.05)
    a, b = (scores(forest.predict_forest(m, noisy)) for m in (whole, split))
    assert np.corrcoef(a, b)[0, 1] > 0.97 and abs(a - b).mean() < 0.05
