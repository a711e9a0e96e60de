import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlog.learning import forest
from wardlog.learning.detector import Detector
from wardlog.learning.isolation import average_path, fit_isolation_forest, grow_tree
from wardlog.learning.oneclass import fit_one_class, fourier_features
from wardlog.learning.smote import handle_imbalance, smote
from wardlog.operators import metrics as M

COLUMNS = list("abcd")


@pytest.fixture(scope="module")
def planted(spark):
    """Two thousand ordinary rows and forty far away."""
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (2000, 4)), rng.normal(6, 1, (40, 4))])
    data = [(i, *map(float, r), i >= 2000) for i, r in enumerate(x)]
    return spark.createDataFrame(data, "id long, a double, b double, c double, d double, y boolean").cache()


@pytest.fixture(scope="module")
def logins(spark):
    """Hourly logins of two addresses; one of them fails a lot."""
    i = F.col("id")
    hostile = i % 5 == 0
    return spark.range(400).select(
        i.alias("event_id"), F.expr("timestamp'2025-01-01' + make_interval(0,0,0,0,int(id))").alias("timestamp"),
        F.when(hostile, "10.0.0.1").otherwise(F.concat(F.lit("10.0.1."), i % 9)).alias("source_ip"),
        F.when(hostile, "root").otherwise(F.concat(F.lit("u"), i % 7)).alias("user"),
        F.when(hostile, "failed").otherwise("accepted").alias("status"), hostile.alias("is_attack"))


def auc(scored, column="score"):
    return M.roc_auc(scored.withColumn("s", -F.col(column)), "y", "s").first().roc_auc


def test_isolation_forest_finds_outliers_and_repeats(planted):
    first = fit_isolation_forest(planted, COLUMNS, "id", trees=30)
    again = fit_isolation_forest(planted.repartition(3), COLUMNS, "id", trees=30)
    assert first.nodes.sort_values(["tree", "node"]).reset_index(drop=True).equals(
        again.nodes.sort_values(["tree", "node"]).reset_index(drop=True))
    assert auc(first.score(planted)) > 0.99


def test_forest_scores_follow_the_trees(planted):
    model = fit_isolation_forest(planted, COLUMNS, "id", trees=3, sample=32)
    row = planted.where("id = 17").first()
    depths = []
    for _, tree in model.nodes.groupby("tree"):
        nodes = tree.set_index("node")
        at = 0
        while nodes.at[at, "feature"] >= 0:
            below = row[COLUMNS[nodes.at[at, "feature"]]] < nodes.at[at, "cut"]
            at = nodes.at[at, "left" if below else "right"]
        depths.append(nodes.at[at, "path"])
    got = model.score(planted.where("id = 17")).first().score
    assert got == pytest.approx(-2 ** (-np.mean(depths) / average_path(32)))


def test_tree_of_equal_rows_is_a_leaf():
    assert len(grow_tree(0, np.ones((8, 2)), 1)) == 1


def test_one_class_machine_ranks_outliers(planted):
    assert auc(fit_one_class(planted, COLUMNS, iterations=4).score(planted)) > 0.95


def test_one_class_machine_meets_its_gap(planted):
    """Against many plain steps over all rows, sorted anew each time."""
    model = fit_one_class(planted, COLUMNS, tolerance=0.005)
    phi = fourier_features(np.array([[r[c] for c in COLUMNS] for r in planted.collect()]), model.omega, model.phase)
    wanted, w = 204, phi.mean(axis=0)
    for step in range(2000):
        lowest = phi[np.argsort(phi @ w, kind="stable")[:wanted]].mean(axis=0)
        d = lowest - w
        w = w + np.clip(-w @ d / (d @ d), 0, 1) * d
    assert 0 <= model.gap <= 0.005
    reached, least = model.weights @ model.weights, w @ w
    assert least * (1 - 1e-6) <= reached and (reached - least) / 2 <= 0.005 * reached
    exact, got = phi @ w, phi @ model.weights
    assert np.corrcoef(exact, got)[0, 1] > 0.99
    assert len(set(np.argsort(exact)[:wanted]) & set(np.argsort(got)[:wanted])) >= 0.9 * wanted


def test_one_class_machine_of_few_rows(spark):
    one = spark.createDataFrame([(1.0, 2.0)] * 3, "a double, b double")
    model = fit_one_class(one, ["a", "b"])
    phi = fourier_features(np.array([[1.0, 2.0]]), model.omega, model.phase)[0]
    assert 0 <= model.gap <= 0.01 and np.allclose(model.weights, phi)
    assert not fit_one_class(one.limit(0), ["a", "b"]).weights.any()


def test_smote_evens_classes_between_neighbours(spark):
    rng = np.random.default_rng(1)
    data = [(i, float(rng.normal(0, 1)), float(rng.normal(0, 1)), False) for i in range(90)]
    data += [(100 + i, 10.0 + i % 5, 10.0, True) for i in range(9)] + [(200 + i, 50.0, 50.0, True) for i in range(8)]
    df = spark.createDataFrame(data, "id long, a double, b double, y boolean")
    out = smote(df, ["a", "b"], "y", "id").cache()
    assert {(r.y, r.synthetic): r["count"] for r in out.groupBy("y", "synthetic").count().collect()} == {
        (False, False): 90, (True, False): 17, (True, True): 73}
    made = out.where("synthetic").collect()
    # Eight copies at (50, 50) only have each other; the rest lie on the line b = 10.
    assert all((r.a, r.b) == (50.0, 50.0) or (r.b == 10.0 and 10.0 <= r.a <= 14.0) for r in made)
    assert any(r.b == 10.0 and r.a != int(r.a) for r in made)


def test_smote_with_even_classes_adds_nothing(spark):
    df = spark.range(20).select("id", F.rand(1).alias("a"), (F.col("id") % 2 == 0).alias("y"))
    assert smote(df, ["a"], "y", "id").count() == 20


@pytest.mark.parametrize("method,rows_out", [("undersample", 16), ("oversample", 44), ("smote", 44), ("other", 30)])
def test_imbalance_methods(spark, method, rows_out):
    df = spark.range(30).select("id", (F.col("id") * 1.5).alias("a"), (F.col("id") < 8).alias("y"))
    assert handle_imbalance(df, "y", "id", method).count() == rows_out
    assert handle_imbalance(df, "none", "id", method).count() == 30


def test_smote_leaves_tiny_classes(spark):
    df = spark.range(30).select("id", (F.col("id") * 1.5).alias("a"), (F.col("id") < 5).alias("y"))
    assert smote(df, ["a"], "y", "id").count() == 30


def test_forest_search(planted):
    fitted, grid = forest.search(planted, COLUMNS, "y", "id", folds=2, trees=(3, 6), depths=(3,), min_split=(2,))
    report = forest.search_report(fitted, grid, planted).collect()
    assert [(r.trees, r.depth) for r in report] == [(3, 3), (6, 3)] and all(r.mean_f1 > 0.9 for r in report)


@pytest.mark.parametrize("kind", ["random_forest", "isolation_forest", "one_class_svm"])
def test_train_save_load_predict(spark, logins, tmp_path, kind):
    detector = Detector(kind)
    result = detector.train(logins, "event_id", use_cv=False, trees=10, depth=5, time_split=kind != "random_forest")
    if kind == "random_forest":
        assert result.metrics.first().f1 == 1.0 and result.importance.count() == 7
    assert result.report.count() == 5
    out = detector.predict(logins)
    assert dict(out.dtypes)["ml_anomaly"] == "boolean" and out.count() == 400
    detector.save(spark, str(tmp_path / "m"))
    back = Detector.load(spark, str(tmp_path / "m")).predict(logins)
    pick = lambda f: sorted((r.event_id, r.ml_anomaly, round(r.ml_anomaly_score, 9)) for r in f.collect())
    assert pick(out) == pick(back)


def test_threshold_modes(logins):
    shares = {}
    for mode in ("reference", "tail"):
        detector = Detector("isolation_forest")
        detector.train(logins, "event_id", contamination=0.2, trees=20, threshold_mode=mode)
        shares[mode] = M.anomaly_rate(detector.predict(logins)).first().rate
    assert shares["tail"] <= 0.2 < 0.5 < shares["reference"]


def test_balanced_training_and_cross_validation(logins):
    detector = Detector("random_forest")
    result = detector.train(logins, "event_id", cv_folds=2, handle_imbalance=True, trees=5, depth=4)
    assert result.cross_validation.first().mean_f1 > 0.9 and result.metrics.first().roc_auc == 1.0


def test_errors(logins):
    with pytest.raises(ValueError):
        Detector("other")
    with pytest.raises(ValueError):
        Detector("random_forest").predict(logins)
    with pytest.raises(ValueError):
        Detector("random_forest").train(logins.drop("is_attack"), "event_id")
