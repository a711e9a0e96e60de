"""Model queries. Their results depend on the learner, so they have no SQL twin
except where only the rows of each class are counted."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlog.learning import forest
from wardlog.learning.detector import Detector
from wardlog.learning.smote import smote
from wardlog.operators import features as ft
from wardlog.operators import metrics as M
from wardlog.plans import pipeline
from wardlog.plans.parse_queries import PARSED, ssh_events
from wardlog.plans.registry import query
from wardlog.plans.report_queries import _sources
from wardlog.session import materialize, scratch_path


def _features(spark, sf_dir):
    """Feature rows with their label, written once for the repeated passes of a learner."""
    rows = ft.prepare_features(ssh_events(spark, sf_dir))
    return materialize(rows.select("event_id", "is_attack", *ft.model_columns(rows)), "model-features")


@query("smote", views=("auth_log",), ctes=PARSED, sql="""
with c as (select count(*) filter (where is_attack) as hits, count(*) filter (where not is_attack) as others from ssh)
select true as is_attack, false as synthetic, hits as n from c union all select false, false, others from c
union all select hits < others, true, abs(hits - others) from c""")
def smote_query(spark, sf_dir):
    rows = _features(spark, sf_dir)
    return smote(rows, ft.model_columns(rows), "is_attack", "event_id").groupBy("is_attack", "synthetic").agg(
        F.count(F.lit(1)).alias("n"))


@query("rf_train_score")
def rf_train_score(spark, sf_dir):
    detector = Detector("random_forest")
    result = detector.train(ssh_events(spark, sf_dir), "event_id", use_cv=False)
    return result.metrics.withColumn("confusion_matrix", F.to_json("confusion_matrix"))


@query("feature_importance")
def feature_importance(spark, sf_dir):
    rows = _features(spark, sf_dir)
    model = forest.train_forest(rows, ft.model_columns(rows), "is_attack")
    return forest.feature_importance(model, rows)


@query("cross_validation")
def cross_validation(spark, sf_dir):
    rows = _features(spark, sf_dir)
    return forest.cross_validate(rows, ft.model_columns(rows), "is_attack", "event_id")


@query("grid_search")
def grid_search(spark, sf_dir):
    rows = _features(spark, sf_dir)
    fitted, grid = forest.search(rows, ft.model_columns(rows), "is_attack", "event_id", folds=2, trees=(5, 10), depths=(5,))
    return forest.search_report(fitted, grid, rows)


def _unsupervised(spark, sf_dir, kind):
    detector = Detector(kind)
    events = ssh_events(spark, sf_dir)
    detector.train(events, "event_id", threshold_mode="tail")
    return M.anomaly_rate(detector.predict(events))


@query("iforest_score")
def iforest_score(spark, sf_dir):
    return _unsupervised(spark, sf_dir, "isolation_forest")


@query("ocsvm_score")
def ocsvm_score(spark, sf_dir):
    return _unsupervised(spark, sf_dir, "one_class_svm")


@query("holdout_unsupervised")
def holdout_unsupervised(spark, sf_dir):
    detector = Detector("isolation_forest")
    return detector.train(ssh_events(spark, sf_dir), "event_id", time_split=True).report


@query("train_unified")
def train_unified(spark, sf_dir):
    """The job itself: sources merged, rebalanced and cleaned, the forest trained, saved and measured."""
    result = pipeline.train_unified(spark, _sources(spark, sf_dir), scratch_path(spark, "unified-model"),
                                    scratch_path(spark, "unified-metrics"), ratio=0.3, use_cv=False)
    return result.report
