"""Train, apply, save and load the three kinds of anomaly detector."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlog.learning import forest
from wardlog.learning.isolation import IsolationForestModel, fit_isolation_forest
from wardlog.learning.oneclass import OneClassModel, fit_one_class
from wardlog.learning.smote import smote
from wardlog.operators import balance
from wardlog.operators import features as ft
from wardlog.operators import metrics as M
from wardlog.session import materialize

MODEL_TYPES = ("random_forest", "isolation_forest", "one_class_svm")
CV_FOLDS_WHEN_TUNING = 3
TEST_SHARE = 0.2


@dataclass
class Evaluation:
    """What a training run learned about itself; every part is a small frame."""

    metrics: DataFrame | None = None
    report: DataFrame | None = None
    cross_validation: DataFrame | None = None
    grid: DataFrame | None = None
    importance: DataFrame | None = None


@dataclass
class Detector:
    """A detector of one of ``MODEL_TYPES``.

    ``unseen`` says how rows with a value that the training rows did not have are coded: by the next free code, or all
    rows anew (``refit``).
    """

    model_type: str = "isolation_forest"
    features: list[str] = field(default_factory=list)
    codes: dict[str, DataFrame] = field(default_factory=dict)
    scaler: dict[str, tuple[float, float]] = field(default_factory=dict)
    threshold: float | None = None
    model: forest.ForestModel | PipelineModel | IsolationForestModel | OneClassModel | None = None
    unseen: str = "next"

    def __post_init__(self) -> None:
        if self.model_type not in MODEL_TYPES:
            raise ValueError(f"model_type must be one of {MODEL_TYPES}")

    # -- features -------------------------------------------------------------

    def _fit_codes(self, df: DataFrame) -> None:
        for column in ft.ENCODED_COLUMNS:
            if column in df.columns:
                texts = df.select(F.col(column).cast("string").alias(column))
                self.codes[column] = materialize(ft.label_codes(texts, column), f"codes-{column}")

    def _matrix(self, df: DataFrame) -> DataFrame:
        return ft.align_features(ft.prepare_features(df, self.codes, self.unseen), self.features)

    def _fit_scaler(self, df: DataFrame) -> None:
        row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in self.features],
                     *[F.stddev_pop(c).alias(f"s_{c}") for c in self.features]).first()
        self.scaler = {c: (float(row[f"m_{c}"] or 0.0), float(row[f"s_{c}"] or 0.0) or 1.0) for c in self.features}

    def _scaled(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"_z_{c}": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.scaler.items()})

    def _z(self) -> list[str]:
        return [f"_z_{c}" for c in self.features]

    # -- training -------------------------------------------------------------

    def train(self, df: DataFrame, key: str, label: str = "is_attack", contamination: float = 0.1,
              use_cv: bool = True, cv_folds: int = 5, handle_imbalance: bool = False,
              smote_before_split: bool = False, time_split: bool = False, time_split_ratio: float = 0.7,
              tune: bool = False, trees: int = 100, depth: int | None = None,
              threshold_mode: str = "reference") -> Evaluation:
        """Fit on ``df`` and evaluate on a hold-out where there is one.

        ``key`` is a unique row key. With ``time_split`` the later rows are held
        out; a random forest otherwise holds out a stratified fifth.
        """
        train, test = df, None
        if time_split and "timestamp" in df.columns:
            parts = balance.time_split(df, key, time_split_ratio)
            train, test = parts.where("is_train").drop("is_train"), parts.where("not is_train").drop("is_train")
        self._fit_codes(train)
        prepared = ft.prepare_features(train, self.codes)
        self.features = ft.model_columns(prepared)
        labelled = label in df.columns
        keep = [key, *self.features, *([label] if labelled else [])]
        matrix = materialize(prepared.select(*keep), "features")
        held = materialize(self._matrix(test).select(*keep), "holdout") if test is not None else None
        if self.model_type == "random_forest":
            if not labelled:
                raise ValueError(f"a random forest needs the column {label}")
            return self._train_forest(matrix, held, key, label, use_cv, cv_folds, handle_imbalance,
                                      smote_before_split, tune, trees, depth)
        return self._train_unsupervised(matrix, held if labelled else None, key, label, contamination, trees, threshold_mode)

    def _oversampled(self, matrix: DataFrame, key: str, label: str) -> DataFrame:
        rows = smote(matrix, self.features, label, key).drop("synthetic")
        return materialize(rows.withColumn(key, F.monotonically_increasing_id()), "smote")

    def _train_forest(self, matrix, held, key, label, use_cv, cv_folds, handle_imbalance, smote_before_split,
                      tune, trees, depth) -> Evaluation:
        if handle_imbalance and smote_before_split:
            matrix = self._oversampled(matrix, key, label)
        if held is None:
            split = materialize(balance.stratified_split(matrix, label, key, TEST_SHARE), "split")
            matrix, held = split.where("not is_test").drop("is_test"), split.where("is_test").drop("is_test")
        if handle_imbalance and not smote_before_split:
            matrix = self._oversampled(matrix, key, label)
        result = Evaluation()
        if tune:
            fitted, grid = forest.search(matrix, self.features, label, key, min(CV_FOLDS_WHEN_TUNING, cv_folds))
            self.model = fitted.bestModel
            result.grid = forest.search_report(fitted, grid, matrix)
        else:
            self.model = forest.train_forest(matrix, self.features, label, trees, depth)
            if use_cv:
                result.cross_validation = forest.cross_validate(
                    matrix, self.features, label, key, cv_folds, trees, depth)
        scored = materialize(forest.predict_forest(self.model, held).select(key, label, "ml_anomaly", "ml_anomaly_score"),
                             "holdout-scores")
        self._evaluate(scored, label, result)
        result.importance = forest.feature_importance(self.model, matrix)
        return result

    def _train_unsupervised(self, matrix, held, key, label, contamination, trees, threshold_mode) -> Evaluation:
        self._fit_scaler(matrix)
        scaled = self._scaled(matrix)
        if self.model_type == "isolation_forest":
            self.model = fit_isolation_forest(scaled, self._z(), key, trees)
        else:
            self.model = fit_one_class(scaled, self._z(), contamination)
        scores = materialize(self.model.score(scaled).select("score"), "train-scores")
        self.threshold = M.score_threshold(scores, "score", contamination, threshold_mode).first()["threshold"]
        result = Evaluation()
        if held is not None:
            scored = self._flag(self.model.score(self._scaled(held))).select(key, label, "ml_anomaly", "ml_anomaly_score")
            self._evaluate(materialize(scored, "holdout-scores"), label, result)
        return result

    def _evaluate(self, scored: DataFrame, label: str, result: Evaluation) -> None:
        scored = scored.withColumn(label, F.col(label).cast("int"))
        auc = M.roc_auc(scored, label, "ml_anomaly_score").scalar()
        cells = F.array(F.array("tn", "fp"), F.array("fn", "tp"))
        result.metrics = M.binary_metrics(scored, label, "ml_anomaly").select(
            F.lit(self.model_type).alias("model_type"), "precision", "recall", "f1", auc.alias("roc_auc"),
            cells.alias("confusion_matrix"))
        result.report = M.classification_report(scored, label, "ml_anomaly")

    def _flag(self, scored: DataFrame) -> DataFrame:
        """Low scores are anomalous; the emitted score is negated so that high is."""
        return (scored.withColumn("ml_anomaly", F.col("score") < F.lit(self.threshold))
                .withColumn("ml_anomaly_score", -F.col("score")).drop("score", *self._z()))

    # -- application ----------------------------------------------------------

    def predict(self, df: DataFrame) -> DataFrame:
        """Features plus ``ml_anomaly`` and ``ml_anomaly_score``.

        Per-address counts are relative to the rows given (a batch, a micro-batch).
        """
        if self.model is None:
            raise ValueError("train or load a model first")
        rows = self._matrix(df)
        if self.model_type == "random_forest":
            return forest.predict_forest(self.model, rows)
        return self._flag(self.model.score(self._scaled(rows)))

    # -- persistence ----------------------------------------------------------

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the bundle: model, encodings and a JSON state document."""
        state = {"model_type": self.model_type, "features": self.features, "scaler": self.scaler,
                 "threshold": self.threshold, "codes": sorted(self.codes), "unseen": self.unseen}
        if isinstance(self.model, forest.ForestModel):
            self.model.save(f"{path}/model")
            state["forest"] = self.model.state()
        elif isinstance(self.model, PipelineModel):
            self.model.write().overwrite().save(f"{path}/model")
        elif isinstance(self.model, IsolationForestModel):
            self.model.save(spark, f"{path}/model")
            state["sample"] = self.model.sample
        elif isinstance(self.model, OneClassModel):
            state["one_class"] = self.model.to_dict()
        for column, table in self.codes.items():
            table.write.mode("overwrite").parquet(f"{path}/codes/{column}")
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/state")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Detector:
        state = json.loads(spark.read.text(f"{path}/state").first()["value"])
        detector = cls(state["model_type"], state["features"], threshold=state["threshold"], unseen=state.get("unseen", "next"),
                       scaler={c: tuple(v) for c, v in state["scaler"].items()})
        detector.codes = {c: spark.read.parquet(f"{path}/codes/{c}") for c in state["codes"]}
        if "forest" in state:
            detector.model = forest.ForestModel.load(spark, f"{path}/model", state["forest"])
        elif detector.model_type == "random_forest":
            detector.model = PipelineModel.load(f"{path}/model")
        elif detector.model_type == "isolation_forest":
            detector.model = IsolationForestModel.load(spark, f"{path}/model", detector._z(), state["sample"])
        else:
            detector.model = OneClassModel.from_dict(detector._z(), state["one_class"])
        return detector
