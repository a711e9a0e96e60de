"""End-to-end jobs: collect, detect, train.

These are the places that run actions: each stage that is read more than once
is written to the shared folder, everything else stays one lazy plan.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlog.learning.detector import Detector, Evaluation
from wardlog.operators import activity as act
from wardlog.operators import balance as bal
from wardlog.operators import features as ft
from wardlog.operators import records as rec
from wardlog.operators import respond as rsp
from wardlog.schema import CANONICAL_EVENT, RAW_DOCUMENT, conform
from wardlog.session import materialize
from wardlog.sources import readers as rd
from wardlog.sources import writers as wr

RETRIES, WAIT_SECONDS = 1, 8.0


def collect_text_logs(spark: SparkSession, path: str | list[str], base_year: int) -> DataFrame:
    """Syslog text files as canonical events."""
    return conform(rec.text_log_events(rd.read_text_lines(spark, path), base_year), CANONICAL_EVENT)


def collect_stored_logs(spark: SparkSession, table: str, requested: str, hours: int, now: dt.datetime,
                        mode: str = "all", max_docs: int = 0) -> DataFrame:
    """Typed events of a dated log table, by dataset name and look-back time."""
    docs = spark.read.parquet(table).withColumn("dataset", wr.dataset_name())
    start, end = rd.lookback_bounds(F.lit(now).cast("timestamp"), hours)
    inside = rd.time_range(docs.where(rd.choose_datasets(docs, requested)), start, end, max_docs=max_docs)
    return rec.extract(conform(inside, RAW_DOCUMENT), mode, keep=())


def collect(spark: SparkSession, stored: dict | None, text_path: str | None, base_year: int,
            retries: int = RETRIES, wait_seconds: float = WAIT_SECONDS) -> DataFrame:
    """Stored logs, retried once; the text file where they are missing or empty."""
    for attempt in range(retries + 1 if stored else 0):
        if attempt:
            time.sleep(wait_seconds)
        if rd.path_exists(spark, stored["table"]):
            events = collect_stored_logs(spark, **stored)
            if not events.isEmpty():
                return events
    if text_path is None or not rd.path_exists(spark, text_path):
        raise FileNotFoundError("no stored logs and no text log to read")
    return rd.require_rows(collect_text_logs(spark, text_path, base_year), text_path)


def load_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A CSV event table; an empty one is an error."""
    return rd.require_rows(rd.read_csv(spark, path, CANONICAL_EVENT), path)


def choose_model(spark: SparkSession, paths: list[str]) -> Detector:
    """The first saved model of a priority list."""
    found = rd.first_existing(spark, [f"{p}/state" for p in paths])
    if found is None:
        raise FileNotFoundError("train a model first")
    return Detector.load(spark, found.removesuffix("/state"))


def numbered(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Give rows a unique id that is frozen by writing them."""
    if key in events.columns:
        return events
    return materialize(events.withColumn(key, F.monotonically_increasing_id()), "numbered")


@dataclass
class MonitoringResult:
    """Frames of one detection run."""

    predictions: DataFrame
    alerts: DataFrame
    summary: DataFrame
    report: DataFrame
    hourly: DataFrame


def monitor(spark: SparkSession, events: DataFrame, detector: Detector, out: str, model_name: str = "unified",
            run_id: str = "run", stamp: str = "now", window_minutes: int = 5, source: str = "log table") -> MonitoringResult:
    """Score events, write alerts and the incident report, return the views.

    The report covers all alerts of the run.
    """
    prepared = ft.preprocess(numbered(ft.clean(events)), "ssh", window_minutes, cleaned=False)
    scored = detector.predict(prepared).withColumn("ml_model", F.lit(model_name))
    predictions = materialize(scored, "predictions")
    alerts = materialize(wr.alert_rows(predictions, model_name, dedup_order="event_id"), "alerts")
    wr.write_alerts(alerts.drop("event_id"), f"{out}/alerts", run_id)
    feed = alerts.withColumnRenamed("@timestamp", "timestamp")
    top = materialize(rsp.priority_alerts(feed, tie=("timestamp", "source_ip", "event_id")), "top-alerts")
    order = [-F.coalesce(F.col("ml_anomaly_score").try_cast("double"), F.lit(0.0)), F.col("timestamp"), F.col("source_ip")]
    report = materialize(rsp.incident_report(
        feed, rsp.defense_checklist(top, order), top, source, model_name, run_id, F.current_timestamp()), "report")
    wr.write_incident(report, f"{out}/reports", stamp)
    return MonitoringResult(predictions, alerts, rsp.prediction_summary(predictions), report,
                            act.hourly_attack_table(predictions))


def train_unified(spark: SparkSession, sources: dict[str, DataFrame], model_path: str, metrics_path: str | None = None,
                  balance: bool = True, ratio: float = bal.TARGET_ATTACK_RATIO, handle_imbalance: bool = True,
                  key: str = "event_id", **options) -> Evaluation:
    """Merge sources, clean, train a random forest and save it with its metrics."""
    keyed = {name: frame if key in frame.columns else frame.withColumn(
        key, F.concat_ws("-", F.lit(name), F.monotonically_increasing_id())) for name, frame in sources.items()}
    merged = materialize(bal.merge_sources(keyed, keep=(key,)), "merged")
    rows = bal.rebalance_sources(merged, key, ratio) if balance else merged
    content = [c for c in rows.columns if c not in (key, "_source")]
    unique = wr.first_by(rows.drop("_source"), [F.col(c) for c in content], key)
    detector = Detector("random_forest")
    result = detector.train(materialize(ft.drop_unusable(unique), "unified"), key,
                            handle_imbalance=handle_imbalance, **options)
    detector.save(spark, model_path)
    if metrics_path and result.metrics is not None:
        wr.write_json_document(result.metrics, metrics_path)
    return result
