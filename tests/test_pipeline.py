import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wardlog import __main__ as cli
from wardlog.learning.detector import Detector
from wardlog.operators import features as ft
from wardlog.plans import pipeline
from wardlog.sources import writers as wr
from wardlog.streaming.jobs import enrich_lines


@pytest.fixture
def log_file(tmp_path):
    lines = ["# header"]
    for i in range(120):
        kind = ("Failed password for invalid user admin" if i % 3 == 0 else f"Accepted password for u{i % 4}")
        ip = "10.9.9.9" if i % 3 == 0 else f"10.0.0.{i % 6}"
        lines.append(f"Jan {1 + i // 40:2d} {i % 24:02d}:00:{i % 60:02d} h sshd[{i}]: {kind} from {ip} port 22 ssh2")
    path = tmp_path / "auth.log"
    path.write_text("\n".join(lines) + "\n\n")
    return str(path)


def test_train_then_monitor_text_log(spark, log_file, tmp_path):
    events = pipeline.collect(spark, None, log_file, 2024)
    assert events.count() == 120 and events.where("is_attack").count() == 40
    model = str(tmp_path / "model")
    sources = {"Synthetic": ft.preprocess(events, "ssh"), "Custom": ft.preprocess(events.limit(20), "ssh")}
    result = pipeline.train_unified(spark, sources, model, str(tmp_path / "metrics"), use_cv=False, trees=5, depth=4)
    assert result.report.count() == 5
    metrics = json.loads(spark.read.text(str(tmp_path / "metrics")).first()[0])
    assert set(metrics) == {"model_type", "precision", "recall", "f1", "roc_auc", "confusion_matrix"}
    detector = pipeline.choose_model(spark, [str(tmp_path / "absent"), model])
    out = pipeline.monitor(spark, events, detector, str(tmp_path / "out"), run_id="r1", stamp="s1")
    assert out.predictions.count() == 120 and out.summary.first().total == 120
    alerts = spark.read.parquet(str(tmp_path / "out" / "alerts"))
    assert alerts.count() == 120 and {r.run_id for r in alerts.select("run_id").collect()} == {"r1"}
    latest = json.loads(spark.read.text(str(tmp_path / "out" / "reports" / "latest")).first()[0])
    stamped = json.loads(spark.read.text(str(tmp_path / "out" / "reports" / "incidents" / "incident_s1")).first()[0])
    assert latest == stamped and latest["model"] == "unified" and len(latest["top_alerts"]) == 3
    assert out.hourly.count() == 24


def test_stored_logs_win_over_text(spark, log_file, tmp_path):
    lines = spark.read.text(log_file).where("value like 'Jan%'").select(
        F.col("value").alias("message"), F.struct(F.lit("ssh").alias("log_type")).alias("fields"))
    table = str(tmp_path / "logs")
    wr.write_logs(enrich_lines(lines, 2024).where("timestamp < timestamp'2024-01-02'"), table)
    stored = {"table": table, "requested": "absent-*", "hours": 8760, "now": dt.datetime(2024, 1, 10), "mode": "ssh"}
    events = pipeline.collect(spark, stored, log_file, 2024)
    assert events.count() == 40 and events.columns[:3] == ["timestamp", "source_ip", "user"]
    late = {**stored, "now": dt.datetime(2026, 1, 10)}
    assert pipeline.collect(spark, late, log_file, 2024, wait_seconds=0).count() == 120
    with pytest.raises(FileNotFoundError):
        pipeline.collect(spark, {**stored, "table": str(tmp_path / "none")}, None, 2024, wait_seconds=0)


def test_event_csv_train_predict(spark, tmp_path):
    """Clean, derive, train, save and predict from a CSV event table."""
    i = F.col("id")
    events = spark.range(40).select(
        F.expr("timestamp'2025-06-01' + make_interval(0,0,0,0,0,int(id))").alias("timestamp"),
        F.when(i < 20, "192.168.1.1").otherwise("192.168.1.2").alias("source_ip"), F.lit("root").alias("user"),
        F.when(i < 25, "accepted").otherwise("failed").alias("status"), F.lit("m").alias("message"), F.lit("").alias("attack_type"),
        (i >= 25).alias("is_attack"), F.lit("").alias("geoip_country"), F.lit("").alias("geoip_city"), F.lit("ssh").alias("log_type"))
    path = str(tmp_path / "events")
    wr.write_csv(events, path)
    loaded = pipeline.load_dataset(spark, path)
    rows = pipeline.numbered(ft.preprocess(loaded))
    detector = Detector("random_forest")
    detector.train(rows, "event_id", use_cv=False, trees=5)
    detector.save(spark, str(tmp_path / "m"))
    out = Detector.load(spark, str(tmp_path / "m")).predict(rows)
    assert out.count() == 40 and "ml_anomaly" in out.columns


def test_command_line_arguments():
    args = cli.parse(["monitor", "--model", "a", "--model", "b", "--out", "o", "--text", "t"])
    assert args.model == ["a", "b"] and args.hours == 8760
    args = cli.parse(["train", "--source", "Kaggle=x.csv", "--model", "m"])
    assert args.target_attack_ratio == 0.6 and args.balance_mode == "moderate"
