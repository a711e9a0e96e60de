"""Queries of whole jobs: sinks read back, saved models, source fallback, dispatch of features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.learning.detector import Detector
from wardlog.operators import activity as act
from wardlog.operators import features as ft
from wardlog.operators import metrics as M
from wardlog.operators import respond as rsp
from wardlog.plans import pipeline
from wardlog.plans.feature_queries import FEATURES
from wardlog.plans.parse_queries import PARSED, _line_files, ssh_events
from wardlog.plans.registry import query
from wardlog.plans.report_queries import CELLS, HOURLY, PRIORITY, REPORT_SQL, _preds, _top3, _checklist_order, shown_report
from wardlog.plans.views import BASE_YEAR, view
from wardlog.schema import has
from wardlog.session import materialize, scratch_path
from wardlog.sources import writers as wr


# --- sinks -------------------------------------------------------------------

@query("csv_sink", sql=r"""
select cast(event_id as varchar) as event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') as "timestamp",
  'say "' || event_type || '", ' || user_id || ' \n' as note, case when event_type <> 'view' then event_type end as event_type from events""")
def csv_sink(spark, sf_dir):
    """Quotes, commas and backslashes survive; a null cell comes back as null."""
    path = scratch_path(spark, "sink-csv")
    events = view(spark, sf_dir, "events")
    wr.write_csv(events.select(
        "event_id", F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit('say "'), "event_type", F.lit('", '), "user_id", F.lit(r" \n")).alias("note"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type")), path)
    return spark.read.schema("event_id string, timestamp string, note string, event_type string").csv(path, header=True, escape='"')


@query("metrics_document", views=("predictions",), ctes=CELLS, sql="""
select 'random_forest' as model_type, round(tp / (tp + fp), 9) as precision, round(tp / (tp + fn), 9) as recall,
  round(2 * tp / (2 * tp + fp + fn), 9) as f1, tn || ',' || fp || ',' || fn || ',' || tp as confusion_matrix from cells""")
def metrics_document(spark, sf_dir):
    """The metrics of a model as the one JSON document a training run leaves."""
    path = scratch_path(spark, "metrics")
    metrics = M.binary_metrics(_preds(spark, sf_dir), "is_attack", "ml_anomaly")
    cells = F.array(F.array("tn", "fp"), F.array("fn", "tp"))
    wr.write_json_document(metrics.select(F.lit("random_forest").alias("model_type"), "precision", "recall", "f1", cells.alias("confusion_matrix")), path)
    read = spark.read.schema("model_type string, precision double, recall double, f1 double, confusion_matrix array<array<bigint>>").json(path)
    joined = F.array_join(F.transform(F.flatten("confusion_matrix"), lambda n: n.cast("string")), ",")
    return read.select("model_type", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], joined.alias("confusion_matrix"))


@query("incident_files", views=("predictions",), ctes=PRIORITY, sql=f"""
with report as ({REPORT_SQL}) select copy, report.* from report, (values ('incident_1'), ('incident_2'), ('latest')) c(copy)""")
def incident_files(spark, sf_dir):
    """Two reports, one after the other: a dated copy of each, and the latest."""
    folder = scratch_path(spark, "reports")
    top = materialize(_top3(spark, sf_dir), "top-alerts")
    report = rsp.incident_report(_preds(spark, sf_dir), rsp.defense_checklist(top, _checklist_order()), top.withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")), "alerts", "unified", "ml-alerts-x", F.current_timestamp())
    report = materialize(report, "report")
    for stamp in ("1", "2"):
        wr.write_incident(report, folder, stamp)

    def read(path: str, copy: str) -> DataFrame:
        return shown_report(spark.read.schema(report.schema).json(f"{folder}/{path}")).select(F.lit(copy).alias("copy"), "*")
    return read("incidents/incident_1", "incident_1").unionByName(read("incidents/incident_2", "incident_2")).unionByName(read("latest", "latest"))


# --- models ------------------------------------------------------------------

@query("model_round_trip", views=("auth_log",), ctes=PARSED, sql="""
select model_type, n as scored, 0 as different from (select count(*) as n from ssh) c,
  (values ('isolation_forest'), ('one_class_svm'), ('random_forest')) m(model_type)""")
def model_round_trip(spark, sf_dir):
    """Every kind of model says the same of every event before it is saved and after it is loaded."""
    events = materialize(ssh_events(spark, sf_dir), "events")
    result = None
    for kind in ("isolation_forest", "one_class_svm", "random_forest"):
        detector, path = Detector(kind), scratch_path(spark, "model")
        detector.train(events, "event_id", use_cv=False)
        detector.save(spark, path)

        def told(d: Detector, suffix: str) -> DataFrame:
            return d.predict(events).select("event_id", F.struct("ml_anomaly", "ml_anomaly_score").alias(suffix))
        both = told(detector, "before").join(told(Detector.load(spark, path), "after"), "event_id", "full")
        counts = both.agg(F.count(F.lit(1)).alias("scored"), F.count_if(~F.col("before").eqNullSafe(F.col("after"))).cast("int").alias("different"))
        rows = counts.select(F.lit(kind).alias("model_type"), "scored", "different")
        result = rows if result is None else result.unionByName(rows)
    return result


@query("model_choice", views=("auth_log",), ctes=PARSED, sql="""
select 'one_class_svm' as model_type, 'first' as chosen, count(*) as scored from ssh
union all select 'isolation_forest', 'second', count(*) from ssh""")
def model_choice(spark, sf_dir):
    """The first saved model of a list of paths is applied; a path without a model is passed over."""
    events = materialize(ssh_events(spark, sf_dir), "events")
    paths = {kind: scratch_path(spark, kind) for kind in ("one_class_svm", "isolation_forest")}
    for kind, path in paths.items():
        detector = Detector(kind)
        detector.train(events, "event_id")
        detector.save(spark, path)
    nowhere = scratch_path(spark, "nowhere")
    orders = {"first": [paths["one_class_svm"], paths["isolation_forest"]], "second": [nowhere, paths["isolation_forest"], paths["one_class_svm"]]}
    result = None
    for name, order in orders.items():
        chosen = pipeline.choose_model(spark, order)
        rows = chosen.predict(events).where("ml_anomaly_score is not null").agg(F.count(F.lit(1)).alias("scored")).select(
            F.lit(chosen.model_type).alias("model_type"), F.lit(name).alias("chosen"), "scored")
        result = rows if result is None else result.unionByName(rows)
    return result


# --- sources -----------------------------------------------------------------

@query("source_fallback", views=("auth_log",), ctes=PARSED, sql="""
with kept as (select *, date_trunc('second', "timestamp") as second from ssh where event_id % 100 <> 99)
select c.source, status, source_ip, count(*) as n, min(second) as first_time, max(second) as last_time
  from kept, (values ('missing'), ('empty')) c(source) group by all
union all select 'stored', status, source_ip, count(*), min("timestamp"), max("timestamp") from ssh group by status, source_ip""")
def source_fallback(spark, sf_dir):
    """Events from the log table where it has any in the look-back time, else from the text file."""
    text, table, nowhere = _line_files(spark, sf_dir) + "/chunk=*", scratch_path(spark, "dated-logs"), scratch_path(spark, "nowhere")
    log = view(spark, sf_dir, "auth_log")
    wr.write_logs(log.select(F.col("ts").cast("timestamp").alias("timestamp"), "message", F.lit("ssh").alias("log_type")), table)
    asked = {"missing": (nowhere, dt.datetime(BASE_YEAR + 1, 1, 1)), "empty": (table, dt.datetime(BASE_YEAR - 20, 1, 1)),
             "stored": (table, dt.datetime(BASE_YEAR + 1, 1, 1))}
    result = None
    for name, (path, now) in asked.items():
        stored = {"table": path, "requested": "ssh-logs-*", "hours": 24 * 1000, "now": now, "mode": "ssh"}
        events = pipeline.collect(spark, stored, text, BASE_YEAR, wait_seconds=0.0)
        rows = events.groupBy("status", "source_ip").agg(
            F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time")).select(F.lit(name).alias("source"), "*")
        result = rows if result is None else result.unionByName(rows)
    return result


# --- features ----------------------------------------------------------------

SSH_ADDED = ("attack_type_frequency,day_of_month,day_of_week,failed_login_count,failed_login_count_window,hour,ip_hash,"
             "is_business_hours,is_weekend,month,requests_per_ip")
WEB_ADDED = "count_4xx_per_ip,count_5xx_per_ip,error_rate_per_ip,has_query_string,ip_hash,is_4xx,is_5xx,request_length,requests_per_ip"
BOTH_ADDED = ",".join(sorted({*SSH_ADDED.split(","), *WEB_ADDED.split(",")} - {"attack_type_frequency"}))


@query("feature_dispatch", views=("auth_log", "web_log"), ctes=PARSED, sql=f"""
with per_ip as (select 'ssh' as logs, count(*) as n from ssh group by source_ip union all select w, count(*) from web_log, (values ('web'), ('both')) k(w) group by w, source_ip)
select logs, sum(n) as "rows", sum(n * n) as requests, case logs when 'ssh' then '{SSH_ADDED}' when 'web' then '{WEB_ADDED}' else '{BOTH_ADDED}' end as features
from per_ip group by logs""")
def feature_dispatch(spark, sf_dir):
    """Which features the columns of a frame call for: login features, request features or both."""
    ssh, web = ssh_events(spark, sf_dir), view(spark, sf_dir, "web_log").drop("message")
    both = web.withColumns({"status": F.lit("failed"), "timestamp": F.timestamp_seconds("page_id")})
    result = None
    for name, frame in {"ssh": ssh, "web": web, "both": both}.items():
        made = ft.preprocess(frame, "auto", 60, cleaned=False)
        added = ",".join(sorted(c for c in made.columns if not has(frame, c)))
        rows = made.agg(F.count(F.lit(1)).alias("rows"), F.sum("requests_per_ip").alias("requests")).select(
            F.lit(name).alias("logs"), "rows", "requests", F.lit(added).alias("features"))
        result = rows if result is None else result.unionByName(rows)
    return result


@query("aligned_features", views=("auth_log",), ctes=PARSED + "," + FEATURES, sql="""
select event_id, cast(hour(s."timestamp") as int) as hour, case when event_id % 3 = 0 then 0 else n end as requests_per_ip,
  cast(0 as double) as is_weekend, cast(0 as double) as request_length, user_encoded
from ssh s join per_ip using (source_ip) join coded using ("user")""")
def aligned_features(spark, sf_dir):
    """Rows to be scored get the columns a model was trained on: missing ones and missing cells as 0."""
    rows = ft.prepare_features(ssh_events(spark, sf_dir))
    test = rows.select("event_id", "hour", F.when(F.col("event_id") % 3 != 0, F.col("requests_per_ip")).alias("requests_per_ip"), "user_encoded")
    trained = ["hour", "is_weekend", "requests_per_ip", "request_length", "user_encoded"]
    return ft.align_features(test, trained).select("event_id", *trained)


@query("refit_encoding", views=("auth_log",), ctes=PARSED, sql="""
with u as (select event_id, coalesce(nullif("user", ''), 'unknown') as "user" from ssh),
known as (select "user", row_number() over (order by "user") - 1 as code from (select distinct "user" from u where "user" < 'u3') k),
fresh as (select "user", row_number() over (order by "user") - 1 as code from (select distinct "user" from u) k)
select event_id, "user", code as user_encoded, 'known' as part from u join known using ("user") where event_id % 2 = 0
union all select event_id, "user", code, 'unseen' from u join fresh using ("user")""")
def refit_encoding(spark, sf_dir):
    """Rows of known values keep the fitted codes; among rows with an unseen value all are coded anew."""
    users = ssh_events(spark, sf_dir).select("event_id", F.coalesce(F.nullif("user", F.lit("")), F.lit("unknown")).alias("user"))
    fitted = materialize(ft.label_codes(users.where("user < 'u3'"), "user"), "codes")
    again = users.where("user < 'u3' and event_id % 2 = 0")
    parts = [ft.label_encode(frame, "user", fitted, unseen="refit").withColumn("part", F.lit(name))
             for name, frame in {"known": again, "unseen": users}.items()]
    return parts[0].unionByName(parts[1])


# --- display -----------------------------------------------------------------

@query("hourly_display_zone", views=("predictions",), ctes="""
moved as (select * replace ("timestamp" + interval 7 hours as "timestamp") from predictions),
""" + HOURLY.replace("from predictions", "from moved"), sql="""
select hour_start, hour_label, total_alerts, attacks, top_ip, top_attack_type, round(avg_score, 6) as avg_score, top_model from hourly""")
def hourly_display_zone(spark, sf_dir):
    """The hourly attack table by the wall clock of the display zone, seven hours ahead."""
    table = act.hourly_attack_table(_preds(spark, sf_dir), zone="Asia/Ho_Chi_Minh")
    return table.withColumn("avg_score", F.round("avg_score", 6))
