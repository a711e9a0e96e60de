"""Streaming queries, each run to the end of its input and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlog.learning.detector import Detector
from wardlog.plans.parse_queries import PARSED, _line_files, ssh_events
from wardlog.plans.registry import query
from wardlog.plans.views import BASE_YEAR, view
from wardlog.session import scratch_path
from wardlog.streaming import jobs


def _tail(spark, sf_dir):
    """The rendered logs as a stream of enriched events."""
    web = scratch_path(spark, "access-lines")
    view(spark, sf_dir, "web_log").select("message").write.text(web)
    return jobs.tail(spark, {"ssh": [_line_files(spark, sf_dir) + "/chunk=*"], "web": [web]}, BASE_YEAR)


@query("stream_routing", views=("auth_log", "web_log"), sql="""
select index_prefix, event_date, count(*) as n, count(*) filter (where hit) as attacks from (
  select 'ssh-logs' as index_prefix, case when event_id % 100 <> 99 then cast(ts as date) else current_date end as event_date, event_type = 'error' as hit from auth_log
  union all select 'web-logs', date '2023-12-31', false from web_log) q group by all""")
def stream_routing(spark, sf_dir):
    path = scratch_path(spark, "routed")
    jobs.start_routing(_tail(spark, sf_dir), path, scratch_path(spark, "cp"), available_now=True).awaitTermination()
    return spark.read.parquet(path).groupBy("index_prefix", "event_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_attack").alias("attacks"))


def _event_stream(spark, sf_dir):
    """Parsed events written once and read as a stream."""
    stored = scratch_path(spark, "events")
    ssh_events(spark, sf_dir).select("event_id", "timestamp", "source_ip", "user", "status", "message",
                                     "attack_type", "is_attack", "log_type").write.parquet(stored)
    return spark.readStream.schema(spark.read.parquet(stored).schema).parquet(stored)


def _drain(stream, spark):
    out = scratch_path(spark, "stream-out")
    (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "cp"))
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(stream.schema).parquet(out)


@query("stream_failed_windows", views=("auth_log",), ctes=PARSED, sql="""
select * from (select source_ip, time_bucket(interval 60 minutes, "timestamp") as window_start,
  time_bucket(interval 60 minutes, "timestamp") + interval 60 minutes as window_end, count(*) as failed from ssh where status = 'failed' group by 1, 2, 3) w
where window_end <= (select max("timestamp") - interval 12 hours from ssh where status = 'failed')""")
def stream_failed_windows(spark, sf_dir):
    return _drain(jobs.failed_windows(_event_stream(spark, sf_dir), 60), spark)


@query("stream_scored_alerts", views=("auth_log",), ctes=PARSED, sql="""
select 'stream' as run_id, 'unified' as ml_model, nullif(source_ip, '') as source_ip, count(distinct "timestamp") as moments, 0 as repeated
from ssh group by nullif(source_ip, '')""")
def stream_scored_alerts(spark, sf_dir):
    """The events come twice, as after a lost checkpoint; the log has every alert once."""
    detector = Detector("isolation_forest")
    detector.train(ssh_events(spark, sf_dir), "event_id")
    scored, log = scratch_path(spark, "scored"), scratch_path(spark, "alerts")
    following = scratch_path(spark, "cp")
    for _ in range(2):
        jobs.start_scoring(_event_stream(spark, sf_dir), detector, scored, scratch_path(spark, "cp"), available_now=True).awaitTermination()
        jobs.start_alert_log(spark, scored, log, following, available_now=True).awaitTermination()
    told = F.count(F.lit(1)) - F.count_distinct("alert_id")
    return spark.read.parquet(log).groupBy("run_id", "ml_model", "source_ip").agg(
        F.count_distinct("@timestamp").alias("moments"), told.cast("int").alias("repeated"))


@query("stream_throttle", views=("auth_log",), ctes=PARSED, sql="""
with recursive attacks as (select distinct source_ip as key, "timestamp" as t from ssh where is_attack),
shown(key, t) as (select key, min(t) from attacks group by key
  union all select s.key, (select min(a.t) from attacks a where a.key = s.key and a.t >= s.t + interval 3600 seconds) from shown s where s.t is not null)
select key, count(t) as shown from shown group by key""")
def stream_throttle(spark, sf_dir):
    attacks = _event_stream(spark, sf_dir).where("is_attack")
    shown = _drain(jobs.throttle(attacks, F.col("source_ip"), F.col("message"), 3600.0), spark)
    return shown.groupBy("key").agg(F.count(F.lit(1)).alias("shown"))
