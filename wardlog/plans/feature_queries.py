"""Cleaning, feature, window and join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlog.functions import values as V
from wardlog.operators import features as ft
from wardlog.operators import metrics as M
from wardlog.operators import windows as win
from wardlog.plans.parse_queries import PARSED, ssh_events
from wardlog.plans.registry import query
from wardlog.plans.views import view

# The brute-force window of the sample data, whose failures are sparse.
WINDOW_MINUTES = 60

WINDOWED = f"""
failed as (select event_id, count(*) over (partition by source_ip order by "timestamp"
  range between interval {WINDOW_MINUTES} minutes preceding and current row) as in_window from ssh where status = 'failed')
"""


def _events(spark, sf_dir):
    return view(spark, sf_dir, "events").select("*", F.col("ts").cast("timestamp").alias("timestamp"))


def _web(spark, sf_dir):
    return view(spark, sf_dir, "web_log").drop("message", "bytes")


@query("brute_force_report", views=("auth_log",), ctes=PARSED + "," + WINDOWED, sql="""
select s.source_ip, count(*) as failed_logins, max(f.in_window) as peak_in_window, count(distinct s."user") as users
from ssh s join failed f using (event_id) where s.is_attack group by s.source_ip""")
def brute_force_report(spark, sf_dir):
    attacks = ssh_events(spark, sf_dir).where("is_attack")
    windowed = win.trailing_counts(attacks.where("status = 'failed'"), "source_ip", "timestamp", WINDOW_MINUTES)
    peaks = windowed.groupBy("source_ip").agg(
        F.sum("n_here").alias("failed_logins"), F.max("n_window").alias("peak_in_window"))
    users = attacks.groupBy("source_ip").agg(F.count_distinct("user").alias("users"))
    return peaks.join(users, "source_ip").select("source_ip", "failed_logins", "peak_in_window", "users")


@query("dedup_rows", sql="""
select distinct user_id, event_type, cast(ts as date) as day from events""")
def dedup_rows(spark, sf_dir):
    return ft.dedup_rows(_events(spark, sf_dir).select("user_id", "event_type", F.to_date("ts").alias("day")))


@query("fill_missing", sql="""
select event_id, coalesce(case when event_id % 5 <> 0 then value end, 0) as value,
  coalesce(case when event_id % 7 <> 0 then event_type end, 'unknown') as event_type,
  case when event_id % 3 <> 0 then ts end as "timestamp" from events""")
def fill_missing(spark, sf_dir):
    k = F.col("event_id")
    holes = _events(spark, sf_dir).select(
        "event_id", F.when(k % 5 != 0, F.col("value")).alias("value"),
        F.when(k % 7 != 0, F.col("event_type")).alias("event_type"), F.when(k % 3 != 0, F.col("timestamp")).alias("timestamp"))
    return ft.fill_missing(holes)


@query("time_features", sql="""
with t as (select event_id, case when event_id % 97 <> 0 then ts end as ts from events)
select event_id, cast(hour(ts) as varchar) as hour, cast(isodow(ts) - 1 as varchar) as day_of_week, cast(day(ts) as varchar) as day_of_month,
  cast(month(ts) as varchar) as month, cast(coalesce(isodow(ts) >= 6, false) as int) as is_weekend, cast(coalesce(hour(ts) between 9 and 17, false) as int) as is_business_hours from t""")
def time_features(spark, sf_dir):
    rows = _events(spark, sf_dir).select(
        "event_id", F.when(F.col("event_id") % 97 != 0, F.col("timestamp")).alias("timestamp"))
    # Nullable numbers are shown as text: clients print missing integers differently.
    parts = ("hour", "day_of_week", "day_of_month", "month")
    return ft.time_features(rows).drop("timestamp").withColumns({c: F.col(c).cast("string") for c in parts})


@query("ip_hash", views=("auth_log",), ctes=PARSED, sql="""
select event_id, cast('0x' || substr(md5(source_ip), 1, 8) as bigint) as ip_hash,
  case when source_ip = '' then 0 else cast('0x' || substr(md5(source_ip), 1, 8) as bigint) end as ip_hash_scoring from ssh""")
def ip_hash(spark, sf_dir):
    return ssh_events(spark, sf_dir).select(
        "event_id", V.ip_hash(F.col("source_ip")).alias("ip_hash"),
        V.ip_hash(F.col("source_ip"), blank_is_zero=True).alias("ip_hash_scoring"))


@query("requests_per_ip", views=("auth_log",), ctes=PARSED, sql="""
with x as (select event_id, nullif(source_ip, '') as source_ip from ssh)
select event_id, source_ip, cast(n as varchar) as requests_per_ip from x left join (select source_ip, count(*) as n from x group by source_ip) c using (source_ip)""")
def requests_per_ip(spark, sf_dir):
    rows = ssh_events(spark, sf_dir).select("event_id", V.blank_to_null(F.col("source_ip")).alias("source_ip"))
    return ft.ip_features(rows).select("event_id", "source_ip", F.col("requests_per_ip").cast("string").alias("requests_per_ip"))


@query("failed_login_count", views=("auth_log",), ctes=PARSED, sql="""
select event_id, coalesce(n, 0) as failed_login_count from ssh left join
  (select source_ip, count(*) as n from ssh where status = 'failed' group by source_ip) c using (source_ip)""")
def failed_login_count(spark, sf_dir):
    return ft.failed_login_count(ssh_events(spark, sf_dir)).select("event_id", "failed_login_count")


@query("failed_login_window", views=("auth_log",), ctes=PARSED + "," + WINDOWED, sql="""
select event_id, coalesce(in_window, 0) as failed_login_count_window from ssh left join failed using (event_id)""")
def failed_login_window(spark, sf_dir):
    return win.failed_login_window(ssh_events(spark, sf_dir), WINDOW_MINUTES).select("event_id", "failed_login_count_window")


@query("attack_type_frequency", views=("auth_log",), ctes=PARSED, sql="""
select event_id, attack_type, n as attack_type_frequency from ssh join (select attack_type, count(*) as n from ssh group by attack_type) c using (attack_type)""")
def attack_type_frequency(spark, sf_dir):
    return ft.attack_type_frequency(ssh_events(spark, sf_dir)).select("event_id", "attack_type", "attack_type_frequency")


@query("ssh_features", views=("auth_log",), ctes=PARSED + "," + WINDOWED, sql="""
select s.event_id, cast(hour(s."timestamp") as int) as hour, cast(isodow(s."timestamp") - 1 as int) as day_of_week,
  cast(day(s."timestamp") as int) as day_of_month, cast(month(s."timestamp") as int) as month,
  cast(isodow(s."timestamp") >= 6 as int) as is_weekend, cast(hour(s."timestamp") between 9 and 17 as int) as is_business_hours,
  i.n as requests_per_ip, cast('0x' || substr(md5(s.source_ip), 1, 8) as bigint) as ip_hash, i.f as failed_login_count,
  coalesce(w.in_window, 0) as failed_login_count_window, a.n as attack_type_frequency
from ssh s join (select source_ip, count(*) as n, count(*) filter (where status = 'failed') as f from ssh group by source_ip) i using (source_ip)
  join (select attack_type, count(*) as n from ssh group by attack_type) a using (attack_type) left join failed w on s.event_id = w.event_id""")
def ssh_features(spark, sf_dir):
    rows = ft.ssh_features(ssh_events(spark, sf_dir), WINDOW_MINUTES)
    return rows.select("event_id", "hour", "day_of_week", "day_of_month", "month", "is_weekend", "is_business_hours",
                       "requests_per_ip", "ip_hash", "failed_login_count", "failed_login_count_window",
                       "attack_type_frequency")


@query("web_features", views=("web_log",), sql="""
select page_id, cast(length(request) as int) as request_length, cast(contains(request, '?') as int) as has_query_string, response,
  cast(response between 400 and 499 as int) as is_4xx, cast(response >= 500 as int) as is_5xx from web_log""")
def web_features(spark, sf_dir):
    return ft.request_features(_web(spark, sf_dir)).select(
        "page_id", "request_length", "has_query_string", "response", "is_4xx", "is_5xx")


@query("web_error_rate", views=("web_log",), sql="""
select page_id, requests_per_ip, count_4xx_per_ip, count_5xx_per_ip, round((count_4xx_per_ip + count_5xx_per_ip) / requests_per_ip, 9) as error_rate_per_ip
from web_log join (select source_ip, count(*) as requests_per_ip, count(*) filter (where response between 400 and 499) as count_4xx_per_ip,
  count(*) filter (where response >= 500) as count_5xx_per_ip from web_log group by source_ip) c using (source_ip)""")
def web_error_rate(spark, sf_dir):
    return ft.web_features(_web(spark, sf_dir)).select(
        "page_id", "requests_per_ip", "count_4xx_per_ip", "count_5xx_per_ip",
        F.round("error_rate_per_ip", 9).alias("error_rate_per_ip"))


@query("minmax_normalize", sql="""
select event_id, round((value - lo) / (hi - lo), 9) as value_normalized, round((user_id - ulo) / (uhi - ulo), 9) as user_id_normalized,
  cast(null as double) as one_normalized
from events, (select min(value) as lo, max(value) as hi, min(user_id) as ulo, max(user_id) as uhi from events) b""")
def minmax_normalize(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "value", "user_id", F.lit(1).alias("one"))
    out = ft.minmax_normalize(rows, ["value", "user_id", "one"])
    return out.select("event_id", *[F.round(f"{c}_normalized", 9).alias(f"{c}_normalized") for c in ("value", "user_id", "one")])


@query("standard_scale", sql="""
select event_id, round((value - m) / s, 6) as value_scaled from events, (select avg(value) as m, stddev_pop(value) as s from events) b""")
def standard_scale(spark, sf_dir):
    rows = ft.standard_scale(_events(spark, sf_dir).select("event_id", "value"), ["value"])
    return rows.select("event_id", F.round("value_scaled", 6).alias("value_scaled"))


@query("label_encode", views=("auth_log",), ctes=PARSED, sql="""
select event_id, "user", dense_rank() over (order by "user") - 1 as user_encoded
from (select event_id, coalesce(nullif("user", ''), 'unknown') as "user" from ssh) q""")
def label_encode(spark, sf_dir):
    rows = ssh_events(spark, sf_dir).select("event_id", V.blank_to_null(F.col("user")).alias("user"))
    return ft.label_encode(rows, "user")


FEATURES = """
coded as (select "user", row_number() over (order by "user") - 1 as user_encoded from (select distinct "user" from ssh) q),
per_ip as (select source_ip, count(*) as n, count(*) filter (where status = 'failed') as f from ssh group by source_ip)
"""


@query("feature_matrix", views=("auth_log",), ctes=PARSED + "," + FEATURES, sql="""
select event_id, cast(hour(s."timestamp") as int) as hour, cast(isodow(s."timestamp") - 1 as int) as day_of_week, cast(isodow(s."timestamp") >= 6 as int) as is_weekend,
  n as requests_per_ip, f as failed_login_count, case when source_ip = '' then 0 else cast('0x' || substr(md5(source_ip), 1, 8) as bigint) end as ip_hash, user_encoded
from ssh s join per_ip using (source_ip) join coded using ("user")""")
def feature_matrix(spark, sf_dir):
    rows = ft.prepare_features(ssh_events(spark, sf_dir))
    return rows.select("event_id", *ft.model_columns(rows))


@query("drop_unusable", views=("auth_log",), ctes=PARSED, sql="""
select event_id from ssh where not (source_ip = '' and status in ('session', 'disconnect'))""")
def drop_unusable(spark, sf_dir):
    quiet = F.when(~F.col("status").isin("session", "disconnect"), F.col("status"))
    rows = ssh_events(spark, sf_dir).select(
        "event_id", V.blank_to_null(F.col("source_ip")).alias("source_ip"), quiet.alias("status"))
    return ft.drop_unusable(rows).select("event_id")


@query("class_distribution", sql="""
select event_type, count(*) as n from events group by event_type""")
def class_distribution(spark, sf_dir):
    return M.class_distribution(_events(spark, sf_dir), "event_type")


@query("describe_features", sql="""
with tall as (select 'value' as "column", value as x from events union all select 'user_id', cast(user_id as double) from events
  union all select 'hour', cast(hour(ts) as double) from events)
select "column", count(x) as count, round(avg(x), 6) as mean, round(stddev_samp(x), 6) as std, min(x) as min, max(x) as max,
  round(quantile_cont(x, 0.25), 6) as p25, round(quantile_cont(x, 0.5), 6) as p50, round(quantile_cont(x, 0.75), 6) as p75
from tall group by "column\"""")
def describe_features(spark, sf_dir):
    rows = ft.time_features(_events(spark, sf_dir))
    out = M.describe_columns(rows, ["value", "user_id", "hour"])
    rounded = {c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")}
    return out.withColumns(rounded)


# --- windows per address, also used on streams -------------------------------

@query("failed_login_tumbling", views=("auth_log",), ctes=PARSED, sql="""
select source_ip, time_bucket(interval 60 minutes, "timestamp") as window_start, time_bucket(interval 60 minutes, "timestamp") + interval 60 minutes as window_end,
  count(*) as failed from ssh where status = 'failed' group by all""")
def failed_login_tumbling(spark, sf_dir):
    return win.failed_by_window(ssh_events(spark, sf_dir), 60)


@query("failed_login_sliding", views=("auth_log",), ctes=PARSED, sql="""
select source_ip, w as window_start, w + interval 60 minutes as window_end, count(*) as failed
from (select source_ip, unnest([time_bucket(interval 20 minutes, "timestamp") - to_minutes(20 * i) for i in range(3)]) as w from ssh where status = 'failed') q
group by all""")
def failed_login_sliding(spark, sf_dir):
    return win.failed_by_window(ssh_events(spark, sf_dir), 60, 20)


@query("failed_login_sessions", views=("auth_log",), ctes=PARSED, sql="""
select source_ip, min("timestamp") as session_start, max("timestamp") + interval 60 minutes as session_end, count(*) as failed
from (select *, sum(case when gap is null or gap > interval 60 minutes then 1 else 0 end) over (partition by source_ip order by "timestamp", event_id) as sid
  from (select *, "timestamp" - lag("timestamp") over (partition by source_ip order by "timestamp", event_id) as gap from ssh where status = 'failed') a) b
group by source_ip, sid""")
def failed_login_sessions(spark, sf_dir):
    return win.failed_sessions(ssh_events(spark, sf_dir), 60)
