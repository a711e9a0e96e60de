"""Scan, parse and rule queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlog.functions import parsing as P
from wardlog.functions import rules as R
from wardlog.functions import values as V
from wardlog.operators import metrics as M
from wardlog.operators import records as rec
from wardlog.plans.registry import query
from wardlog.plans.views import BASE_YEAR, view
from wardlog.schema import CANONICAL_EVENT, RAW_DOCUMENT, conform
from wardlog.session import scratch_path
from wardlog.sources import profile as pf
from wardlog.sources import readers as rd
from wardlog.sources import writers as wr

# Lines per rendered file: small enough to give several here, at most a million
# (about 100 MB) on large tables.
FILE_LINES = 2500

# SQL twins of the SSH message parse, over a relation with a "message" column.
SQL_IP = r"""coalesce(nullif(regexp_extract(message, 'from\s+([\d\.]+)', 1), ''),
  nullif(regexp_extract(message, '(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})', 1), ''), '')"""
SQL_USER = "coalesce(" + ", ".join(
    f"nullif(regexp_extract(message, '{p}', 1), '')" for p in P.USER_PATTERNS) + ", '')"
SQL_STATUS = """case when lower(message) like '%failed password%' then 'failed'
  when lower(message) like '%accepted password%' or lower(message) like '%accepted publickey%' then 'accepted'
  when lower(message) like '%authentication failure%' then 'failed'
  when lower(message) like '%invalid user%' then 'invalid_user'
  when lower(message) like '%session opened for user%' or lower(message) like '%session closed for user%' then 'session'
  when lower(message) like '%su for%' then 'su'
  when lower(message) like '%sudo:%' or lower(message) like '%pam_unix(sudo:session)%' then 'sudo'
  when lower(message) like '%did not receive identification%' then 'connection_refused'
  when lower(message) like '%disconnected from%' or lower(message) like '%received disconnect%' then 'disconnect'
  else '' end"""
PARSED = f"""
parsed as (select event_id, ts as "timestamp", user_id, event_type, value, message, {SQL_IP} as source_ip, {SQL_USER} as "user",
  {SQL_STATUS} as status, 'ssh' as log_type from auth_log),
ssh as (select *, status in ('failed', 'invalid_user') as is_attack,
  case when status in ('failed', 'invalid_user') then 'brute_force' else '' end as attack_type from parsed)
"""


def ssh_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered auth log parsed into canonical events."""
    log = view(spark, sf_dir, "auth_log").withColumnRenamed("ts", "timestamp")
    return rec.parse_ssh(log).withColumn("log_type", F.lit("ssh"))


def auth_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "auth_log")


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = view(spark, sf_dir, "raw_docs")
    nested = (flat.withColumn("fields", F.struct(F.col("fields_log_type").alias("log_type")))
              .withColumn("source", F.struct(F.col("src_ip").alias("ip")))
              .withColumn("geoip", V.nest_geo(F.col("country"), F.col("city")))
              .withColumn("extra", F.create_map(F.lit("port"), F.when(F.col("doc_id") % 2 == 0, "22"))))
    return conform(nested, RAW_DOCUMENT)


def _as_text(df: DataFrame, *names: str) -> DataFrame:
    """Nullable numbers as text: clients print missing integers differently."""
    return df.withColumns({n: F.col(n).cast("string") for n in names})


# --- scans -------------------------------------------------------------------

def _line_files(spark: SparkSession, sf_dir: str) -> str:
    """The auth log as text files of consecutive lines, each in line order."""
    path = scratch_path(spark, "auth-lines")
    log = auth_lines(spark, sf_dir)
    lines = log.select(
        F.floor(F.col("event_id") / FILE_LINES).alias("chunk"), "event_id",
        F.when(F.col("event_id") % 100 == 99, F.concat(F.lit("# "), "message")).otherwise(F.col("message")).alias("value"))
    (lines.repartition("chunk").sortWithinPartitions("chunk", "event_id").drop("event_id")
     .write.partitionBy("chunk").text(path))
    return path


@query("text_log_scan", views=("auth_log",), sql="""
select trim(message) as value from auth_log where event_id % 100 <> 99""")
def text_log_scan(spark, sf_dir):
    return rd.read_text_lines(spark, _line_files(spark, sf_dir) + "/chunk=*")


@query("file_line_numbers", views=("auth_log",), sql=f"""
select cast(event_id // {FILE_LINES} as bigint) as chunk, event_id % {FILE_LINES} + 1 as line_no,
  case when event_id % 100 = 99 then '# ' || message else message end as value from auth_log""")
def file_line_numbers(spark, sf_dir):
    lines = rd.read_numbered_lines(spark, _line_files(spark, sf_dir) + "/chunk=*")
    return lines.select(F.regexp_extract("file", r"chunk=(\d+)", 1).cast("bigint").alias("chunk"), "line_no", "value")


@query("csv_event_scan", views=("auth_log",), ctes=PARSED, sql="""
select "timestamp", nullif(source_ip, '') as source_ip, nullif("user", '') as "user", status, message, nullif(attack_type, '') as attack_type,
  is_attack, log_type from ssh""")
def csv_event_scan(spark, sf_dir):
    path = scratch_path(spark, "events-csv")
    wr.write_csv(conform(ssh_events(spark, sf_dir), CANONICAL_EVENT), path)
    return rd.read_csv(spark, path, CANONICAL_EVENT).drop("geoip_country", "geoip_city")


@query("folder_profile", views=("predictions",), sql="""
select event_type as dataset, count(*) as "rows", 'event_id:bigint,timestamp:timestamp,source_ip:string,is_attack:boolean,score:double' as columns,
  true as has_timestamp, case when event_type = 'error' then 'true' else 'false' end || ':' || count(*) as attacks, cast(null as varchar) as labels,
  count(distinct user_id % 97) as unique_ips, true as sketch_close from events group by event_type
union all select 'labels', count(*), 'doc_id:bigint,label:bigint', false, null,
  (select string_agg(quality || ':' || n, ',' order by n desc, quality) from (select quality, count(*) as n from labels group by quality) q), null, null from labels""")
def folder_profile(spark, sf_dir):
    """Two kinds of tables in one folder: events by type, and labels."""
    folder = scratch_path(spark, "csv-folder")
    events = view(spark, sf_dir, "events").select(
        "event_type", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.concat(F.lit("10.0.0."), F.col("user_id") % 97).alias("source_ip"), (F.col("event_type") == "error").alias("is_attack"),
        (F.col("value") + 0.5).alias("score"))
    events.repartition("event_type").write.partitionBy("event_type").csv(folder + "/events", header=True, quoteAll=True)
    view(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).coalesce(1).write.csv(folder + "/labels", header=True)
    found = pf.folder_profile(spark, folder)
    joined = lambda pairs: F.array_join(F.transform(pairs, lambda p: F.concat_ws(":", *[p[k].cast("string") for k in ("value", "n")])), ",")
    return found.select(
        F.regexp_extract("path", r"(?:event_type=|/)(\w+)/part-", 1).alias("dataset"), "rows",
        F.array_join(F.transform("columns", lambda c: F.concat_ws(":", c["name"], c["type"])), ",").alias("columns"), "has_timestamp",
        joined("attack_counts").alias("attacks"), joined("label_counts").alias("labels"), "unique_ips",
        (F.abs(F.col("about_ips") - F.col("unique_ips")) <= 0.1 * F.col("unique_ips")).alias("sketch_close"))


@query("label_scan", views=("label_lines",), sql="""
select line, labels_text from label_lines""")
def label_scan(spark, sf_dir):
    path = scratch_path(spark, "labels")
    labels = view(spark, sf_dir, "label_lines")
    good = labels.select(F.to_json(F.struct("line", F.split("labels_text", ",").alias("labels"))).alias("value"))
    broken = labels.where("line % 500 = 1").select(F.lit('{"line": 1, "labels": [').alias("value"))
    good.union(broken).write.text(path)
    return rd.read_label_lines(spark, path).select("line", F.array_join("labels", ",").alias("labels_text"))


@query("time_range_scan", sql="""
select event_id, ts as "timestamp" from events
where ts between timestamp '2024-01-10 00:00:00' and timestamp '2024-01-12 12:00:00'""")
def time_range_scan(spark, sf_dir):
    docs = view(spark, sf_dir, "events").select("event_id", F.col("ts").alias("timestamp"))
    bounded = rd.time_range(docs, F.lit(dt.datetime(2024, 1, 10)).cast("timestamp_ntz"),
                            F.lit(dt.datetime(2024, 1, 12, 12)).cast("timestamp_ntz"))
    return bounded


@query("pruned_time_range", views=("auth_log",), sql="""
with b as (select max(ts) + interval 12 hours as hi from events)
select cast(ts as date) as event_date, count(*) as docs from auth_log, b
where event_id % 3 <> 0 and ts between hi - interval 72 hours and hi group by 1""")
def pruned_time_range(spark, sf_dir):
    """A look-back in the dated log table, by dataset and time; the bounds are known at run time only."""
    path = scratch_path(spark, "dated-logs")
    tag = F.when(F.col("event_id") % 3 == 0, "web").otherwise("ssh")
    wr.write_logs(view(spark, sf_dir, "auth_log").select("event_id", F.col("ts").alias("timestamp"), "message", tag.alias("log_type")), path)
    newest = view(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("timestamp"))
    return recent_logs(spark, path, newest).groupBy("event_date").agg(F.count(F.lit(1)).alias("docs"))


def recent_logs(spark, path, newest, hours=72):
    start, end = rd.lookback_bounds(newest.agg(F.max("timestamp").alias("v")).scalar(), hours)
    docs = spark.read.parquet(path).where(F.col("index_prefix") == wr.INDEX_PREFIX["ssh"])
    return rd.time_range(docs, start, end)


@query("lookback_bounds", sql="""
with b as (select max(ts) + interval 12 hours as hi from events)
select hi - interval 48 hours as start_time, hi as end_time, count(*) as docs
from events, b where ts between hi - interval 48 hours and hi group by hi""")
def lookback_bounds(spark, sf_dir):
    docs = view(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("timestamp"))
    now = docs.agg(F.max("timestamp").alias("v")).scalar()
    start, end = rd.lookback_bounds(now, 48)
    return rd.time_range(docs, start, end).agg(F.count(F.lit(1)).alias("docs")).select(
        start.alias("start_time"), end.alias("end_time"), "docs")


DATASETS = """
routed as (select event_id, case event_type when 'view' then 'web' when 'signup' then 'app' else 'ssh' end as log_type, ts from events),
datasets as (select case log_type when 'web' then 'web-logs' when 'ssh' then 'ssh-logs' else 'test-logs' end || '-' ||
  strftime(ts, '%Y.%m.%d') as dataset from routed)
"""


def _routed(spark, sf_dir):
    events = view(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("timestamp"), F.lit("").alias("message"),
        F.when(F.col("event_type") == "view", "web").when(F.col("event_type") == "signup", "app")
        .otherwise("ssh").alias("log_type"))
    return wr.route(events).withColumn("dataset", wr.dataset_name())


@query("index_routing", ctes=DATASETS, sql="""
select dataset, count(*) as n from datasets group by dataset""")
def index_routing(spark, sf_dir):
    return _routed(spark, sf_dir).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


@query("resolve_dataset", ctes=DATASETS, sql="""
select distinct dataset, 'ssh-logs-*' as pattern from datasets where dataset like 'ssh-logs-%'""")
def resolve_dataset(spark, sf_dir):
    return rd.resolve_datasets(_routed(spark, sf_dir).select("dataset"), "auth-*, syslog-2024*").select("dataset", "pattern")


@query("source_inventory", ctes=DATASETS, sql="""
select dataset, count(*) as docs from datasets where dataset like 'ssh-logs-%' or dataset like 'test-logs-%' group by dataset""")
def source_inventory(spark, sf_dir):
    return rd.source_inventory(_routed(spark, sf_dir))


@query("labelled_csv_conform", sql=r"""
with foreign_logins as (select event_id, ts, '10.0.0.' || (user_id % 8) as source_ip,
    case when event_id % 41 = 0 then null else 'u' || user_id end as username,
    case event_type when 'click' then 'ACCEPTED password' when 'error' then 'Failed password' when 'view' then 'accepted after failed' else event_type end as event_type,
    case when event_type = 'error' then 'Brute_force' else 'normal' end as label from events),
s as (select *, case when lower(event_type) like '%accepted%' and lower(event_type) not like '%failed%' then 'accepted' else 'failed' end as status,
  coalesce(username, 'nan') as "user", lower(label) like '%brute%' as is_attack from foreign_logins)
select event_id, ts as "timestamp", source_ip, "user", status,
  'sshd: ' || status || ' password for ' || "user" || ' from ' || source_ip || ' port 22 ssh2' as message,
  case when is_attack then 'brute_force' else '' end as attack_type, is_attack, '' as geoip_country, '' as geoip_city, 'ssh' as log_type from s""")
def labelled_csv_conform(spark, sf_dir):
    kind = F.col("event_type")
    foreign = view(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("string").alias("timestamp"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 8).cast("string")).alias("source_ip"),
        F.when(F.col("event_id") % 41 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("username"),
        F.when(kind == "click", "ACCEPTED password").when(kind == "error", "Failed password")
        .when(kind == "view", "accepted after failed").otherwise(kind).alias("event_type"),
        F.when(kind == "error", "Brute_force").otherwise("normal").alias("label"))
    return rd.conform_labelled(foreign)


@query("latest_alerts", views=("predictions",), sql="""
select event_id, "timestamp", source_ip, is_attack, attack_type, ml_model, ml_anomaly, ml_anomaly_score from predictions
where "timestamp" >= timestamp '2024-01-15 00:00:00' and ml_model = 'unified' order by "timestamp" desc, event_id limit 50""")
def latest_alerts(spark, sf_dir):
    return rd.latest_alerts(view(spark, sf_dir, "predictions"), 50, F.lit("2024-01-15").cast("timestamp"),
                            "unified", tie="event_id")


@query("latest_alerts_fallback", views=("predictions",), sql="""
select event_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ') as "timestamp", coalesce(nullif(source_ip, ''), '—') as source_ip,
  cast(is_attack as varchar) as is_attack, coalesce(nullif(attack_type, ''), 'unknown') as attack_type, 'unified' as ml_model,
  cast(ml_anomaly as varchar) as ml_anomaly, ml_anomaly_score, '—' as defense_recommendations
from predictions where event_id % 9 <> 0 order by strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ') desc, event_id limit 30""")
def latest_alerts_fallback(spark, sf_dir):
    text = view(spark, sf_dir, "predictions").select(
        "event_id",
        F.when(F.col("event_id") % 9 == 0, "not a time").otherwise(F.col("timestamp").cast("string")).alias("timestamp"),
        "source_ip", F.col("is_attack").cast("string").alias("is_attack"), "attack_type",
        F.col("ml_anomaly").cast("string").alias("ml_anomaly"), "ml_anomaly_score")
    return rd.latest_alerts_fallback(text, 30, "unified", tie="event_id")


@query("dataset_profile", views=("auth_log",), ctes=PARSED, sql="""
select count(*) as rows, 12 as n_columns, true as has_timestamp, count(*) filter (where is_attack) as attack_rows,
  count(*) filter (where not is_attack) as normal_rows, count(distinct source_ip) as unique_ips from ssh""")
def dataset_profile(spark, sf_dir):
    return M.dataset_profile(ssh_events(spark, sf_dir))


@query("top_labels", sql="""
select user_id as label, count(*) as n from events group by user_id order by n desc, user_id limit 10""")
def top_labels(spark, sf_dir):
    return M.top_values(view(spark, sf_dir, "events").select(F.col("user_id").alias("label")), "label")


@query("tagged_sources", views=("auth_log", "web_log"), sql="""
select 'ssh' as log_type, message from auth_log where event_id % 100 <> 99
union all select 'web', message from web_log
union all select 'ssh', '# ' || message from auth_log where event_id % 100 = 99""")
def tagged_sources(spark, sf_dir):
    web = scratch_path(spark, "access-lines")
    view(spark, sf_dir, "web_log").select("message").write.text(web)
    tagged = rd.read_tagged(spark, {"ssh": [_line_files(spark, sf_dir) + "/chunk=*"], "web": [web]})
    return tagged.select("fields.log_type", "message")


# --- parsing -----------------------------------------------------------------

@query("syslog_header", views=("auth_log",), sql=r"""
select event_id, regexp_extract(message, '^(\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+(\S+?)(?:\[(\d+)\])?:\s*(.*)$', 1) as log_time,
  regexp_extract(message, '^(\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+(\S+?)(?:\[(\d+)\])?:\s*(.*)$', 2) as host,
  regexp_extract(message, '^(\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+(\S+?)(?:\[(\d+)\])?:\s*(.*)$', 5) as body
from auth_log where event_id % 10 <> 3""")
def syslog_header(spark, sf_dir):
    lines = auth_lines(spark, sf_dir).select(
        "event_id", F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("?? "), "message"))
        .otherwise(F.col("message")).alias("value"))
    return rec.split_syslog(lines).select("event_id", "log_time", "host", "body")


@query("syslog_timestamp", sql="""
select event_id, case when event_id % 12 <> 5 then date_trunc('second', ts) end as "timestamp" from events""")
def syslog_timestamp(spark, sf_dir):
    lines = auth_lines(spark, sf_dir)
    # Single-digit days padded with a blank, as syslog writes them.
    padded = F.regexp_replace("message", r"^(\w{3}) 0", "$1  ")
    text = F.when(F.col("event_id") % 12 == 5, F.concat(F.lit("x"), "message")).otherwise(padded)
    return lines.select("event_id", P.syslog_timestamp(text, BASE_YEAR).alias("timestamp"))


@query("ssh_source_ip", views=("auth_log",), ctes=PARSED, sql="""
select event_id, source_ip from ssh""")
def ssh_source_ip(spark, sf_dir):
    return ssh_events(spark, sf_dir).select("event_id", "source_ip")


@query("ssh_user", views=("auth_log",), ctes=PARSED, sql="""
select event_id, "user" from ssh""")
def ssh_user(spark, sf_dir):
    return ssh_events(spark, sf_dir).select("event_id", "user")


@query("ssh_status", views=("auth_log",), ctes=PARSED, sql="""
select status, is_attack, attack_type, count(*) as n from ssh group by all""")
def ssh_status(spark, sf_dir):
    return ssh_events(spark, sf_dir).groupBy("status", "is_attack", "attack_type").agg(F.count(F.lit(1)).alias("n"))


TYPED = r"""
typed as (select *, coalesce(nullif(log_type, ''), nullif(fields_log_type, ''),
  case when lower(message) like '%ssh%' then 'ssh'
       when lower(message) like '%http%' or message like '%GET%' or message like '%POST%' then 'web' end) as kind from raw_docs),
ssh_rows as (select *, """ + SQL_IP + " as p_ip, " + SQL_USER + " as p_user, " + SQL_STATUS + r""" as p_status
  from typed where lower(kind) like '%ssh%' or lower(message) like '%ssh%'),
ssh_out as (select doc_id, "timestamp", coalesce(nullif(source_ip, ''), nullif(src_ip, ''), p_ip) as source_ip,
  coalesce(nullif("user", ''), p_user) as "user", coalesce(nullif(status, ''), p_status) as status, message,
  coalesce(nullif(attack_type, ''), case when p_status in ('failed', 'invalid_user') then 'brute_force' else '' end) as attack_type,
  coalesce(is_attack, false) or p_status in ('failed', 'invalid_user') as is_attack,
  coalesce(country, '') as geoip_country, coalesce(city, '') as geoip_city, coalesce(kind, 'ssh') as log_type from ssh_rows),
web_out as (select doc_id, "timestamp",
  coalesce(nullif(clientip, ''), case when lower(kind) like '%web%' then nullif(src_ip, '') end, '') as source_ip,
  coalesce(nullif(clientip, ''), case when lower(kind) like '%web%' then nullif(src_ip, '') end, '') as clientip,
  coalesce(request, '') as request, response, coalesce(bytes, 0) as bytes, coalesce(verb, '') as verb, message,
  coalesce(is_attack, false) as is_attack, coalesce(attack_type, '') as attack_type,
  case when lower(kind) like '%web%' then coalesce(country, '') else '' end as geoip_country,
  case when lower(kind) like '%web%' then kind else 'web' end as log_type
  from typed where lower(kind) like '%web%' or lower(message) like '%http%' or message like '%GET%' or message like '%POST%')
"""


@query("ssh_records", views=("raw_docs",), ctes=TYPED, sql="select * from ssh_out")
def ssh_records(spark, sf_dir):
    return rec.ssh_records(raw_documents(spark, sf_dir))


@query("web_records", views=("raw_docs",), ctes=TYPED, sql="select * from web_out")
def web_records(spark, sf_dir):
    return rec.web_records(raw_documents(spark, sf_dir))


@query("raw_records", views=("raw_docs",), ctes=TYPED, sql=r"""
select doc_id, "timestamp", message, coalesce(kind, 'unknown') as log_type,
  coalesce(nullif(source_ip, ''), nullif(src_ip, ''), case when s then p_ip end, '') as source_ip, coalesce(clientip, '') as clientip,
  coalesce(nullif("user", ''), case when s then p_user end, '') as "user", coalesce(nullif(status, ''), case when s then p_status end, '') as status,
  coalesce(request, '') as request, cast(response as varchar) as response, coalesce(bytes, 0) as bytes, coalesce(verb, '') as verb,
  coalesce(is_attack, false) or (s and p_status in ('failed', 'invalid_user')) as is_attack,
  case when s and p_status in ('failed', 'invalid_user') then 'brute_force' else coalesce(attack_type, '') end as attack_type,
  coalesce(country, '') as geoip_country, coalesce(city, '') as geoip_city,
  case when doc_id % 2 = 0 then 'port=22' else '' end as extra
from (select *, (coalesce(lower(kind) like '%ssh%', false) or lower(message) like '%ssh%') as s, """
       + SQL_IP + " as p_ip, " + SQL_USER + " as p_user, " + SQL_STATUS + " as p_status from typed) q")
def raw_records(spark, sf_dir):
    rows = rec.raw_records(raw_documents(spark, sf_dir))
    pairs = F.transform(F.map_entries("extra"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return _as_text(rows.withColumn("extra", F.array_join(pairs, ",")), "response")


@query("classify_log_type", views=("raw_docs",), ctes=TYPED, sql="""
select doc_id, kind as log_type from typed""")
def classify_log_type(spark, sf_dir):
    docs = raw_documents(spark, sf_dir)
    return docs.select("doc_id", rec.document_log_type(docs).alias("log_type"))


@query("extract_all", views=("raw_docs",), ctes=TYPED, sql="""
select doc_id, "timestamp", source_ip, "user", status, message, attack_type, is_attack, geoip_country, geoip_city, log_type,
  clientip, request, cast(response as varchar) as response, cast(bytes as varchar) as bytes, verb
from (select * from ssh_out union all by name select * from web_out) u""")
def extract_all(spark, sf_dir):
    return _as_text(rec.extract(raw_documents(spark, sf_dir), "all"), "response", "bytes")


GROK = P.SSH_PASSWORD_LINE
ACCESS = P.ACCESS_LINE


def _sql_group(pattern: str, group: int) -> str:
    return f"nullif(regexp_extract(message, '{pattern}', {group}), '')"


@query("ssh_grok", views=("auth_log",), sql=f"""
select event_id, {_sql_group(GROK, 1)} as log_time, {_sql_group(GROK, 2)} as host, {_sql_group(GROK, 3)} as pid,
  lower({_sql_group(GROK, 4)}) as status, {_sql_group(GROK, 5)} as "user", {_sql_group(GROK, 6)} as source_ip,
  {_sql_group(GROK, 7)} as port from auth_log""")
def ssh_grok(spark, sf_dir):
    return _as_text(rec.extract_ssh_fields(auth_lines(spark, sf_dir).select("event_id", "message")).drop("message"), "pid", "port")


@query("access_log_parse", views=("web_log",), sql=f"""
select page_id, {_sql_group(ACCESS, 1)} as clientip,
  (try_strptime({_sql_group(ACCESS, 2)}, '%d/%b/%Y:%H:%M:%S %z') at time zone 'UTC')::timestamp as "timestamp",
  {_sql_group(ACCESS, 3)} as verb, {_sql_group(ACCESS, 4)} as request, {_sql_group(ACCESS, 5)} as httpversion,
  try_cast({_sql_group(ACCESS, 6)} as int) as response, try_cast({_sql_group(ACCESS, 7)} as bigint) as bytes from web_log""")
def access_log_parse(spark, sf_dir):
    return rec.extract_access_fields(view(spark, sf_dir, "web_log").select("page_id", "message")).drop("message")


# --- rules -------------------------------------------------------------------

@query("rule_brute_force", views=("auth_log",), sql="""
select event_id, 'brute_force' as attack_type, 'high' as severity, true as is_attack, 'brute_force_attempt' as tags
from auth_log where message like '%Failed password%' or message like '%invalid user%'""")
def rule_brute_force(spark, sf_dir):
    rows = rec.apply_rules(auth_lines(spark, sf_dir), F.lit("system")).where("is_attack")
    return rows.select("event_id", "attack_type", "severity", "is_attack", F.array_join("tags", ",").alias("tags"))


def _web_rules(spark, sf_dir):
    return rec.apply_rules(view(spark, sf_dir, "web_requests"), F.lit("web"))


SQLI_SQL = R.SQL_INJECTION.replace("'", "''")


@query("rule_sql_injection", views=("web_requests",), sql=f"""
select page_id, request from web_requests where regexp_matches(request, '{SQLI_SQL}')""")
def rule_sql_injection(spark, sf_dir):
    rows = _web_rules(spark, sf_dir).where(F.array_contains("matched_rules", "sql_injection"))
    return rows.select("page_id", "request")


@query("rule_xss", views=("web_requests",), sql=f"""
select page_id, request,
  case when regexp_matches(request, '{SQLI_SQL}') then 'sql_injection' else 'xss' end as attack_type,
  case when regexp_matches(request, '{SQLI_SQL}') then 'high' else 'medium' end as severity
from web_requests where regexp_matches(request, '{R.XSS}')""")
def rule_xss(spark, sf_dir):
    rows = _web_rules(spark, sf_dir).where(F.array_contains("matched_rules", "xss"))
    return rows.select("page_id", "request", "attack_type", "severity")


@query("multiline_records", views=("multiline_lines",), sql=r"""
select file, min(line_no) as line_no, string_agg(value, chr(10) order by line_no) as value from (
  select *, sum(case when regexp_matches(value, '^[A-Z][a-z]{2}\s+\d{1,2}\s') then 1 else 0 end)
    over (partition by file order by line_no) as rec from multiline_lines) q group by file, rec""")
def multiline_records(spark, sf_dir):
    return rec.multiline_records(view(spark, sf_dir, "multiline_lines"))


# --- value clean-up ----------------------------------------------------------

@query("normalize_timestamp", sql="""
with raw as (select event_id, ts, event_id % 6 as k, strftime(ts, '%Y-%m-%d %H:%M:%S') as plain from events)
select event_id,
  case k when 0 then date_trunc('second', ts) when 1 then date_trunc('second', ts) when 2 then ts when 3 then date_trunc('second', ts) - interval 7 hours
    when 4 then (date_trunc('second', ts)) end as utc_time,
  case k when 0 then date_trunc('second', ts) when 1 then date_trunc('second', ts) + interval 7 hours when 2 then ts + interval 7 hours
    when 3 then date_trunc('second', ts) when 4 then null end as display_time,
  case when k in (0, 1, 4) then strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.000Z') when k = 2 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'
    when k = 3 then strftime(date_trunc('second', ts) - interval 7 hours, '%Y-%m-%dT%H:%M:%S.000Z') end as iso
from raw""")
def normalize_timestamp(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    shapes = {0: "yyyy-MM-dd HH:mm:ss", 1: "yyyy-MM-dd'T'HH:mm:ss'Z'", 2: "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
              3: "yyyy-MM-dd'T'HH:mm:ss'+07:00'", 4: "dd/MMM/yyyy:HH:mm:ss' +0000'"}
    text = F.lit("junk")
    for k, fmt in shapes.items():
        text = F.when(F.col("event_id") % 6 == k, F.date_format(ts, fmt)).otherwise(text)
    rows = view(spark, sf_dir, "events").select("event_id", text.alias("t"))
    utc = V.tolerant_timestamp(F.col("t"))
    return rows.select("event_id", utc.alias("utc_time"), V.display_timestamp(F.col("t")).alias("display_time"),
                       V.iso_millis(utc).alias("iso"))


@query("normalize_bool", sql="""
with raw as (select event_id, case event_id % 9 when 0 then 'true' when 1 then ' YES ' when 2 then '1' when 3 then 't' when 4 then 'no'
  when 5 then '0' when 6 then '' when 7 then 'False' end as a, cast(event_id % 3 as int) as b from events)
select event_id, coalesce(lower(trim(a)) in ('true', '1', 'yes', 'y', 't'), false) as text_flag, b <> 0 as number_flag,
  coalesce(lower(trim(a)) in ('true', '1', 'yes'), false) or b = 1 as any_flag,
  case when try_cast(a as double) is not null then try_cast(a as double) <> 0 else coalesce(lower(a) in ('true', '1', 'yes'), false) end as alert_flag
from raw""")
def normalize_bool(spark, sf_dir):
    k = F.col("event_id") % 9
    words = ("true", " YES ", "1", "t", "no", "0", "", "False")
    text = F.lit(None).cast("string")
    for i, word in enumerate(words):
        text = F.when(k == i, word).otherwise(text)
    rows = view(spark, sf_dir, "events").select("event_id", text.alias("a"), (F.col("event_id") % 3).cast("int").alias("b"))
    a, b = F.col("a"), F.col("b")
    return rows.select("event_id", V.truthy_text(a).alias("text_flag"), V.truthy(b).alias("number_flag"),
                       V.any_flag(a, b).alias("any_flag"), V.alert_flag(a).alias("alert_flag"))


@query("clean_source_ip", sql="""
with raw as (select event_id, case event_id % 8 when 0 then '' when 1 then 'Unknown' when 2 then 'NaN' when 3 then 'host1' when 4 then '::1'
  when 5 then null else '10.0.0.' || (user_id % 8) end as ip from events)
select event_id, case when lower(ip) in ('', 'unknown', 'null', 'none', 'nan') then null
  when ip not like '%.%' and ip not like '%:%' then null else ip end as source_ip from raw""")
def clean_source_ip(spark, sf_dir):
    k = F.col("event_id") % 8
    ip = (F.when(k == 0, "").when(k == 1, "Unknown").when(k == 2, "NaN").when(k == 3, "host1").when(k == 4, "::1")
          .when(k == 5, F.lit(None)).otherwise(F.concat(F.lit("10.0.0."), (F.col("user_id") % 8).cast("string"))))
    return view(spark, sf_dir, "events").select("event_id", V.clean_address(ip).alias("source_ip"))


@query("nest_geoip", views=("raw_docs",), ctes=TYPED, sql="""
select doc_id, geoip_country as country_name, geoip_city as city_name from ssh_out""")
def nest_geoip(spark, sf_dir):
    rows = rec.ssh_records(raw_documents(spark, sf_dir)).select(
        "doc_id", V.nest_geo(F.col("geoip_country"), F.col("geoip_city")).alias("geoip"))
    return rows.select("doc_id", "geoip.country_name", "geoip.city_name")


@query("clean_placeholders", sql="""
with raw as (select event_id, case event_id % 7 when 0 then '—' when 1 then ' - ' when 2 then 'N/A' when 3 then null
  when 4 then ' 12.5 ' when 5 then 'None' else 'text' end as v from events)
select event_id, case when coalesce(trim(v), '') in ('', '—', '-', 'N/A', 'n/a', 'None', 'null') then '' else trim(v) end as cleaned,
  case when event_id % 7 = 4 then cast(12.5 as double) end as number from raw""")
def clean_placeholders(spark, sf_dir):
    k = F.col("event_id") % 7
    v = (F.when(k == 0, "—").when(k == 1, " - ").when(k == 2, "N/A").when(k == 3, F.lit(None)).when(k == 4, " 12.5 ")
         .when(k == 5, "None").otherwise("text"))
    return view(spark, sf_dir, "events").select("event_id", V.clean_text(v).alias("cleaned"), V.number_or_null(v).alias("number"))


@query("auth_relevance_filter", sql="""
with raw as (select event_id, case event_id % 7 when 0 then 'Accepted publickey for u: ssh2' when 1 then 'Successful su for root by www' when 2 then 'PAM_unix(x:session): opened'
  when 3 then 'CRON run' when 4 then '  ' when 5 then 'Invalid user bob' else 'www : TTY=x ; COMMAND=sudo ls' end as body from events)
select event_id, body from raw where trim(body) <> '' and (lower(body) like '%ssh%' or lower(body) like '%su[%' or lower(body) like '%sudo%'
  or lower(body) like '%pam_unix%' or lower(body) like '%cron%')""")
def auth_relevance_filter(spark, sf_dir):
    k = F.col("event_id") % 7
    body = (F.when(k == 0, "Accepted publickey for u: ssh2").when(k == 1, "Successful su for root by www")
            .when(k == 2, "PAM_unix(x:session): opened").when(k == 3, "CRON run").when(k == 4, "  ")
            .when(k == 5, "Invalid user bob").otherwise("www : TTY=x ; COMMAND=sudo ls"))
    rows = view(spark, sf_dir, "events").select("event_id", body.alias("body"))
    return rows.where(P.relevant_auth_body(F.col("body")))


@query("label_join", views=("auth_log", "label_lines"), ctes=PARSED + r""",
hits as (select line from label_lines where labels_text like '%attacker%' or labels_text in ('escalate')),
bodies as (select event_id, event_id + 1 as line_no, regexp_extract(message, '^\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2}\s+\S+\s+\S+?(?:\[\d+\])?:\s*(.*)$', 1) as body from auth_log)
""", sql="""
select b.line_no, s.is_attack or h.line is not null as is_attack,
  case when h.line is not null and s.attack_type = '' then 'escalation' else s.attack_type end as attack_type
from bodies b join ssh s using (event_id) left join hits h on b.line_no = h.line
where lower(b.body) like '%ssh%' or lower(b.body) like '%pam_unix%'""")
def label_join(spark, sf_dir):
    numbered = auth_lines(spark, sf_dir).select(
        (F.col("event_id") + 1).alias("line_no"), F.col("message").alias("value"))
    labels = view(spark, sf_dir, "label_lines").select("line", F.split("labels_text", ",").alias("labels"))
    events = rec.auth_log_events(numbered, BASE_YEAR)
    return rec.apply_labels(events, rec.attack_label_lines(labels)).select("line_no", "is_attack", "attack_type")
