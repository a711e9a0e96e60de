"""Dashboard, response, balancing and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlog.operators import activity as act
from wardlog.operators import balance as bal
from wardlog.operators import metrics as M
from wardlog.operators import respond as rsp
from wardlog.plans.parse_queries import PARSED, ssh_events
from wardlog.plans.registry import query
from wardlog.plans.views import view
from wardlog.session import materialize
from wardlog.sources import readers as rd
from wardlog.sources import writers as wr

ANCHOR = '(select max("timestamp") from predictions)'


def _preds(spark, sf_dir):
    return view(spark, sf_dir, "predictions")


def _sql_lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _actions_sql() -> str:
    rows = [f"({_sql_lit(k)}, {_sql_lit(s)}, {i}, {_sql_lit(t)}, {_sql_lit(d)})"
            for k in rsp.CATALOGUE for s in ("high", "medium")
            for i, (t, d) in enumerate(rsp.actions(k, s), start=1)]
    return "catalogue(kind, level, pos, title, detail) as (values " + ", ".join(rows) + ")"


KIND = "coalesce(nullif(trim(attack_type), ''), 'unknown')"
KNOWN = "case when {k} in (" + ", ".join(_sql_lit(k) for k in rsp.CATALOGUE) + ") then {k} else 'unknown' end"
TITLES = _actions_sql() + """,
titles as (select kind, level, string_agg(title, ' | ' order by pos) as titles, string_agg(pos || '. ' || title || ': ' || detail, chr(10) order by pos) as text from catalogue group by kind, level)"""
RECOMMENDED = TITLES + f""",
recommended as (select p.*, t.titles as defense_recommendations from predictions p
  join titles t on t.kind = {KNOWN.format(k=KIND)} and t.level = case when ml_anomaly or is_attack then 'high' else 'medium' end)"""


# --- activity ----------------------------------------------------------------

@query("activity_anchor", views=("predictions",), sql=f"select {ANCHOR} as anchor")
def activity_anchor(spark, sf_dir):
    rows = _preds(spark, sf_dir)
    return act.activity_anchor(rows, rows)


@query("activity_totals", views=("predictions",), sql="""
select count(*) as logs_count, count(*) filter (where is_attack) as attacks_count from predictions""")
def activity_totals(spark, sf_dir):
    return act.activity_totals(_preds(spark, sf_dir))


@query("recent_activity", views=("predictions",), sql=f"""
select count(*) filter (where is_attack and "timestamp" >= date_trunc('day', a)) as attack_today,
  count(*) filter (where is_attack and "timestamp" >= a - interval 5 minutes) as attack_5min
from predictions, (select {ANCHOR} as a) q""")
def recent_activity(spark, sf_dir):
    return act.recent_activity(_preds(spark, sf_dir))


@query("top_attacker", views=("predictions",), sql=f"""
with c as (select source_ip, count(*) as n, count(*) filter (where "timestamp" >= {ANCHOR} - interval 5 minutes) as n5 from predictions where is_attack group by source_ip)
select (select source_ip from c order by n desc, source_ip limit 1) as top_ip,
  (select source_ip from c where n5 > 0 order by n5 desc, source_ip limit 1) as top_ip_5m, coalesce((select max(n5) from c), 0) as top_ip_count_5m""")
def top_attacker(spark, sf_dir):
    return act.top_attacker(_preds(spark, sf_dir))


BUCKETS = f"""
buckets as (select unnest(generate_series(date_trunc('hour', {ANCHOR}) - interval 23 hours, date_trunc('hour', {ANCHOR}), interval 1 hour)) as hour_start)
"""
TIMELINE = BUCKETS + f""",
timeline as (select hour_start, strftime(hour_start, '%H') as hour_label, coalesce(n, 0) as attacks from buckets left join (
  select date_trunc('hour', "timestamp") as hour_start, count(*) as n from (
    select "timestamp" from predictions where is_attack union all select "timestamp" from predictions where is_attack or ml_anomaly) m
  where "timestamp" between {ANCHOR} - interval 24 hours and {ANCHOR} group by 1) c using (hour_start))
"""


@query("hourly_timeline", views=("predictions",), ctes=TIMELINE, sql="select * from timeline")
def hourly_timeline(spark, sf_dir):
    rows = _preds(spark, sf_dir)
    return act.hourly_timeline(rows, [rows])


@query("hourly_first_time", views=("predictions",), ctes=TIMELINE, sql="select * from timeline")
def hourly_first_time(spark, sf_dir):
    """The same where the time is in one of three columns, as text, beside junk and blanks."""
    rows = _preds(spark, sf_dir)
    text, turn = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.col("event_id") % 3
    spread = rows.select(F.when(turn == 0, text).otherwise("soon").alias("timestamp"), F.when(turn == 1, text).when(turn == 2, "").alias("Timestamp"),
                         F.when(turn != 0, text).alias("@timestamp"), *[c for c in rows.columns if c != "timestamp"])
    return act.hourly_timeline(spread, [spread])


MODEL_RANK = "case ml_model when 'unified' then 1 when 'kaggle' then 2 when 'russellmitchell' then 3 when 'custom' then 4 end"
HOURLY = BUCKETS + f""",
base as (select *, date_trunc('hour', "timestamp") as h, {KIND} as kind, {MODEL_RANK} as mrank from predictions),
att as (select * from base where is_attack),
ips as (select h, source_ip, row_number() over (partition by h order by count(*) desc, source_ip) as r from att group by h, source_ip),
kinds as (select h, kind, row_number() over (partition by h order by count(*) desc, kind) as r from att group by h, kind),
models as (select h, mrank, row_number() over (partition by h order by count(*) desc, mrank) as r from att group by h, mrank),
hourly as (select b.hour_start, strftime(b.hour_start, '%H') as hour_label, coalesce(t.n, 0) as total_alerts, coalesce(t.a, 0) as attacks,
  ips.source_ip as top_ip, kinds.kind as top_attack_type, t.s as avg_score,
  case models.mrank when 1 then 'Unified' when 2 then 'Kaggle' when 3 then 'Russell' when 4 then 'Custom' end as top_model
  from buckets b left join (select h, count(*) as n, count(*) filter (where is_attack) as a, avg(ml_anomaly_score) filter (where is_attack) as s from base group by h) t on t.h = b.hour_start
  left join ips on ips.h = b.hour_start and ips.r = 1 left join kinds on kinds.h = b.hour_start and kinds.r = 1 left join models on models.h = b.hour_start and models.r = 1)
"""


@query("hourly_attack_table", views=("predictions",), ctes=HOURLY, sql="""
select hour_start, hour_label, total_alerts, attacks, top_ip, top_attack_type, round(avg_score, 6) as avg_score, top_model from hourly""")
def hourly_attack_table(spark, sf_dir):
    return act.hourly_attack_table(_preds(spark, sf_dir)).withColumn("avg_score", F.round("avg_score", 6))


@query("hourly_top_entities", views=("predictions",), ctes=HOURLY, sql="""
select hour_start, top_ip, top_attack_type, top_model from hourly where attacks > 0""")
def hourly_top_entities(spark, sf_dir):
    table = act.hourly_attack_table(_preds(spark, sf_dir)).where("attacks > 0")
    return table.select("hour_start", "top_ip", "top_attack_type", "top_model")


@query("model_tagged_union", views=("predictions",), sql="""
select ml_model, count(*) as n, count(*) filter (where is_attack) as attacks from predictions group by ml_model""")
def model_tagged_union(spark, sf_dir):
    rows = _preds(spark, sf_dir)
    sets = {m: rows.where(F.col("ml_model") == m).drop("ml_model") for m in act.MODEL_PRIORITY}
    return act.tag_model(sets).groupBy("ml_model").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_attack").alias("attacks"))


@query("hourly_severity", views=("predictions",), ctes=HOURLY, sql="""
select hour_start, printf('%02d:00-%02d:00', hour(hour_start), (hour(hour_start) + 1) % 24) as hour_range, attacks,
  round(attacks * 100.0 / total_alerts, 6) as attack_rate, top_ip, top_attack_type, round(avg_score, 6) as avg_score, top_model,
  case when attacks * 100.0 / total_alerts >= 80 or avg_score >= 0.7 then 'High' when attacks * 100.0 / total_alerts >= 40 or avg_score >= 0.4 then 'Medium' else 'Low' end as severity
from hourly where attacks > 0""")
def hourly_severity(spark, sf_dir):
    rows = act.hourly_severity(act.hourly_attack_table(_preds(spark, sf_dir)))
    return rows.withColumns({c: F.round(c, 6) for c in ("attack_rate", "avg_score")})


@query("hourly_summary_text", views=("predictions",), ctes=TIMELINE, sql="""
with busy as (select *, row_number() over (order by hour_start) as r, count(*) over () as c from timeline where attacks > 0)
select coalesce(string_agg(hour_label || ': ' || attacks, ', ' order by hour_start) filter (where r <= 12), '') as summary,
  cast(greatest(coalesce(max(c), 0) - 12, 0) as int) as further_hours from busy""")
def hourly_summary_text(spark, sf_dir):
    rows = _preds(spark, sf_dir)
    return act.hourly_summary_text(act.hourly_timeline(rows, [rows]))


@query("ingest_and_alert_rate", views=("predictions",), sql=f"""
select round(count(*) filter (where "timestamp" >= {ANCHOR} - interval 1 hour) / 60, 1) as ingestion_rate,
  count(*) filter (where "timestamp" >= {ANCHOR} - interval 1 hour and (is_attack or ml_anomaly)) as alert_rate from predictions""")
def ingest_and_alert_rate(spark, sf_dir):
    return act.ingest_and_alert_rate(_preds(spark, sf_dir))


@query("alert_breakdown", views=("predictions",), sql="""
select date_trunc('hour', "timestamp") as bucket, ml_model, source_ip, count(*) as alerts from predictions where ml_anomaly group by all""")
def alert_breakdown(spark, sf_dir):
    return act.alert_breakdown(_preds(spark, sf_dir).where("ml_anomaly"))


@query("prediction_summary", views=("predictions",), sql="""
select count(*) as total, count(*) filter (where ml_anomaly) as ml_count, count(*) filter (where is_attack) as rule_count,
  (select source_ip from predictions group by source_ip order by count(*) desc, source_ip limit 1) as top_ip from predictions""")
def prediction_summary(spark, sf_dir):
    return rsp.prediction_summary(_preds(spark, sf_dir))


# --- response ----------------------------------------------------------------

@query("defense_recommendations", views=("predictions",), ctes=RECOMMENDED, sql="""
select event_id, attack_type, defense_recommendations from recommended""")
def defense_recommendations(spark, sf_dir):
    return rsp.attach_recommendations(_preds(spark, sf_dir)).select("event_id", "attack_type", "defense_recommendations")


@query("recommendation_text", views=("predictions",), ctes=TITLES, sql=f"""
select event_id, text as recommendation_text from predictions join titles on kind = {KNOWN.format(k='attack_type')}
  and level = case when ml_anomaly then 'high' else 'medium' end""")
def recommendation_text(spark, sf_dir):
    rows = _preds(spark, sf_dir).withColumn("severity", F.when(F.col("ml_anomaly"), "high").otherwise("medium"))
    return rsp.recommendation_text(rows).select("event_id", "recommendation_text")


@query("defense_plan", views=("predictions",), ctes=TITLES, sql=f"""
with c as (select {KIND} as attack_type, count(*) filter (where ml_anomaly) as ml_count, count(*) filter (where is_attack) as rule_count
  from predictions where ml_anomaly or is_attack group by 1),
g as (select *, case when ml_count > 0 then 'high' else 'medium' end as severity from c)
select attack_type, ml_count, rule_count, severity, (select string_agg(pos || '. ' || title || ': ' || detail, chr(10) order by pos)
  from catalogue where kind = {KNOWN.format(k='attack_type')} and level = severity and pos <= 3) as actions from g""")
def defense_plan(spark, sf_dir):
    return rsp.defense_plan(_preds(spark, sf_dir))


@query("defense_top_addresses", views=("predictions",), sql="""
select source_ip, count(*) as n from predictions where ml_anomaly or is_attack group by source_ip order by n desc, source_ip limit 3""")
def defense_top_addresses(spark, sf_dir):
    return rsp.top_addresses(_preds(spark, sf_dir))


PRIORITY = RECOMMENDED + """,
top3 as (select event_id, "timestamp", source_ip, attack_type, ml_model, ml_anomaly_score, defense_recommendations, is_attack, ml_anomaly from recommended
  where ml_anomaly order by ml_anomaly_score desc, "timestamp", source_ip, event_id limit 3)"""
TIE = ("timestamp", "source_ip", "event_id")


def _top3(spark, sf_dir):
    return rsp.attach_recommendations(rsp.priority_alerts(_preds(spark, sf_dir), tie=TIE))


@query("priority_alerts", views=("predictions",), ctes=PRIORITY, sql="""
select event_id, source_ip, attack_type, ml_anomaly_score, 'ML_ATTACK' as ml_label, case when is_attack then 'RULE_ATTACK' else 'RULE_NORMAL' end as rule_label from top3""")
def priority_alerts(spark, sf_dir):
    return _top3(spark, sf_dir).select("event_id", "source_ip", "attack_type", "ml_anomaly_score", "ml_label", "rule_label")


def _checklist_order():
    return [-F.col("ml_anomaly_score"), F.col("timestamp"), F.col("source_ip")]


@query("defense_checklist", views=("predictions",), ctes=PRIORITY, sql="""
with parts as (select ml_anomaly_score, "timestamp", source_ip, string_split(defense_recommendations, ' | ') as l from top3),
items as (select ml_anomaly_score, "timestamp", source_ip, unnest(l) as item, generate_subscripts(l, 1) as p from parts),
ranked as (select item, row_number() over (partition by lower(item) order by ml_anomaly_score desc, "timestamp", source_ip, p) as r,
  ml_anomaly_score, "timestamp", source_ip, p from items)
select cast(row_number() over (order by ml_anomaly_score desc, "timestamp", source_ip, p) as int) as pos, item from ranked where r = 1 qualify pos <= 5""")
def defense_checklist(spark, sf_dir):
    return rsp.defense_checklist(_top3(spark, sf_dir), _checklist_order())


@query("alert_feed", views=("predictions",), ctes=RECOMMENDED, sql="""
with latest as (select * from recommended order by "timestamp" desc, event_id limit 10),
shown as (select *, row_number() over (order by "timestamp" desc, event_id) as pos from latest where ml_anomaly or not (select bool_or(ml_anomaly) from latest))
select cast(pos as int) as pos, strftime("timestamp", '%Y-%m-%d %H:%M:%S') || ' | ' || case when ml_anomaly then 'ML_ATTACK' else 'ML_NORMAL' end || ' | ' ||
  case when is_attack then 'RULE_ATTACK' else 'RULE_NORMAL' end || ' | ' || source_ip || ' | ' || coalesce(nullif(attack_type, ''), 'unknown')
  || ' | score=' || printf('%.4f', ml_anomaly_score) || ' | model=' || ml_model || ' | rec=' || defense_recommendations as line from shown
where pos <= case when (select bool_or(ml_anomaly) from latest) then 10 else 5 end""")
def alert_feed(spark, sf_dir):
    latest = rsp.attach_recommendations(rd.latest_alerts(_preds(spark, sf_dir), 10, tie="event_id"))
    order = [-F.unix_micros("_at"), F.col("event_id")]
    shaped = latest.withColumn("_at", F.col("timestamp")).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).withColumn(
        "ml_anomaly_score", F.format_string("%.4f", "ml_anomaly_score"))
    return rsp.alert_feed(shaped, order)


@query("incident_summary", views=("predictions",), sql="""
with c as (select count(*) as records, count(*) filter (where ml_anomaly) as ml, count(*) filter (where is_attack) as rl from predictions)
select records, ml as ml_anomalies, rl as rule_warnings,
  case when ml > 0 then 'ATTACK DETECTED (ML confirmed)' when rl > 0 then 'NO ML ATTACK (RULE WARNING ONLY)' else 'NO ATTACK DETECTED' end as decision,
  case when ml > 0 then case when ml >= greatest(3, records // 5) then 'high' else 'medium' end when rl > 0 then 'low' else 'info' end as severity,
  case when ml > 0 then 'high' when rl > 0 then 'medium' else 'low' end as confidence,
  case when ml > 0 then 'act_now' when rl > 0 then 'watch_closely' else 'keep_monitoring' end as action_status,
  case when records <= 10 then 'preview_10_records' else 'expanded_records' end as data_scope from c""")
def incident_summary(spark, sf_dir):
    return rsp.incident_summary(_preds(spark, sf_dir)).drop("_kind")


def _case_sql(table: dict[str, str]) -> str:
    return f"case when ml > 0 then {_sql_lit(table['ml'])} when rl > 0 then {_sql_lit(table['rule'])} else {_sql_lit(table['none'])} end"


REPORT_SQL = f"""
with c as (select count(*) as records, count(*) filter (where ml_anomaly) as ml, count(*) filter (where is_attack) as rl from predictions),
parts as (select event_id, ml_anomaly_score, "timestamp", source_ip, string_split(defense_recommendations, ' | ') as l from top3),
items as (select *, unnest(l) as item, generate_subscripts(l, 1) as p from parts),
firsts as (select *, row_number() over (partition by lower(item) order by ml_anomaly_score desc, "timestamp", source_ip, p) as r from items),
steps as (select item, row_number() over (order by ml_anomaly_score desc, "timestamp", source_ip, p) as pos from firsts where r = 1 qualify pos <= {rsp.CHECKLIST_ITEMS})
select 'alerts' as source, 'unified' as model, 'ml-alerts-x' as run_index, {_case_sql(rsp.DECISIONS)} as decision, {_case_sql(rsp.CONCLUSIONS)} as executive_conclusion,
  case when ml > 0 then case when ml >= greatest(3, records // 5) then 'high' else 'medium' end when rl > 0 then 'low' else 'info' end as severity,
  {_case_sql({"ml": "high", "rule": "medium", "none": "low"})} as confidence, {_case_sql(rsp.ACTION_STATUS)} as action_status,
  case when records <= {rsp.PREVIEW_ROWS} then 'preview_10_records' else 'expanded_records' end as data_scope,
  case when records <= {rsp.PREVIEW_ROWS} then {_sql_lit(rsp.SCOPE_NOTES['preview'])} else {_sql_lit(rsp.SCOPE_NOTES['expanded'])} end as analysis_scope_note,
  records, ml as ml_anomalies, rl as rule_warnings,
  (select string_agg(strftime("timestamp", '%Y-%m-%d %H:%M:%S') || ' ' || source_ip || ' ' || coalesce(nullif(attack_type, ''), 'unknown') || ' ' || ml_model || ' '
     || printf('%.4f', ml_anomaly_score) || ' ML_ATTACK ' || case when is_attack then 'RULE_ATTACK' else 'RULE_NORMAL' end || ' ' || defense_recommendations, chr(10)
     order by ml_anomaly_score desc) from top3) as top_alerts,
  (select string_agg(item, chr(10) order by pos) from steps) as defense_checklist,
  {_case_sql({k: chr(10).join(v) for k, v in rsp.NEXT_ACTIONS.items()})} as next_actions
from c"""


@query("incident_report", views=("predictions",), ctes=PRIORITY, sql=REPORT_SQL)
def incident_report(spark, sf_dir):
    rows = _preds(spark, sf_dir)
    # Three rows, read by the checklist and by the report: found once.
    top = materialize(_top3(spark, sf_dir), "top-alerts")
    report = rsp.incident_report(rows, rsp.defense_checklist(top, _checklist_order()), top.withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")), "alerts", "unified", "ml-alerts-x", F.current_timestamp())
    return shown_report(report)


def shown_report(report):
    """The report with its lists as text."""
    shown = F.transform("top_alerts", lambda a: F.concat_ws(
        " ", a["timestamp"], a["source_ip"], a["attack_type"], a["ml_model"], F.format_string("%.4f", a["ml_anomaly_score"]),
        a["ml_label"], a["rule_label"], a["defense_recommendations"]))
    return report.select(
        "source", "model", "run_index", "decision", "executive_conclusion", "severity", "confidence", "action_status", "data_scope",
        "analysis_scope_note", "summary.records", "summary.ml_anomalies", "summary.rule_warnings",
        F.array_join(shown, "\n").alias("top_alerts"), F.array_join("defense_checklist", "\n").alias("defense_checklist"),
        F.array_join("next_actions", "\n").alias("next_actions"))


# --- alert table -------------------------------------------------------------

@query("alert_table", views=("predictions",), ctes=RECOMMENDED, sql="""
select event_id, "timestamp" as "@timestamp", source_ip, ml_anomaly, ml_anomaly_score, 'unified' as ml_model, is_attack, attack_type, defense_recommendations,
  '' as country_name, '' as city_name from recommended""")
def alert_table(spark, sf_dir):
    rows = wr.alert_rows(_preds(spark, sf_dir), "unified", dedup_order="event_id")
    return rows.select("event_id", "@timestamp", "source_ip", "ml_anomaly", "ml_anomaly_score", "ml_model", "is_attack",
                       "attack_type", "defense_recommendations", "geoip.country_name", "geoip.city_name")


@query("alerts_only", views=("predictions",), sql="""
select event_id, ml_anomaly_score from predictions where ml_anomaly""")
def alerts_only(spark, sf_dir):
    rows = wr.alert_rows(_preds(spark, sf_dir), dedup_order="event_id", anomalies_only=True)
    return rows.select("event_id", "ml_anomaly_score")


@query("alert_dedup", views=("predictions",), sql="""
select min(event_id) as event_id, date_trunc('hour', "timestamp") as hour_start, source_ip, floor(ml_anomaly_score * 10) / 10 as score
from predictions group by 2, 3, 4""")
def alert_dedup(spark, sf_dir):
    rows = _preds(spark, sf_dir).withColumn("timestamp", F.date_trunc("hour", "timestamp")).withColumn(
        "ml_anomaly_score", F.floor(F.col("ml_anomaly_score") * 10) / 10)
    kept = wr.alert_rows(rows, dedup_order="event_id")
    return kept.select("event_id", F.col("@timestamp").alias("hour_start"), "source_ip", F.col("ml_anomaly_score").alias("score"))


# --- training set ------------------------------------------------------------

SOURCES = PARSED + """,
sources as (select *, event_id % 5 = 4 or is_attack as hostile, case event_id % 5 when 0 then 'Kaggle' when 1 then 'Synthetic' when 2 then 'Custom'
  when 3 then 'Russell Mitchell' else 'Other' end as src from ssh),
hashed as (select *, md5(event_id || '#42') as h, case src when 'Kaggle' then 0 when 'Synthetic' then 1 when 'Custom' then 2 when 'Russell Mitchell' then 3 else 4 end as g from sources),
totals as (select count(*) filter (where not hostile) as normal, count(*) filter (where hostile) as attacks,
  cast(round_even(0.3 * count(*) filter (where not hostile) / (1.0 - 0.3), 0) as bigint) as target from hashed),
per_src as (select g, count(*) as n from hashed where hostile group by g),
quota as (select g, n, case when g < 4 then n - least(n, greatest(0, (attacks - target) - coalesce((select sum(n) from per_src q where q.g < p.g), 0)))
  else least(n, target) end as keep_n from per_src p, totals),
balanced as (select * from hashed where not hostile union all
  select x.* exclude (r) from (select *, row_number() over (partition by g order by h) as r from hashed where hostile) x join quota using (g) where r <= keep_n)
"""
RATIO = 0.3


def _sources(spark, sf_dir):
    events = ssh_events(spark, sf_dir).withColumn("is_attack", (F.col("event_id") % 5 == 4) | F.col("is_attack"))
    names = ("Kaggle", "Synthetic", "Custom", "Russell Mitchell", "Other")
    return {name: events.where(F.col("event_id") % 5 == i) for i, name in enumerate(names)}


def _merged(spark, sf_dir):
    """The same five sources as one tagged table, read once."""
    names = F.array(*[F.lit(n) for n in ("Kaggle", "Synthetic", "Custom", "Russell Mitchell", "Other")])
    events = ssh_events(spark, sf_dir).withColumn("is_attack", (F.col("event_id") % 5 == 4) | F.col("is_attack"))
    tagged = events.withColumn("_source", F.get(names, (F.col("event_id") % 5).cast("int")))
    return bal.conform_training(tagged, keep=("event_id", "_source"))


@query("conform_training", views=("raw_docs",), sql="""
select doc_id, "timestamp", source_ip, cast(coalesce(try_cast(country as double), 0) as double) as geoip_country, cast(0 as double) as geoip_city, coalesce(is_attack, false) as is_attack, cast(null as varchar) as log_type
from raw_docs""")
def conform_training(spark, sf_dir):
    docs = view(spark, sf_dir, "raw_docs").drop("log_type").withColumnRenamed("country", "geoip_country").withColumn("host", F.lit("h"))
    rows = bal.conform_training(docs, keep=("doc_id",))
    return rows.select("doc_id", "timestamp", "source_ip", "geoip_country", "geoip_city", "is_attack", "log_type")


@query("rebalance_sources", views=("auth_log",), ctes=SOURCES, sql="""
select event_id, hostile as is_attack, src as _source from balanced""")
def rebalance_sources(spark, sf_dir):
    merged = _merged(spark, sf_dir)
    return bal.rebalance_sources(merged, "event_id", RATIO).select("event_id", "is_attack", "_source")


@query("unified_training", views=("auth_log",), ctes=SOURCES, sql="""
select event_id, "timestamp", source_ip, "user", status, hostile as is_attack from balanced order by "timestamp\"""")
def unified_training(spark, sf_dir):
    rows = bal.unified_training(_sources(spark, sf_dir), "event_id", ratio=RATIO)
    return rows.select("event_id", "timestamp", "source_ip", "user", "status", "is_attack")


@query("merge_report", views=("auth_log",), ctes=SOURCES, sql="""
select src as _source, count(*) as rows_before, count(*) filter (where hostile) as attacks_before,
  (select count(*) from balanced b where b.src = s.src) as rows_after, (select count(*) from balanced b where b.src = s.src and hostile) as attacks_after
from sources s group by src""")
def merge_report(spark, sf_dir):
    merged = _merged(spark, sf_dir)
    return bal.merge_report(merged, bal.rebalance_sources(merged, "event_id", RATIO))


CLASSED = """
classed as (select event_id, ts, event_type = 'error' as label, md5(event_id || '#42') as h from events),
ranked as (select *, row_number() over (partition by label order by h) as r, count(*) over (partition by label) as n from classed),
extremes as (select min(n) as lo, max(n) as hi from ranked)
"""


def _classed(spark, sf_dir):
    return view(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("timestamp"), (F.col("event_type") == "error").alias("label"))


@query("undersample", ctes=CLASSED, sql="""
select event_id, label from ranked, extremes where r <= lo""")
def undersample(spark, sf_dir):
    return bal.undersample(_classed(spark, sf_dir), "label", "event_id").select("event_id", "label")


@query("oversample", ctes=CLASSED, sql="""
select event_id, label, hi // n + case when r <= hi % n then 1 else 0 end as copies from ranked, extremes""")
def oversample(spark, sf_dir):
    rows = bal.oversample(_classed(spark, sf_dir), "label", "event_id")
    return rows.groupBy("event_id", "label").agg(F.count(F.lit(1)).alias("copies"))


@query("stratified_split", ctes=CLASSED, sql="""
select event_id, label, r <= ceil(n * 0.2) as is_test from ranked""")
def stratified_split(spark, sf_dir):
    return bal.stratified_split(_classed(spark, sf_dir), "label", "event_id").drop("timestamp")


@query("stratified_folds", ctes=CLASSED, sql="""
select event_id, label, cast(ntile(5) over (partition by label order by h) - 1 as int) as fold from classed""")
def stratified_folds(spark, sf_dir):
    return bal.stratified_folds(_classed(spark, sf_dir), "label", "event_id").drop("timestamp")


@query("time_split", ctes=CLASSED, sql="""
select event_id, row_number() over (order by ts, h) <= floor((select count(*) from events) * 0.7) as is_train from classed""")
def time_split(spark, sf_dir):
    return bal.time_split(_classed(spark, sf_dir), "event_id").select("event_id", "is_train")


# --- quality -----------------------------------------------------------------

CELLS = """
cells as (select count(*) filter (where is_attack and ml_anomaly) as tp, count(*) filter (where not is_attack and ml_anomaly) as fp,
  count(*) filter (where is_attack and not ml_anomaly) as fn, count(*) filter (where not is_attack and not ml_anomaly) as tn from predictions)
"""


@query("confusion_matrix", views=("predictions",), sql="""
select cast(is_attack as int) as label, cast(ml_anomaly as int) as predicted, count(*) as n from predictions group by all""")
def confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(_preds(spark, sf_dir), "is_attack", "ml_anomaly")


@query("binary_metrics", views=("predictions",), ctes=CELLS, sql="""
select round(tp / (tp + fp), 9) as precision, round(tp / (tp + fn), 9) as recall, round(2 * tp / (2 * tp + fp + fn), 9) as f1, tp, fp, fn, tn from cells""")
def binary_metrics(spark, sf_dir):
    rows = M.binary_metrics(_preds(spark, sf_dir), "is_attack", "ml_anomaly")
    return rows.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query("classification_report", views=("predictions",), ctes=CELLS, sql="""
with c as (select *, tn / (tn + fn) as p0, tn / (tn + fp) as r0, 2 * tn / (2 * tn + fn + fp) as f0, tp / (tp + fp) as p1, tp / (tp + fn) as r1,
  2 * tp / (2 * tp + fp + fn) as f1, tn + fp as n0, tp + fn as n1, tp + fp + fn + tn as n from cells),
t as (select '0' as name, p0 as p, r0 as r, f0 as f, n0 as support from c union all select '1', p1, r1, f1, n1 from c
  union all select 'accuracy', (tp + tn) / n, (tp + tn) / n, (tp + tn) / n, n from c
  union all select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n from c
  union all select 'weighted avg', (p0 * n0 + p1 * n1) / n, (r0 * n0 + r1 * n1) / n, (f0 * n0 + f1 * n1) / n, n from c)
select name, round(p, 9) as precision, round(r, 9) as recall, round(f, 9) as f1, support from t""")
def classification_report(spark, sf_dir):
    rows = M.classification_report(_preds(spark, sf_dir), "is_attack", "ml_anomaly")
    return rows.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query("roc_auc", views=("predictions",), sql="""
with r as (select is_attack, rank() over (order by ml_anomaly_score) + (count(*) over (partition by ml_anomaly_score) - 1) / 2.0 as rk from predictions)
select round((sum(rk) filter (where is_attack) - p * (p + 1) / 2.0) / (p * q), 9) as roc_auc
from r, (select count(*) filter (where is_attack) as p, count(*) filter (where not is_attack) as q from predictions) c group by p, q""")
def roc_auc(spark, sf_dir):
    return M.roc_auc(_preds(spark, sf_dir), "is_attack", "ml_anomaly_score").select(F.round("roc_auc", 9).alias("roc_auc"))


@query("score_threshold", views=("predictions",), sql="""
select round(quantile_cont(-ml_anomaly_score, 0.9), 9) as threshold, round(quantile_cont(-ml_anomaly_score, 0.1), 9) as tail_threshold from predictions""")
def score_threshold(spark, sf_dir):
    rows = _preds(spark, sf_dir).select((-F.col("ml_anomaly_score")).alias("s"))
    tail = M.score_threshold(rows, "s", 0.1, mode="tail").scalar()
    return M.score_threshold(rows, "s", 0.1).select(
        F.round("threshold", 9).alias("threshold"), F.round(tail, 9).alias("tail_threshold"))


@query("anomaly_rate", views=("predictions",), sql="""
select count(*) as total, count(*) filter (where ml_anomaly) as anomalies, round(count(*) filter (where ml_anomaly) / count(*), 9) as rate from predictions""")
def anomaly_rate(spark, sf_dir):
    return M.anomaly_rate(_preds(spark, sf_dir)).withColumn("rate", F.round("rate", 9))


@query("detection_accuracy", views=("predictions",), sql="""
select round(avg(cast(ml_anomaly = is_attack as int)) * 100, 1) as accuracy from predictions""")
def detection_accuracy(spark, sf_dir):
    return M.detection_accuracy(_preds(spark, sf_dir))
