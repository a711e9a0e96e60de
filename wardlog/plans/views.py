"""Log-shaped views of the sample tables.

Each view is one SQL text with two dialect slots, so Spark and the checking
engine build the very same rows. Nothing here is used by the library proper.

Log lines are data at rest, so the two rendered logs are written to the shared
folder the first time a session asks for them and scanned from there; queries
over them measure parsing stored text, not rendering it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardlog.session import scratch_path

BASE_YEAR = 2024

AUTH_LOG = """
select event_id, {ts} as ts, user_id, event_type, value,
  concat({fmt}, ' localhost sshd[', cast(event_id as {text}), ']: ', case event_type
    when 'error'  then concat('Failed password for invalid user u', cast(user_id as {text}), ' from 10.0.0.', cast(user_id % 8 as {text}), ' port 22 ssh2')
    when 'click'  then concat('Accepted password for u', cast(user_id as {text}), ' from 10.0.0.', cast(user_id % 8 as {text}), ' port 22 ssh2')
    when 'view'   then concat('Accepted publickey for u', cast(user_id as {text}), ' from 10.0.0.', cast(user_id % 8 as {text}), ' port 22 ssh2')
    when 'signup' then concat('pam_unix(sshd:session): session opened for user u', cast(user_id as {text}))
    else concat('Received disconnect from 10.0.0.', cast(user_id % 8 as {text}), ': 11: Bye') end) as message
from events
"""

WEB_LOG = """
select page_id, concat('10.1.0.', cast(page_id % 16 as {text})) as source_ip, req as request, resp as response,
  cast(length(html) as bigint) as bytes,
  concat('10.1.0.', cast(page_id % 16 as {text}), ' - - [01/Jan/2024:00:00:', lpad(cast(page_id % 60 as {text}), 2, '0'),
         ' +0700] "GET ', req, ' HTTP/1.1" ', cast(resp as {text}), ' ', cast(length(html) as {text})) as message
from (select *, substr(url, 8 + instr(substr(url, 8), '/') - 1) as req,
        case when page_id % 10 < 7 then 200 when page_id % 10 < 9 then 404 else 500 end as resp from pages) q
"""

# Attack requests appended to page requests, so that every rule has hits and misses.
WEB_REQUESTS = """
select page_id, source_ip, message, response,
  concat(request, case page_id % 11
    when 1 then '?a=1 union select 2' when 2 then '?q=x'' or a = b' when 3 then '?cmd=<script>alert(1)</script>'
    when 4 then '?id=1'' OR ''1''=''1' when 5 then '?u=javascript:x' when 6 then '?t=drop table x'
    when 7 then '?e=exec (1)' else '' end) as request
from web_log
"""

RAW_DOCS = """
select event_id as doc_id, ts as timestamp, message,
  case when event_id % 3 = 0 then 'ssh' end as log_type,
  case when event_id % 3 = 1 then 'ssh' end as fields_log_type,
  case when event_id % 5 = 1 then concat('172.16.0.', cast(event_id % 9 as {text})) end as src_ip,
  case when event_id % 4 = 0 then 'VN' end as country, case when event_id % 8 = 0 then 'Hanoi' end as city,
  case when event_id % 5 = 0 then concat('192.168.0.', cast(event_id % 9 as {text})) end as source_ip,
  cast(null as {text}) as clientip,
  case when event_id % 11 = 0 then 'svc' end as "user", case when event_id % 13 = 0 then 'Failed' end as status,
  case when event_id % 17 = 0 then true end as is_attack, case when event_id % 19 = 0 then 'manual' end as attack_type,
  cast(null as {text}) as request, cast(null as int) as response, cast(null as bigint) as bytes, cast(null as {text}) as verb
from auth_log
union all
select 1000000000000 + page_id, timestamp '2024-01-02 00:00:00', message,
  case when page_id % 4 = 0 then 'web' when page_id % 4 = 3 then 'app' end,
  case when page_id % 4 = 1 then 'web_error' end,
  case when page_id % 3 = 1 then source_ip end,
  case when page_id % 2 = 0 then 'VN' end, cast(null as {text}),
  cast(null as {text}),
  case when page_id % 3 = 0 then source_ip end,
  cast(null as {text}), cast(null as {text}), case when page_id % 7 = 0 then true end,
  case when page_id % 7 = 0 then 'xss' end,
  request, response, bytes, 'GET'
from web_log
"""

PREDICTIONS = """
select event_id, {ts} as timestamp, concat('10.0.0.', cast(user_id % 8 as {text})) as source_ip,
  event_type = 'error' as is_attack,
  case when event_type = 'error' then case when event_id % 7 = 0 then 'escalation' when event_id % 5 = 0 then '' else 'brute_force' end
       else '' end as attack_type,
  value / 500 > 0.2 as ml_anomaly, value / 500 as ml_anomaly_score,
  case event_id % 4 when 0 then 'unified' when 1 then 'kaggle' when 2 then 'russellmitchell' else 'custom' end as ml_model
from events
"""

LABEL_LINES = """
select event_id + 1 as line,
  case (event_id {idiv} 50) % 3 when 0 then 'foothold,attacker_vpn' when 1 then 'escalate' else 'benign' end as labels_text
from events where event_id % 50 = 0
"""

MULTILINE = """
select 'auth.log' as file, event_id * 2 + 1 as line_no, message as value from auth_log
union all
select 'auth.log', event_id * 2 + 2, concat('  continued ', cast(event_id as {text})) from auth_log where event_id % 10 = 0
"""

VIEWS = {"auth_log": AUTH_LOG, "web_log": WEB_LOG, "web_requests": WEB_REQUESTS, "raw_docs": RAW_DOCS,
         "predictions": PREDICTIONS, "label_lines": LABEL_LINES, "multiline_lines": MULTILINE}

SPARK = {"text": "string", "fmt": "date_format(ts, 'MMM dd HH:mm:ss')", "ts": "cast(ts as timestamp)", "idiv": "div"}
DUCKDB = {"text": "varchar", "fmt": "strftime(ts, '%b %d %H:%M:%S')", "ts": "ts", "idiv": "//"}
NEEDS = {"auth_log": ("events",), "web_log": ("pages",), "web_requests": ("web_log",),
         "raw_docs": ("auth_log", "web_log"), "predictions": ("events",), "label_lines": ("events",),
         "multiline_lines": ("auth_log",)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


STORED = ("auth_log", "web_log")
_stored_paths: dict[tuple[str, str, str], str] = {}


def _render(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name].format(**SPARK).replace('"user"', "`user`")
    for source in NEEDS[name]:
        sql = sql.replace(f"from {source}", f"from {{{source}}}")
    return spark.sql(sql, **{s: view(spark, sf_dir, s) for s in NEEDS[name]})


def _stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored_paths:
        lines = _render(spark, sf_dir, name)
        cores = spark.sparkContext.defaultParallelism
        if lines.rdd.getNumPartitions() < cores:  # a small sample in one file
            lines = lines.repartition(cores)
        path = scratch_path(spark, name)
        lines.write.parquet(path)
        _stored_paths[key] = path
    return spark.read.parquet(_stored_paths[key])


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark rows of a view (or of a plain table)."""
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    return _stored(spark, sf_dir, name) if name in STORED else _render(spark, sf_dir, name)


def duckdb_views(*names: str) -> str:
    """The ``with`` list that defines the named views and what they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in VIEWS or name in ordered:
            return
        for source in NEEDS[name]:
            add(source)
        ordered.append(name)

    for name in names:
        add(name)
    return ",\n".join(f"{n} as ({VIEWS[n].format(**DUCKDB)})" for n in ordered)
