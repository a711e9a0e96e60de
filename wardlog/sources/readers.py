"""Scans: text, CSV, JSON lines and stored log tables."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlog.functions import values as V
from wardlog.operators.keyed import scalar
from wardlog.schema import LABEL_LINE, has

# Dataset names tried, in order, when a request matches nothing.
FALLBACK_DATASETS = ("ssh-logs-*", "test-logs-*", "filebeat-*", "logstash-*", "logs-*", "*-logs-*")
SOURCE_DATASETS = ("test-logs-*", "ssh-logs-*", "filebeat-*", "logstash-*", "logs-*")
DEFAULT_DATASET = {"ssh": "ssh-logs-*", "web": "web-logs-*"}
ALERT_DATASET_PREFIX = "ml-alerts-"
# Input paths by the log type they are tagged with.
LOG_INPUTS = {
    "ssh": ("/var/log/auth.log",),
    "web": ("/var/log/apache2/access.log", "/var/log/httpd/access_log"),
    "web_error": ("/var/log/apache2/error.log", "/var/log/httpd/error_log"),
    "system": ("/var/log/syslog", "/var/log/messages"),
}
FORWARD_SLACK_HOURS = 12


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    matches = fs.globStatus(hadoop_path)
    return matches is not None and len(matches) > 0


def first_existing(spark: SparkSession, paths: Iterable[str]) -> str | None:
    """The first path that exists: prediction sets, models and log files by priority."""
    return next((p for p in paths if path_exists(spark, p)), None)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """CSV with a header and a declared schema; broken cells become null.

    Quoted newlines need ``multiline``, which makes each file one task.
    """
    return spark.read.csv(path, schema=schema, header=True, mode="PERMISSIVE", quote='"',
                          escape='"', multiLine=multiline, enforceSchema=False)


def list_csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files below a folder as ``path, size_mb``; their content is not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.csv").load(folder))
    return files.select("path", F.round(F.col("length") / (1024 * 1024), 2).alias("size_mb"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Job-level guard: an empty input is an error, not an empty result."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def read_text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Stripped lines without blanks and ``#`` comments."""
    return drop_comments(spark.read.text(path))


def drop_comments(lines: DataFrame) -> DataFrame:
    stripped = F.regexp_replace("value", r"^\s+|\s+$", "")
    return lines.withColumn("value", stripped).where("value <> '' and not startswith(value, '#')")


def read_numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, line_no, value`` with 1-based line numbers per file.

    A large file is read as many splits. Rows of a split have consecutive ids, so a line's place in
    its split is its id less the first of the split, and prefix sums of the splits' line counts give the rest: lines are
    neither sorted nor moved. One number for each split is broadcast, some 50 bytes for the
    128 MB a split has; both scans deal the splits alike, as they plan the same files.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"), "value")
    splits = lines.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = splits.select(F.xxhash64("file").alias("_file"), "_block",
                           (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1 - F.col("_first")).alias("_shift"))
    found = lines.withColumn("_file", F.xxhash64("file")).join(F.broadcast(shifts), ["_file", "_block"])
    return found.select("file", (F.col("_id") + F.col("_shift")).alias("line_no"), "value")


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines label sidecar; malformed and blank lines are skipped."""
    return spark.read.schema(LABEL_LINE).option("mode", "DROPMALFORMED").json(path).where(
        F.col("line").isNotNull() | F.col("labels").isNotNull())


def read_tagged(spark: SparkSession, inputs: dict[str, list[str]], stream: bool = False) -> DataFrame:
    """One text scan per log type, tagged under ``fields.log_type``.

    The same call with ``stream=True`` tails the paths instead.
    """
    result = None
    for log_type, paths in inputs.items():
        for path in paths:
            reader = spark.readStream if stream else spark.read
            lines = reader.text(path)
            if log_type == "system":
                lines = lines.where(~F.col("value").rlike("^#"))
            tagged = lines.select(
                F.col("value").alias("message"),
                F.struct(F.lit(log_type).alias("log_type")).alias("fields"))
            result = tagged if result is None else result.unionByName(tagged)
    if result is None:
        raise ValueError("no inputs given")
    return result


def lookback_bounds(now: Column, hours: int) -> tuple[Column, Column]:
    """``[end - hours, end]`` with ``end`` half a day ahead to admit skewed clocks."""
    end = now + F.make_interval(hours=F.lit(FORWARD_SLACK_HOURS))
    return end - F.make_interval(hours=F.lit(hours)), end


def time_range(docs: DataFrame, start: Column | dt.datetime, end: Column | dt.datetime,
               ts: str = "timestamp", date: str | None = "event_date", max_docs: int = 0) -> DataFrame:
    """Documents with ``start <= ts <= end``.

    On a table partitioned by ``event_date`` the date bound prunes partitions.
    ``max_docs`` is the optional document limit of the feature; 0 means all.
    """
    lo = start if isinstance(start, Column) else F.lit(start)
    hi = end if isinstance(end, Column) else F.lit(end)
    bounded = docs.where(F.col(ts).between(lo, hi))
    if date and has(docs, date):
        bounded = bounded.where(F.col(date).between(lo.cast("date"), hi.cast("date")))
    return bounded.limit(max_docs) if max_docs else bounded


def glob_regex(pattern: str) -> str:
    parts = {"*": ".*", "?": "."}
    return "^" + "".join(parts.get(ch, re.escape(ch)) for ch in pattern) + "$"


def matches_any(name: Column, patterns: Iterable[str]) -> Column:
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | name.rlike(glob_regex(pattern))
    return hit


def resolve_datasets(names: DataFrame, requested: str) -> DataFrame:
    """Dataset names a request stands for, as ``dataset, pattern``.

    ``requested`` is a comma-separated list of globs. If nothing matches, the
    first fallback glob with a match is used, leaving alert tables out.
    """
    wanted = [p.strip() for p in requested.split(",") if p.strip()]
    name = F.col("dataset")
    choice = F.when(matches_any(name, wanted), 0)
    ordinary = ~name.startswith(ALERT_DATASET_PREFIX)
    for rank, pattern in enumerate(FALLBACK_DATASETS, start=1):
        choice = choice.when(ordinary & matches_any(name, [pattern]), rank)
    label = F.element_at(F.array(*[F.lit(p) for p in (requested, *FALLBACK_DATASETS)]), F.col("_rank") + 1)
    visible = names.where(~name.startswith(".")).select("dataset").distinct()
    # A name can match several fallbacks; keep the best rank it offers per fallback.
    ranked = visible.withColumn("_rank", choice)
    best = scalar(ranked, F.min("_rank"))
    candidates = visible.withColumn("_rank", best).where(F.col("_rank").isNotNull())
    keep = F.when(F.col("_rank") == 0, matches_any(name, wanted))
    for rank, pattern in enumerate(FALLBACK_DATASETS, start=1):
        keep = keep.when(F.col("_rank") == rank, ordinary & matches_any(name, [pattern]))
    return candidates.where(keep).select("dataset", label.alias("pattern"))


def choose_datasets(docs: DataFrame, requested: str) -> Column:
    """The same choice as a filter on a dated log table.

    The dataset name is built from the table's partition columns only, so Spark
    answers the filter from the partition list without opening other files.
    """
    wanted = [p.strip() for p in requested.split(",") if p.strip()]
    name = F.col("dataset")
    for i, patterns in enumerate([wanted, *[[p] for p in FALLBACK_DATASETS]]):
        fits = matches_any(name, patterns) & ~name.startswith(".")
        if i:
            fits = fits & ~name.startswith(ALERT_DATASET_PREFIX)
        if not docs.where(fits).isEmpty():
            return fits
    return F.lit(False)


def source_inventory(docs: DataFrame, patterns: Iterable[str] = SOURCE_DATASETS) -> DataFrame:
    """Row count per non-empty source dataset (no alert or hidden tables)."""
    name = F.col("dataset")
    shown = ~name.startswith(".") & ~name.startswith(ALERT_DATASET_PREFIX) & matches_any(name, patterns)
    return docs.where(shown).groupBy("dataset").agg(F.count(F.lit(1)).alias("docs"))


def conform_labelled(df: DataFrame) -> DataFrame:
    """A labelled foreign login table in the canonical event schema."""
    def text(*names: str) -> Column:
        found = [F.coalesce(F.col(n).cast("string"), F.lit("nan")) for n in names if has(df, n)]
        return found[0] if found else F.lit("")

    event_type = F.lower(text("event_type"))
    status = F.when(event_type.contains("accepted") & ~event_type.contains("failed"),
                    "accepted").otherwise("failed")
    label = next((n for n in ("label", "is_attack") if has(df, n)), None)
    attack = (F.coalesce(F.lower(F.col(label).cast("string")).contains("brute"), F.lit(False))
              if label else status == "failed")
    shaped = df.select(
        V.tolerant_timestamp(F.col("timestamp").cast("string")).alias("timestamp"),
        text("source_ip").alias("source_ip"),
        text("username", "user").alias("user"),
        status.alias("status"), attack.alias("is_attack"),
        *[c for c in ("event_id",) if has(df, c)])
    message = F.format_string("sshd: %s password for %s from %s port 22 ssh2", "status", "user", "source_ip")
    return shaped.select(
        *[c for c in ("event_id",) if has(df, c)],
        "timestamp", "source_ip", "user", "status", message.alias("message"),
        F.when(F.col("is_attack"), "brute_force").otherwise("").alias("attack_type"), "is_attack",
        F.lit("").alias("geoip_country"), F.lit("").alias("geoip_city"), F.lit("ssh").alias("log_type"))


ALERT_FEED_COLUMNS = ("timestamp", "source_ip", "is_attack", "attack_type", "ml_model",
                      "ml_anomaly", "ml_anomaly_score", "defense_recommendations")


def latest_alerts(alerts: DataFrame, limit: int = 10, since: Column | None = None,
                  model: str | None = None, tie: str | None = None) -> DataFrame:
    """Newest alerts, optionally of one model and not before ``since``."""
    picked = alerts
    if since is not None:
        picked = picked.where(F.col("timestamp") >= since)
    if model:
        picked = picked.where(F.col("ml_model") == model)
    order = [F.col("timestamp").desc_nulls_last()] + ([F.col(tie)] if tie else [])
    return picked.orderBy(*order).limit(limit).select(
        *([tie] if tie else []), *[c for c in ALERT_FEED_COLUMNS if has(alerts, c)])


def latest_alerts_fallback(predictions: DataFrame, limit: int = 10, model: str | None = None,
                           tie: str | None = None) -> DataFrame:
    """The same feed from a prediction set whose cells are plain text."""
    def filled(name: str, default: str) -> Column:
        value = F.nullif(F.col(name), F.lit("")) if has(predictions, name) else F.lit(None)
        return F.coalesce(value, F.lit(default))

    parsed = predictions.withColumn("_ts", V.naive_timestamp(F.col("timestamp"))).where("_ts is not null")
    shaped = parsed.select(
        *([tie] if tie else []),
        F.date_format("_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        filled("source_ip", "—").alias("source_ip"),
        "is_attack", filled("attack_type", "unknown").alias("attack_type"),
        (F.lit(model) if model else filled("ml_model", "—")).alias("ml_model"),
        "ml_anomaly", "ml_anomaly_score",
        filled("defense_recommendations", "—").alias("defense_recommendations"))
    order = [F.col("timestamp").desc()] + ([F.col(tie)] if tie else [])
    return shaped.orderBy(*order).limit(limit)
