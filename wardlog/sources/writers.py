"""Sinks: CSV, dated log tables, alert tables and JSON documents."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.functions import values as V
from wardlog.operators.respond import attach_recommendations
from wardlog.schema import ALERT, conform, has

# Log type to dataset prefix; anything else goes to the default.
INDEX_PREFIX = {"ssh": "ssh-logs", "web": "web-logs"}
DEFAULT_PREFIX = "test-logs"
CSV_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, header=True, escape='"', timestampFormat=CSV_TIMESTAMP)


def route(events: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add ``index_prefix`` and ``event_date``, the partitions of the log table.

    A line without a time of its own is stored under the moment it arrives, so it is found again by time.
    """
    tag = F.coalesce(F.col("log_type"), F.lit(""))
    ssh = (tag == "ssh") | F.coalesce(F.col("message").contains("sshd"), F.lit(False))
    prefix = (F.when(tag == "web", INDEX_PREFIX["web"])
              .when(ssh, INDEX_PREFIX["ssh"]).otherwise(DEFAULT_PREFIX))
    arrived = events.withColumn(ts, F.coalesce(F.col(ts), F.current_timestamp().cast(events.schema[ts].dataType)))
    return arrived.select("*", prefix.alias("index_prefix"), F.to_date(ts).alias("event_date"))


def dataset_name(prefix: str = "index_prefix", date: str = "event_date"):
    return F.concat_ws("-", F.col(prefix), F.date_format(date, "yyyy.MM.dd"))


def write_logs(events: DataFrame, path: str, mode: str = "append", ts: str = "timestamp") -> None:
    route(events, ts).write.partitionBy("index_prefix", "event_date").mode(mode).parquet(path)


def first_by(df: DataFrame, keys: list, order: str) -> DataFrame:
    """First row of each key in ``order``; duplicates collapse before the shuffle."""
    first = F.min_by(F.struct(*df.columns), F.col(order))
    return df.groupBy(*[k.alias(f"_g{i}") for i, k in enumerate(keys)]).agg(first.alias("_r")).select("_r.*")


def first_alerts(alerts: DataFrame) -> DataFrame:
    """One alert of each ``alert_id``: the one whose content hash is least."""
    marked = alerts.withColumn("_order", F.xxhash64(*alerts.columns))
    return first_by(marked, [F.col("alert_id")], "_order").drop("_order")


def alert_rows(predictions: DataFrame, model: str | None = None, dedup_order: str | None = None,
               anomalies_only: bool = False) -> DataFrame:
    """Predictions as alert documents with a content-derived ``alert_id``.

    The id is the md5 of timestamp, address and score, so writing the same
    prediction twice yields the same document. With ``dedup_order`` only the
    first document of each id is kept.
    """
    rows = predictions
    if model:
        rows = rows.withColumn("ml_model", F.lit(model))
    for flag in ("ml_anomaly", "is_attack"):
        if has(rows, flag):
            rows = rows.withColumn(flag, V.alert_flag(F.col(flag)))
    if anomalies_only:
        rows = rows.where("ml_anomaly")
    rows = attach_recommendations(rows)
    stamp = F.col("timestamp")
    if dict(rows.dtypes)["timestamp"] == "string":
        stamp = V.tolerant_timestamp(stamp)
    country = F.col("geoip_country").cast("string") if has(rows, "geoip_country") else F.lit("")
    city = F.col("geoip_city").cast("string") if has(rows, "geoip_city") else F.lit("")
    rows = (rows.withColumn("@timestamp", stamp)
            .withColumn("source_ip", V.clean_address(F.col("source_ip")))
            .withColumn("geoip", V.nest_geo(F.coalesce(country, F.lit("")), F.coalesce(city, F.lit("")))))
    identity = F.concat_ws(
        "_", F.coalesce(V.iso_millis(F.col("@timestamp")), F.lit("")),
        F.coalesce("source_ip", F.lit("None")), F.col("ml_anomaly_score").cast("string"))
    keep = (dedup_order,) if dedup_order else ()
    rows = rows.withColumn("alert_id", F.md5(identity))
    rows = conform(rows, ALERT, keep=("alert_id", *keep))
    return first_by(rows, [F.col("alert_id")], dedup_order) if dedup_order else rows


def write_alerts(alerts: DataFrame, path: str, run_id: str) -> None:
    """Write the alerts of a run; a run owns its ``run_id`` partition, and writing it again replaces it, also by nothing."""
    folder = f"{path}/run_id={quote(run_id, safe='')}"  # as partition folders escape their values
    alerts.withColumn("alert_date", F.to_date("@timestamp")).write.mode("overwrite").parquet(folder)


def write_json_document(row: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-row frame (metrics, incident report) as one JSON document."""
    row.coalesce(1).write.mode(mode).json(path)


def write_incident(report: DataFrame, folder: str, stamp: str) -> None:
    """Time-stamped report plus the stable ``latest`` copy."""
    write_json_document(report, f"{folder}/incidents/incident_{stamp}", mode="errorifexists")
    write_json_document(report, f"{folder}/latest")
