"""Dashboard aggregates: totals, recent activity and the hourly view.

Inputs are an event table (``timestamp, source_ip, is_attack``) and a prediction
table that adds ``attack_type, ml_anomaly, ml_anomaly_score, ml_model``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlog.functions.values import any_flag, display_timestamp, naive_timestamp
from wardlog.operators.keyed import scalar
from wardlog.schema import has

# Models by priority with their display names, and severity bounds.
MODEL_PRIORITY = ("unified", "kaggle", "russellmitchell", "custom")
MODEL_DISPLAY = {"unified": "Unified", "kaggle": "Kaggle", "russellmitchell": "Russell", "custom": "Custom"}
FLAG_COLUMNS = ("is_attack", "ml_anomaly", "prediction", "is_attack_pred")
TIME_COLUMNS = ("timestamp", "Timestamp", "@timestamp")
HIGH_RATE, MEDIUM_RATE = 80.0, 40.0
HIGH_SCORE, MEDIUM_SCORE = 0.7, 0.4
SUMMARY_HOURS = 12
HOURS_SHOWN = 24

HOUR = "INTERVAL 1 HOUR"


def flagged(df: DataFrame) -> Column:
    """True when any of the four flag columns present reads as an attack."""
    return any_flag(*[F.col(c) for c in FLAG_COLUMNS if has(df, c)])


def nonblank(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def activity_anchor(events: DataFrame, predictions: DataFrame | None = None,
                    now: Column | None = None) -> DataFrame:
    """``anchor``: newest event time, else newest prediction time, else ``now``."""
    options = [scalar(events, F.max("timestamp"))]
    if predictions is not None:
        options.append(scalar(predictions, F.max("timestamp")))
    options.append(now if now is not None else F.current_timestamp())
    return events.sparkSession.range(1).select(F.coalesce(*options).alias("anchor"))


def _anchor(events: DataFrame, anchor: Column | None) -> Column:
    return anchor if anchor is not None else scalar(events, F.max("timestamp"))


def activity_totals(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("logs_count"),
                      F.count_if(any_flag(F.col("is_attack"))).alias("attacks_count"))


def recent_activity(events: DataFrame, anchor: Column | None = None) -> DataFrame:
    """Attacks since the anchor's midnight and in its last five minutes."""
    at = _anchor(events, anchor)
    attack, ts = any_flag(F.col("is_attack")), F.col("timestamp")
    today, lately = F.date_trunc("day", at), at - F.expr("INTERVAL 5 MINUTES")
    return events.where(ts >= F.least(today, lately)).agg(  # older rows are skipped at the scan
        F.count_if(attack & (ts >= today)).alias("attack_today"),
        F.count_if(attack & (ts >= lately)).alias("attack_5min"))


def top_attackers(events: DataFrame, k: int = 1) -> DataFrame:
    """Most frequent attacking addresses; ties go to the smaller address."""
    return (events.where(any_flag(F.col("is_attack"))).select(nonblank("source_ip").alias("source_ip"))
            .where("source_ip is not null").groupBy("source_ip").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), "source_ip").limit(k))


def top_attacker(events: DataFrame, anchor: Column | None = None) -> DataFrame:
    """Top address overall and of the last five minutes (they may differ)."""
    recent = F.col("timestamp") >= _anchor(events, anchor) - F.expr("INTERVAL 5 MINUTES")
    counts = (events.where(any_flag(F.col("is_attack")))
              .select(nonblank("source_ip").alias("ip"), recent.alias("recent")).where("ip is not null")
              .groupBy("ip").agg(F.count(F.lit(1)).alias("n"), F.count_if("recent").alias("n5")))
    best = counts.agg(F.min(F.struct(-F.col("n"), F.col("ip").alias("ip"))).alias("a"),
                      F.min(F.when(F.col("n5") > 0, F.struct((-F.col("n5")).alias("n"), F.col("ip").alias("ip")))).alias("r"))
    return best.select(F.col("a.ip").alias("top_ip"), F.col("r.ip").alias("top_ip_5m"),
                       F.coalesce(-F.col("r.n"), F.lit(0).cast("bigint")).alias("top_ip_count_5m"))


def hour_buckets(events: DataFrame, anchor: Column) -> DataFrame:
    """The 24 hours ending at the anchor's hour."""
    last = F.date_trunc("hour", anchor)
    first = last - F.expr("INTERVAL 23 HOURS")
    one = events.sparkSession.range(1)
    return one.select(F.explode(F.sequence(first, last, F.expr(HOUR))).alias("hour_start")).withColumn(
        "hour_label", F.date_format("hour_start", "HH"))


def timed(df: DataFrame, zone: str | None = None) -> DataFrame:
    """Rows with ``_at``: the first of the time columns that holds a readable time, in ``TIME_COLUMNS``' order.

    Text is read by the four plain layouts. With ``zone`` the result is that zone's wall clock: times of a time type and
    zoned text move there, plain text stays as it is. A single column of a time type stays bare, so that
    filters on it reach the scan.
    """
    places = [i for name in TIME_COLUMNS for i, c in enumerate(df.columns) if c == name]
    if not places:
        raise ValueError(f"no time column among {df.columns}")
    types = [t for _, t in df.dtypes]
    # By place: two of the names differ in case only.
    named = df.toDF(*[f"_time{i}" if i in places else c for i, c in enumerate(df.columns)])

    def read(i: int) -> Column:
        column = F.col(f"_time{i}")
        if types[i] == "string":
            return display_timestamp(column, zone) if zone else naive_timestamp(column)
        return F.from_utc_timestamp(column, zone) if zone else column.cast("timestamp")
    values = [read(i) for i in places]
    return named.withColumn("_at", F.coalesce(*values) if len(values) > 1 else values[0])


def hourly_timeline(events: DataFrame, predictions: list[DataFrame] | None = None,
                    anchor: Column | None = None, zone: str | None = None) -> DataFrame:
    """Attacks per hour over events and prediction sets; empty hours count 0.

    Each row counts at the first of its time columns that can be read (see ``timed``), rows without one nowhere.
    ``zone`` shows the hours of that zone; ``anchor`` is then its wall clock, too.
    """
    rows = timed(events, zone)
    at = anchor if anchor is not None else scalar(rows, F.max("_at"))
    marks = rows.where(any_flag(F.col("is_attack"))).select("_at")
    for frame in predictions or []:
        marks = marks.unionByName(timed(frame, zone).where(flagged(frame)).select("_at"))
    counts = marks.where(F.col("_at").between(at - F.expr("INTERVAL 24 HOURS"), at)).groupBy(
        F.date_trunc("hour", "_at").alias("hour_start")).agg(F.count(F.lit(1)).alias("n"))
    return hour_buckets(events, at).join(counts, "hour_start", "left").select(
        "hour_start", "hour_label", F.coalesce("n", F.lit(0).cast("bigint")).alias("attacks"))


def tag_model(predictions: dict[str, DataFrame]) -> DataFrame:
    """Union of prediction sets, each tagged with its model."""
    result = None
    for model, frame in predictions.items():
        tagged = frame.withColumn("ml_model", F.lit(model))
        result = tagged if result is None else result.unionByName(tagged, allowMissingColumns=True)
    if result is None:
        raise ValueError("no prediction sets")
    return result


def hourly_attack_table(predictions: DataFrame, anchor: Column | None = None,
                        events: DataFrame | None = None, zone: str | None = None) -> DataFrame:
    """Per hour: alerts, attacks, top address, top type, mean score, top model.

    ``zone`` shows the hours of that zone; ``anchor`` is then its wall clock, too.

    One pass: each row contributes to its hour and to its address, type and
    model of that hour; partial aggregation shrinks all four before the shuffle.
    """
    clock = lambda ts: F.from_utc_timestamp(ts, zone) if zone else ts
    at = anchor if anchor is not None else clock(_anchor(events if events is not None else predictions, None))
    last = F.date_trunc("hour", at)
    wall = clock(F.col("timestamp"))
    hour = F.date_trunc("hour", wall)
    attack = any_flag(F.col("is_attack"))
    kind = F.coalesce(nonblank("attack_type"), F.lit("unknown"))
    # The priority number breaks ties; a model outside the list does not compete.
    rank = F.nullif(F.array_position(F.array(*[F.lit(m) for m in MODEL_PRIORITY]), F.col("ml_model")), F.lit(0))
    score = F.when(attack, F.col("ml_anomaly_score").try_cast("double"))
    def part(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("kind"), value.cast("string").alias("value"))
    parts = F.concat(
        F.array(part("all", F.lit(""))),
        F.when(attack, F.array(part("ip", nonblank("source_ip")), part("type", kind), part("model", rank)))
        .otherwise(F.array().cast("array<struct<kind:string,value:string>>")))
    first, end = last - F.expr("INTERVAL 23 HOURS"), last + F.expr(HOUR)
    near = predictions
    if zone:  # bounds on the bare column reach the scan; clocks go back by less than three hours
        ts, slack = F.col("timestamp"), F.expr("INTERVAL 3 HOURS")
        near = near.where((ts >= F.to_utc_timestamp(first, zone) - slack) & (ts < F.to_utc_timestamp(end, zone) + slack))
    rows = (near.where((wall >= first) & (wall < end))
            .select(hour.alias("hour_start"), attack.alias("attack"), score.alias("score"), F.explode(parts).alias("p")))
    counted = rows.groupBy("hour_start", "p.kind", "p.value").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("attack").alias("attacks"),
        F.sum("score").alias("score_sum"), F.count("score").alias("score_n"))
    def top(name: str) -> Column:
        pick = F.struct(-F.col("n"), F.col("value").alias("value"))
        return F.min(F.when((F.col("kind") == name) & F.col("value").isNotNull(), pick)).getField("value")
    whole = F.col("kind") == "all"
    per_hour = counted.groupBy("hour_start").agg(
        F.sum(F.when(whole, F.col("n"))).alias("total_alerts"), F.sum(F.when(whole, F.col("attacks"))).alias("attacks"),
        top("ip").alias("top_ip"), top("type").alias("top_attack_type"),
        F.try_divide(F.sum(F.when(whole, F.col("score_sum"))), F.sum(F.when(whole, F.col("score_n")))).alias("avg_score"),
        top("model").alias("_model"))
    names = F.array(*[F.lit(MODEL_DISPLAY[m]) for m in MODEL_PRIORITY])
    zero = F.lit(0).cast("bigint")
    return hour_buckets(predictions, at).join(per_hour, "hour_start", "left").select(
        "hour_start", "hour_label", F.coalesce("total_alerts", zero).alias("total_alerts"),
        F.coalesce("attacks", zero).alias("attacks"), "top_ip", "top_attack_type", "avg_score",
        F.try_element_at(names, F.col("_model").cast("int")).alias("top_model"))


def hourly_severity(table: DataFrame) -> DataFrame:
    """Hours with attacks, their attack rate and a severity grade."""
    begin = F.hour("hour_start")
    label = F.format_string("%02d:00-%02d:00", begin, (begin + 1) % 24)
    rate = F.coalesce(F.try_divide(F.col("attacks") * 100.0, F.col("total_alerts")), F.lit(0.0))
    score = F.coalesce("avg_score", F.lit(float("-inf")))
    severity = (F.when((rate >= HIGH_RATE) | (score >= HIGH_SCORE), "High")
                .when((rate >= MEDIUM_RATE) | (score >= MEDIUM_SCORE), "Medium").otherwise("Low"))
    return table.where("attacks > 0").select(
        "hour_start", label.alias("hour_range"), "attacks", rate.alias("attack_rate"), "top_ip",
        "top_attack_type", "avg_score", "top_model", severity.alias("severity"))


def hourly_summary_text(timeline: DataFrame) -> DataFrame:
    """``HH: n`` for the first twelve busy hours and the number of further ones."""
    busy = timeline.where("attacks > 0").agg(
        F.array_sort(F.collect_list(F.struct("hour_start", "hour_label", "attacks"))).alias("h"))
    shown = F.transform(F.slice("h", 1, SUMMARY_HOURS),
                        lambda x: F.concat(x["hour_label"], F.lit(": "), x["attacks"].cast("string")))
    more = F.greatest(F.size("h") - SUMMARY_HOURS, F.lit(0))
    return busy.select(F.array_join(shown, ", ").alias("summary"), more.alias("further_hours"))


def ingest_and_alert_rate(events: DataFrame, anchor: Column | None = None) -> DataFrame:
    """Logs per minute and flagged rows in the anchor's last hour."""
    recent = events.where(F.col("timestamp") >= _anchor(events, anchor) - F.expr(HOUR))
    return recent.agg(F.round(F.count(F.lit(1)) / 60, 1).alias("ingestion_rate"),
                      F.count_if(flagged(events)).alias("alert_rate"))


def alert_breakdown(alerts: DataFrame, unit: str = "hour") -> DataFrame:
    """Alert counts over time by model and address."""
    return alerts.groupBy(F.date_trunc(unit, "timestamp").alias("bucket"), "ml_model", "source_ip").agg(
        F.count(F.lit(1)).alias("alerts"))
