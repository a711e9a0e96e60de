"""Continuous collection, windowed detection, scoring and notification.

The per-line work is the same column expressions the batch jobs use. State is
kept only where the question needs it: windows, sessions, repeated alerts and
the notification throttle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from wardlog.functions import parsing as P
from wardlog.learning.detector import Detector
from wardlog.operators import records as rec
from wardlog.operators import windows as win
from wardlog.operators.features import preprocess
from wardlog.schema import ALERT
from wardlog.session import materialize, scratch_scope
from wardlog.sources import writers as wr

# Tolerated clock skew and the quiet time between notifications.
DEFAULT_DELAY = "12 hours"
QUIET_SECONDS = 45.0
# A key that was silent for so long starts afresh.
FORGET_SECONDS = 24 * 3600.0
# So long an alert is remembered: the same one coming again is not written.
ALERT_TIME_TO_LIVE = "7 days"

# Notices of a key waiting to be merged, at least.
MERGE_ROWS = 20_000

NOTICE = "key string, timestamp timestamp, detail string"


def enrich_lines(lines: DataFrame, base_year: int) -> DataFrame:
    """Tagged lines (``message, fields``) as parsed, rule-checked events.

    Stateless, so a stream and a batch give the same rows.
    """
    message, tag = F.col("message"), F.col("fields.log_type")
    part = lambda pattern, group: P.first_group(message, pattern, group)
    web = F.coalesce(tag == "web", F.lit(False))
    parsed = lines.select(
        message.alias("message"), tag.alias("log_type"),
        F.when(web, P.access_timestamp(part(P.ACCESS_LINE, 2)))
        .otherwise(P.line_timestamp(message, base_year)).alias("timestamp"),
        F.when(web, F.coalesce(part(P.ACCESS_LINE, 1), F.lit(""))).otherwise(P.ssh_source_ip(message)).alias("source_ip"),
        F.when(web, "").otherwise(P.ssh_user(message)).alias("user"),
        F.when(web, "").otherwise(P.ssh_status(message)).alias("status"),
        F.when(web, part(P.ACCESS_LINE, 4)).alias("request"),
        F.when(web, part(P.ACCESS_LINE, 6)).try_cast("int").alias("response"))
    ruled = rec.apply_rules(parsed, F.col("log_type"))
    parsed_attack = P.ssh_is_attack(F.col("status"))  # web rows carry a blank status
    return (ruled.withColumn("attack_type", F.coalesce(F.col("attack_type"), F.when(parsed_attack, "brute_force"), F.lit("")))
            .withColumn("is_attack", F.col("is_attack") | parsed_attack))


def start_routing(events: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append events to the dated log table as they come."""
    writer = (wr.route(events).writeStream.format("parquet").partitionBy("index_prefix", "event_date")
              .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def failed_windows(events: DataFrame, minutes: int = 5, slide: int | None = None, delay: str = DEFAULT_DELAY) -> DataFrame:
    """Failed logins per address and window; late rows count up to ``delay``."""
    return win.failed_by_window(events.withWatermark("timestamp", delay), minutes, slide)


def failed_sessions(events: DataFrame, gap_minutes: int = 5, delay: str = DEFAULT_DELAY) -> DataFrame:
    return win.failed_session_stream(events.withWatermark("timestamp", delay), gap_minutes)


def distinct_alerts(alerts: DataFrame, arrived: str = "scored_at", time_to_live: str = ALERT_TIME_TO_LIVE) -> DataFrame:
    """Drop alerts whose ``alert_id`` arrived before, as keyed state with a time to live.

    ``arrived`` is the time an alert came in, never null. An id is kept for ``time_to_live`` after its first alert at least, and
    forgotten once alerts have come from twice that time later. So the state holds the ids of that time, and no
    batch looks at what was written earlier.
    """
    return alerts.withWatermark(arrived, time_to_live).dropDuplicatesWithinWatermark(["alert_id"])


def score_batch(batch: DataFrame, detector: Detector, model: str, window_minutes: int = 5) -> DataFrame:
    """One micro-batch through features, model and alert shaping, each alert once."""
    rows = preprocess(batch, "ssh", window_minutes)
    return wr.first_alerts(wr.alert_rows(detector.predict(rows), model))


def start_scoring(events: DataFrame, detector: Detector, path: str, checkpoint: str, model: str = "unified",
                  run_id: str = "stream", available_now: bool = False) -> StreamingQuery:
    """Score each micro-batch and write its alerts, each once within the batch, with the moment they were ``scored_at``.

    A batch owns the partitions ``run_id, batch_id``; when it is retried it
    replaces them, so no alert is written twice. The batch is stored once for the passes of
    the features, and its intermediate tables go when its alerts are written. Nothing of earlier batches is read:
    ``start_alert_log`` drops what they had already.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            alerts = score_batch(materialize(batch, "batch"), detector, model)
            (alerts.withColumn("scored_at", F.current_timestamp()).withColumn("run_id", F.lit(run_id)).withColumn("batch_id", F.lit(batch_id))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("run_id", "batch_id").parquet(path))

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def scored_alerts(spark: SparkSession, scored: str) -> DataFrame:
    """The alerts of ``start_scoring`` as a stream.

    A retried batch replaces its files. Replaced files are passed over if they are gone, and the ids of those that
    were read already are known when the new ones come.
    """
    schema = StructType([*ALERT.fields, *StructType.fromDDL("alert_id string, scored_at timestamp, run_id string, batch_id bigint").fields])
    return spark.readStream.schema(schema).option("ignoreMissingFiles", "true").parquet(scored)


def start_alert_log(spark: SparkSession, scored: str, path: str, checkpoint: str, time_to_live: str = ALERT_TIME_TO_LIVE,
                    available_now: bool = False) -> StreamingQuery:
    """Follow the scored alerts and append each ``alert_id`` to the alert log once, whichever batch it comes in."""
    writer = (distinct_alerts(scored_alerts(spark, scored), time_to_live=time_to_live).writeStream.format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def admitted(moments: np.ndarray, quiet: float, last: float | None) -> tuple[np.ndarray, float | None]:
    """Places of the moments (in order) shown when each waits ``quiet`` after the one before."""
    shown = []
    at = 0 if last is None else int(np.searchsorted(moments, last + quiet))
    while at < len(moments):
        shown.append(at)
        last = float(moments[at])
        at = int(np.searchsorted(moments, last + quiet))
    return np.array(shown, dtype=int), last


def seconds_of(timestamps: pd.Series) -> np.ndarray:
    return timestamps.to_numpy().astype("datetime64[us]").astype(np.int64) / 1e6


def least_texts(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    """One row per key ``by``, in order: of notices of the same moment only the least text can be shown."""
    return rows.sort_values([*by, "detail"], kind="stable").drop_duplicates(by)


def collapse_moments(batches: Iterable[pd.DataFrame]) -> pd.DataFrame | None:
    """The distinct moments of a key's notices in time order, each with its least text; None without notices.

    Notices are merged once as many wait as there are moments, so memory follows the moments and not the notices,
    and each notice is sorted a few times only.
    """
    kept, waiting, n = None, [], 0
    for batch in batches:
        waiting.append(batch)
        n += len(batch)
        if n >= max(MERGE_ROWS, 0 if kept is None else len(kept)):
            kept, waiting, n = least_texts(pd.concat([*([] if kept is None else [kept]), *waiting]), ["timestamp"]), [], 0
    if waiting:
        kept = least_texts(pd.concat([*([] if kept is None else [kept]), *waiting]), ["timestamp"])
    return kept


def combine_notices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Map-side step of ``throttle``: equal moments of a key collapse within an Arrow batch; those without a time stay."""
    for batch in batches:
        timed = batch["timestamp"].notna()
        yield pd.concat([least_texts(batch[timed], ["key", "timestamp"]), batch[~timed]])


def throttle(notices: DataFrame, key: Column, detail: Column, quiet_seconds: float = QUIET_SECONDS,
             forget_seconds: float = FORGET_SECONDS, delay: str = DEFAULT_DELAY) -> DataFrame:
    """Notices of a key at least ``quiet_seconds`` after the last one shown.

    The notices of a micro-batch are taken in time order (ties by text); one that comes too
    soon, or is older than the last one shown, is dropped. Notices without a time cannot be spaced and are
    always shown. The state is one number per key and is forgotten once the watermark is
    ``forget_seconds`` past it, by an event-time timer; rows later than ``delay`` still count.

    Equal moments collapse before the shuffle and again as they arrive, and notices too soon after the last one
    shown are dropped unread. So a key holds its distinct moments of one micro-batch, however many
    notices it has: log times are whole seconds, 86,400 a day.
    """
    wait = int(1000 * max(quiet_seconds, forget_seconds))

    def admit(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterable[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        untimed: list[pd.DataFrame] = []

        def due() -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = batch[["timestamp", "detail"]]
                timed = rows["timestamp"].notna()
                if not timed.all():
                    untimed.append(rows[~timed])
                rows = rows[timed]
                yield rows if last is None else rows[seconds_of(rows["timestamp"]) >= last + quiet_seconds]

        moments = collapse_moments(due())
        shown = list(untimed)
        if moments is not None:
            places, last = admitted(seconds_of(moments["timestamp"]), quiet_seconds, last)
            shown.append(moments.iloc[places])
        if last is not None:
            state.update((last,))
            state.setTimeoutTimestamp(max(int(1000 * last) + wait, state.getCurrentWatermarkMs() + 1))
        for rows in shown:
            yield rows.assign(key=group[0])[["key", "timestamp", "detail"]]

    shaped = notices.select(key.cast("string").alias("key"), "timestamp", detail.cast("string").alias("detail"))
    combined = shaped.mapInPandas(combine_notices, NOTICE).withWatermark("timestamp", delay)
    return combined.groupBy("key").applyInPandasWithState(
        admit, NOTICE, "last double", "append", GroupStateTimeout.EventTimeTimeout)


def tail(spark: SparkSession, inputs: dict[str, list[str]], base_year: int) -> DataFrame:
    """Follow log paths by log type and enrich their lines."""
    from wardlog.sources.readers import read_tagged

    return enrich_lines(read_tagged(spark, inputs, stream=True), base_year)
