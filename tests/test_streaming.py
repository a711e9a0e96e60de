import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wardlog.learning.detector import Detector
from wardlog.operators import records as rec
from wardlog.operators import windows as win
from wardlog.schema import ALERT
from wardlog.sources import readers as rd
from wardlog.streaming import jobs

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, timestamp timestamp, source_ip string, user string, status string, message string, is_attack boolean"


def feed(spark, tmp_path, name, *batches):
    """Write batches as separate files and stream them one file at a time."""
    path = str(tmp_path / name)
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def drain(spark, stream, tmp_path, name):
    out = str(tmp_path / name)
    query = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-cp")
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def test_stream_lines_equal_batch_lines(spark, tmp_path):
    logs = {"ssh": tmp_path / "ssh", "web": tmp_path / "web", "system": tmp_path / "system"}
    for folder in logs.values():
        folder.mkdir()
    (logs["ssh"] / "a.log").write_text("Jan  3 10:00:00 h sshd[1]: Failed password for x from 1.2.3.4 port 22 ssh2\n"
                                       "Jan 13 10:00:00 h sshd[1]: Accepted password for y from 1.2.3.5 port 22 ssh2\n")
    (logs["web"] / "a.log").write_text('9.9.9.9 - - [01/Jan/2024:00:00:00 +0700] "GET /?a=1%20union select HTTP/1.1" 200 5\n'
                                       '9.9.9.9 - - [01/Jan/2024:00:00:00 +0700] "GET /<script> HTTP/1.1" 200 5\n')
    (logs["system"] / "a.log").write_text("# comment\nJan 3 10:00:00 h kernel: hot\n")
    inputs = {k: [str(v)] for k, v in logs.items()}
    batch = jobs.enrich_lines(rd.read_tagged(spark, inputs), 2024)
    stream = drain(spark, jobs.tail(spark, inputs, 2024), tmp_path, "out")
    assert stream.exceptAll(batch).isEmpty() and batch.exceptAll(stream).isEmpty()
    got = {(r.log_type, r.status, r.attack_type, r.is_attack) for r in batch.collect()}
    assert got == {("ssh", "failed", "brute_force", True), ("ssh", "accepted", "", False), ("web", "", "xss", True),
                   ("web", "", "", False), ("system", "", "", False)}


def test_routing_by_event_date(spark, rows, tmp_path):
    df = rows([(T0, "sshd", "ssh"), (T0 + dt.timedelta(days=1), "x", "web")], "timestamp timestamp, message string, log_type string")
    out = str(tmp_path / "routed")
    jobs.start_routing(feed(spark, tmp_path, "in", df), out, str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert {(r.index_prefix, str(r.event_date)) for r in spark.read.parquet(out).collect()} == {
        ("ssh-logs", "2024-01-01"), ("web-logs", "2024-01-02")}


def test_windows_accept_late_rows_within_the_delay(spark, rows, tmp_path):
    def failures(*minutes):
        return rows([(m, T0 + dt.timedelta(minutes=m), "a", "u", "failed", "", True) for m in minutes], SCHEMA)
    # Minute 2 comes late but inside the delay; minute 1 comes after the window closed.
    stream = feed(spark, tmp_path, "in", failures(0, 3), failures(30), failures(2), failures(120), failures(121), failures(1), failures(122))
    out = drain(spark, jobs.failed_windows(stream, 5, delay="1 hour"), tmp_path, "out")
    got = {r.window_start.replace(tzinfo=None): r.failed for r in out.collect()}
    assert got == {T0: 3, T0 + dt.timedelta(minutes=30): 1}


def test_sessions_equal_batch_for_closed_bursts(spark, rows, tmp_path):
    minutes = [0, 2, 4, 20, 21, 600]
    df = rows([(m, T0 + dt.timedelta(minutes=m), "a", "u", "failed", "", True) for m in minutes], SCHEMA)
    out = drain(spark, jobs.failed_sessions(feed(spark, tmp_path, "in", df), 5, "1 hour"), tmp_path, "out")
    closed = win.failed_sessions(df.where("event_id < 600"), 5)
    assert out.exceptAll(closed).isEmpty() and closed.exceptAll(out).isEmpty()


def scored(spark, tmp_path, batch_id, ids, at):
    """A batch of scored alerts, as the scoring job stores them."""
    alert = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in ALERT.fields])
    named = spark.createDataFrame([(i, at) for i in ids], "alert_id string, scored_at timestamp")
    folder = f"{tmp_path}/scored/run_id=r/batch_id={batch_id}"
    alert.crossJoin(named).coalesce(1).write.mode("overwrite").parquet(folder)


def follow(spark, tmp_path, **more):
    query = jobs.start_alert_log(spark, f"{tmp_path}/scored", f"{tmp_path}/log", f"{tmp_path}/cp", available_now=True, **more)
    query.awaitTermination()
    return query


def test_alert_log_remembers_across_batches_and_restarts(spark, tmp_path):
    scored(spark, tmp_path, 0, ["x", "y", "x"], T0)
    follow(spark, tmp_path)
    scored(spark, tmp_path, 1, ["y", "z"], T0 + dt.timedelta(days=1))
    scored(spark, tmp_path, 0, ["x", "y"], T0)  # the batch again, in new files
    query = follow(spark, tmp_path)  # a new start from the checkpoint
    log = spark.read.parquet(f"{tmp_path}/log")
    assert sorted(r.alert_id for r in log.collect()) == ["x", "y", "z"]
    # Only the new files are read: the work of a batch does not grow with the log.
    assert sum(p.numInputRows for p in query.recentProgress) == 4


def test_alert_log_forgets_after_its_time_to_live(spark, tmp_path):
    for day, ids in enumerate([["x"], ["x", "y"], ["z"], ["z"], ["z"], ["x", "z"]]):
        scored(spark, tmp_path, day, ids, T0 + dt.timedelta(days=day))
        query = follow(spark, tmp_path, time_to_live="36 hours")
    times = sorted((r.alert_id, r.scored_at.day) for r in spark.read.parquet(f"{tmp_path}/log").collect())
    assert times == [("x", 1), ("x", 6), ("y", 2), ("z", 3)]
    assert query.lastProgress.stateOperators[0].numRowsTotal <= 3


def test_throttle_per_key(spark, rows, tmp_path):
    def notices(*seconds):
        return rows([(k, T0 + dt.timedelta(seconds=s), str(s)) for s in seconds for k in "ab"], "k string, timestamp timestamp, m string")
    stream = feed(spark, tmp_path, "in", notices(0, 10, 44, 45, 60), notices(89, 90, 200))
    out = drain(spark, jobs.throttle(stream, F.col("k"), F.col("m")), tmp_path, "out")
    for key in "ab":
        assert sorted(int(r.detail) for r in out.where(F.col("key") == key).collect()) == [0, 45, 90, 200]


def test_throttle_takes_a_batch_in_time_order_and_passes_missing_times(spark, rows, tmp_path):
    late = [("a", T0 + dt.timedelta(seconds=s), str(s)) for s in (100, 0, 50, 30)] + [("a", None, "none")]
    stream = feed(spark, tmp_path, "in", rows(late, "k string, timestamp timestamp, m string"))
    out = drain(spark, jobs.throttle(stream, F.col("k"), F.col("m")), tmp_path, "out")
    assert sorted(r.detail for r in out.collect()) == ["0", "100", "50", "none"]


def test_notices_of_a_busy_address_collapse_to_their_moments(monkeypatch):
    monkeypatch.setattr(jobs, "MERGE_ROWS", 50)
    sizes = []
    merge = jobs.least_texts
    monkeypatch.setattr(jobs, "least_texts", lambda rows, by: (sizes.append(len(rows)), merge(rows, by))[1])
    rng = np.random.default_rng(4)
    stamps, texts = rng.integers(0, 300, 20_000), rng.integers(0, 1000, 20_000)
    rows = pd.DataFrame({"timestamp": pd.Timestamp(T0) + pd.to_timedelta(stamps, unit="s"), "detail": [f"{t:03}" for t in texts]})
    got = jobs.collapse_moments(rows.iloc[i:i + 40] for i in range(0, len(rows), 40))
    want = rows.groupby("timestamp")["detail"].min()
    assert list(got["timestamp"]) == list(want.index) and list(got["detail"]) == list(want)
    assert max(sizes) <= 2 * 300 + 40 and len(sizes) < 100  # never the notices, and not each batch anew
    assert jobs.collapse_moments([]) is None


def test_throttle_of_many_notices_in_one_batch(spark, tmp_path):
    notices = spark.range(200_000).select(
        F.lit("a").alias("k"), F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id"), F.lit(5000))).alias("timestamp"),
        F.format_string("%04d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000))).alias("m"))
    out = drain(spark, jobs.throttle(feed(spark, tmp_path, "in", notices), F.col("k"), F.col("m")), tmp_path, "out")
    least = {int(r.t): r.m for r in notices.groupBy(F.unix_seconds("timestamp").alias("t")).agg(F.min("m").alias("m")).collect()}
    want, last = [], None
    for t in sorted(least):
        if last is None or t >= last + 45:
            want.append((t, least[t]))
            last = t
    assert sorted((int(r.t), r.detail) for r in out.select(F.unix_seconds("timestamp").alias("t"), "detail").collect()) == want


def test_throttle_keeps_null_keys_and_texts(spark, rows, tmp_path):
    data = [(None, T0, "x"), (None, T0, None), ("a", T0, None), ("a", None, None), ("a", None, "u")]
    stream = feed(spark, tmp_path, "in", rows(data, "k string, timestamp timestamp, m string"))
    out = drain(spark, jobs.throttle(stream, F.col("k"), F.col("m")), tmp_path, "out")
    assert sorted((str(r.key), r.timestamp is None, str(r.detail)) for r in out.collect()) == [
        ("None", False, "x"), ("a", False, "None"), ("a", True, "None"), ("a", True, "u")]


def test_lines_find_their_time(spark, rows):
    lines = [("2024-03-05T10:11:12Z system started", "2024-03-05 10:11:12"), ("2024-03-05 10:11:12,345 [error] x", "2024-03-05 10:11:12.345000"),
             ("1.2.3.4 - - [05/Mar/2024:17:11:12 +0700] failed", "2024-03-05 10:11:12"), ("Mar  5 10:11:12 h sshd[1]: x", "2024-03-05 10:11:12"), ("no time", "None")]
    df = rows([(m,) for m, _ in lines], "message string").select("message", F.struct(F.lit("system").alias("log_type")).alias("fields"))
    got = {r.message: str(r.timestamp) for r in jobs.enrich_lines(df, 2024).select("message", F.col("timestamp").cast("timestamp_ntz").alias("timestamp")).collect()}
    assert got == dict(lines)


def test_scoring_batches_write_once(spark, rows, tmp_path):
    data = [(i, T0 + dt.timedelta(minutes=i), f"10.0.0.{i % 5}", f"u{i % 3}", "failed" if i % 4 == 0 else "accepted", "m", i % 4 == 0)
            for i in range(80)]
    events = rows(data, SCHEMA)
    detector = Detector("isolation_forest")
    detector.train(events, "event_id", trees=10)
    out = str(tmp_path / "alerts")
    stream = feed(spark, tmp_path, "in", events.where("event_id < 40"), events.where("event_id >= 40"))
    for checkpoint in ("cp1", "cp2"):  # a lost checkpoint replays the same batches
        jobs.start_scoring(stream, detector, out, str(tmp_path / checkpoint), available_now=True).awaitTermination()
    alerts = spark.read.parquet(out)
    assert alerts.count() == 80 and {r.batch_id for r in alerts.select("batch_id").distinct().collect()} == {0, 1}
    assert alerts.select("alert_id").distinct().count() == 80
    jobs.start_alert_log(spark, out, str(tmp_path / "log"), str(tmp_path / "log-cp"), available_now=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "log")).count() == 80


def test_text_events_match_the_stream_parser(spark, rows):
    line = "Jan  3 10:00:00 h sshd[1]: Failed password for x from 1.2.3.4 port 22 ssh2"
    a = rec.text_log_events(rows([(line,)], "value string"), 2024).first()
    b = jobs.enrich_lines(rows([(line,)], "m string").select(
        F.col("m").alias("message"), F.struct(F.lit("ssh").alias("log_type")).alias("fields")), 2024).first()
    assert all(a[c] == b[c] for c in ("timestamp", "source_ip", "user", "status", "is_attack", "attack_type"))
