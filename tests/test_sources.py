import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardlog.operators import records as rec
from wardlog.schema import CANONICAL_EVENT, LABELLED_CSV, RAW_DOCUMENT, conform
from wardlog.operators import respond as rsp
from wardlog.sources import readers as rd
from wardlog.sources import writers as wr


def test_line_numbers_over_many_splits(spark, tmp_path):
    for name, count in (("a", 5000), ("b", 700)):
        (tmp_path / f"{name}.log").write_text("".join(f"line {i}\n" for i in range(1, count + 1)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = rd.read_numbered_lines(spark, str(tmp_path / "*.log"))
        assert df.select(F.col("value") == F.concat(F.lit("line "), F.col("line_no"))).distinct().collect() == [(True,)]
        assert df.count() == 5700
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_text_scan_drops_blanks_and_comments(spark, tmp_path):
    (tmp_path / "x.log").write_text("  a \n\n# no\n\t\nb\n #c\n")
    assert [r.value for r in rd.read_text_lines(spark, str(tmp_path)).collect()] == ["a", "b"]


def test_csv_round_trip_keeps_quotes_and_broken_cells(spark, rows, tmp_path):
    df = conform(rows([("a \"quoted\", text", "x"), ("plain", None)], "message string, user string"), CANONICAL_EVENT)
    wr.write_csv(df, str(tmp_path / "out"))
    back = rd.read_csv(spark, str(tmp_path / "out"), CANONICAL_EVENT)
    assert sorted(r.message for r in back.collect()) == ["a \"quoted\", text", "plain"]
    (tmp_path / "bad.csv").write_text("timestamp,source_ip,username,event_type,status,label\nx,y\n")
    assert rd.read_csv(spark, str(tmp_path / "bad.csv"), LABELLED_CSV).first().source_ip == "y"


def test_empty_input_is_an_error(spark, tmp_path):
    (tmp_path / "e.csv").write_text(",".join(CANONICAL_EVENT.names) + "\n")
    with pytest.raises(ValueError):
        rd.require_rows(rd.read_csv(spark, str(tmp_path / "e.csv"), CANONICAL_EVENT), "e.csv")


def test_label_lines_skip_malformed(spark, tmp_path):
    (tmp_path / "l").write_text('{"line": 3, "labels": ["attacker"]}\n\n{"line": \n{"line": 4, "labels": []}\n')
    assert sorted(r.line for r in rd.read_label_lines(spark, str(tmp_path / "l")).collect()) == [3, 4]


@pytest.mark.parametrize("requested,names,want", [
    ("web-*, x-?", ["web-1", "x-2", "x-33", "ssh-logs-1"], {"web-1", "x-2"}),
    ("none-*", ["ml-alerts-logs-1", "my-logs-1", "logs-9", ".logs-1"], {"logs-9"}),
    ("none-*", ["ssh-logs-1", "test-logs-1"], {"ssh-logs-1"}),
    ("none-*", ["ml-alerts-logs-1", "other"], set())])
def test_dataset_resolution(rows, requested, names, want):
    df = rows([(n,) for n in names], "dataset string")
    assert {r.dataset for r in rd.resolve_datasets(df, requested).collect()} == want
    assert {r.dataset for r in df.where(rd.choose_datasets(df, requested)).collect()} == want


def test_labelled_table_without_labels(rows):
    df = rows([("2024-01-01 00:00:00", "1.1.1.1", "u", "Accepted password"), ("bad", None, None, "other")],
              "timestamp string, source_ip string, username string, event_type string")
    a, b = rd.conform_labelled(df).collect()
    assert (a.status, a.is_attack, a.attack_type) == ("accepted", False, "")
    assert (b.timestamp, b.source_ip, b.status, b.is_attack) == (None, "nan", "failed", True)
    assert b.message == "sshd: failed password for nan from nan port 22 ssh2"


def test_routed_log_table_is_pruned(spark, rows, tmp_path):
    ts = dt.datetime(2024, 1, 1, 5)
    df = rows([(ts, "sshd: x", "system"), (ts, "x", "web"), (ts, "x", "app"), (ts + dt.timedelta(days=3), "sshd", None)],
              "timestamp timestamp, message string, log_type string")
    wr.write_logs(df, str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t")).withColumn("dataset", wr.dataset_name())
    assert {r.dataset for r in table.collect()} == {
        "ssh-logs-2024.01.01", "web-logs-2024.01.01", "test-logs-2024.01.01", "ssh-logs-2024.01.04"}
    picked = rd.time_range(table.where(rd.choose_datasets(table, "ssh-logs-*")), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    plan = picked._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "event_date" in filters and "index_prefix" in filters
    assert picked.count() == 1


def test_extract_falls_back_to_raw_only_when_nothing_is_typed(rows):
    plain = conform(rows([(1, "kernel: x")], "doc_id long, message string"), RAW_DOCUMENT)
    assert rec.extract(plain).first().log_type == "unknown"
    mixed = conform(rows([(1, "kernel: x"), (2, "sshd: GET http"), (3, "GET /")], "doc_id long, message string"), RAW_DOCUMENT)
    got = sorted((r.doc_id, r.log_type) for r in rec.extract(mixed).collect())
    assert got == [(2, "ssh"), (2, "web"), (3, "web")]


def test_attack_type_precedence_differs_by_record_kind(rows):
    docs = conform(rows([(1, "sshd: Failed password for x from 1.1.1.1", "manual")],
                        "doc_id long, message string, attack_type string"), RAW_DOCUMENT)
    assert rec.ssh_records(docs).first().attack_type == "manual"
    assert rec.raw_records(docs).first().attack_type == "brute_force"


def test_alert_ids_make_rewrites_idempotent(spark, rows, tmp_path):
    ts = dt.datetime(2024, 1, 1, 5)
    df = rows([(1, ts, "1.1.1.1", 1, 0.5, "yes", "xss"), (2, ts, "1.1.1.1", 0, 0.5, "no", ""), (3, ts, "unknown", 0, 0.5, "0", None)],
              "id long, timestamp timestamp, source_ip string, ml_anomaly int, ml_anomaly_score double, is_attack string, attack_type string")
    alerts = wr.alert_rows(df, "m", dedup_order="id")
    got = {r.id: r for r in alerts.collect()}
    assert set(got) == {1, 3} and got[3].source_ip is None and got[1].is_attack and got[1].ml_anomaly
    assert got[3].defense_recommendations == " | ".join(t for t, _ in rsp.actions("unknown", "medium"))
    assert {r.alert_id for r in wr.alert_rows(df, "m", dedup_order="id").collect()} == {r.alert_id for r in got.values()}
    for run in ("r1", "r2", "r1"):  # a run written again replaces itself only
        wr.write_alerts(alerts, str(tmp_path / "a"), run)
    stored = spark.read.parquet(str(tmp_path / "a"))
    assert {(r.run_id, r["count"]) for r in stored.groupBy("run_id").count().collect()} == {("r1", 2), ("r2", 2)}
    wr.write_alerts(alerts.where("false"), str(tmp_path / "a"), "r1")  # a run that finds nothing leaves nothing
    assert [r.run_id for r in spark.read.parquet(str(tmp_path / "a")).select("run_id").distinct().collect()] == ["r2"]


def test_csv_files_are_listed_with_their_size(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.csv").write_text("x" * 1024 * 1024)
    (tmp_path / "deep" / "b.csv").write_text("x")
    (tmp_path / "c.txt").write_text("x")
    out = {r.path.rsplit("/", 1)[-1]: r.size_mb for r in rd.list_csv_files(spark, str(tmp_path)).collect()}
    assert out == {"a.csv": 1.0, "b.csv": 0.0}


def plan_nodes(df):
    """Every node of the plan that ran, with its class name."""
    df.collect()
    stack = [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        yield node.getClass().getSimpleName(), node
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
        elif hasattr(node, "plan") and node.getClass().getSimpleName().endswith("QueryStageExec"):
            stack.append(node.plan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]


def test_lines_are_numbered_without_moving_them(spark, tmp_path):
    for name, n in (("a.log", 5000), ("b.log", 3), ("c.log", 0)):
        (tmp_path / name).write_text("".join(f"{name} line {i}\n" for i in range(1, n + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # several splits for the large file
    try:
        out = rd.read_numbered_lines(spark, str(tmp_path))
        assert out.rdd.getNumPartitions() > 3
        assert all(r.value == f"{r.file.rsplit('/', 1)[-1]} line {r.line_no}" for r in out.collect()) and out.count() == 5003
        moved = [node for kind, node in plan_nodes(out) if "Exchange" in kind or kind == "SortExec"]
        assert moved and not any("value" in node.output().mkString(" ") for node in moved)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_dated_logs_are_pruned_by_bounds_known_at_run_time(spark, tmp_path):
    from wardlog.plans.parse_queries import recent_logs

    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(hours=h), "m", ("ssh", "web")[h % 2]) for h in range(24 * 30)]
    path = str(tmp_path / "logs")
    wr.write_logs(spark.createDataFrame(rows, "timestamp timestamp, message string, log_type string"), path)
    newest = spark.createDataFrame([(start + dt.timedelta(days=20, hours=6),)], "timestamp timestamp")
    found = recent_logs(spark, path, newest, hours=36)
    scans = [node for kind, node in plan_nodes(found) if kind == "FileSourceScanExec"]
    assert found.count() == 18 + 1
    # Of 30 days and two prefixes, one prefix of the two days between the bounds is read.
    assert [scan.metrics().apply("numPartitions").value() for scan in scans] == [2]


def test_folder_profile_of_different_tables(spark, tmp_path):
    from wardlog.sources.profile import folder_profile

    (tmp_path / "deep").mkdir()
    (tmp_path / "a.csv").write_text('timestamp,"source_ip",is_attack,note\n2024-01-01 00:00:00,1.1.1.1,true,"x, ""y"""\n'
                                    '2024-01-02 00:00:00,1.1.1.2,false,\n\n2024-01-03 00:00:00,1.1.1.1,false,z\n')
    (tmp_path / "deep" / "b.csv").write_text("label,n,v\r\n" + "".join(f"l{i % 12},{i},{i}.5\r\n" for i in range(30)))
    (tmp_path / "deep" / "names.csv").write_text("label,x\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "other.txt").write_text("a,b\n1,2\n")
    got = {r.path.rsplit("/", 1)[-1]: r for r in folder_profile(spark, str(tmp_path)).collect()}
    assert set(got) == {"a.csv", "b.csv", "names.csv"}
    a, b, names = got["a.csv"], got["b.csv"], got["names.csv"]
    assert (a.rows, a.has_timestamp, a.unique_ips, a.about_ips) == (3, True, 2, 2) and a.label_counts is None
    assert [tuple(c) for c in a.columns] == [("timestamp", "timestamp"), ("source_ip", "string"), ("is_attack", "boolean"), ("note", "string")]
    assert [tuple(c) for c in a.attack_counts] == [("false", 2), ("true", 1)]
    assert [tuple(c) for c in b.columns] == [("label", "string"), ("n", "bigint"), ("v", "double")] and b.rows == 30 and not b.has_timestamp
    assert [tuple(c) for c in b.label_counts] == [(f"l{i}", 3) for i in range(6)] + [("l10", 2), ("l11", 2), ("l6", 2), ("l7", 2)]
    assert names.rows == 0 and names.label_counts is None and names.unique_ips is None
