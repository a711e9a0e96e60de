import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from wardlog.operators import activity as act
from wardlog.operators import metrics as M
from wardlog.operators import respond as rsp

T0 = dt.datetime(2024, 1, 5, 12, 30)
HOUR = dt.timedelta(hours=1)
PRED = ("timestamp timestamp, source_ip string, is_attack boolean, attack_type string, ml_anomaly boolean, "
        "ml_anomaly_score double, ml_model string")


@pytest.fixture
def preds(rows):
    data = [
        (T0, "a", True, "xss", True, 0.9, "kaggle"),
        (T0 - dt.timedelta(minutes=5), "b", True, "", False, 0.1, "unified"),
        (T0 - dt.timedelta(minutes=10), "b", True, "xss", True, 0.5, "kaggle"),
        (T0 - 2 * HOUR, " ", True, "brute_force", True, 0.2, "custom"),
        (T0 - 2 * HOUR, "c", False, "", True, 0.99, "custom"),
        (T0 - 13 * HOUR, "d", True, "xss", False, 0.3, "other"),
        (T0 - 24 * HOUR, "b", True, "xss", False, 0.3, "custom"),
        (T0 - 24 * HOUR - dt.timedelta(seconds=1), "e", True, "xss", False, 0.3, "custom")]
    return rows(data, PRED)


def test_anchor_fallbacks(rows, preds):
    empty = rows([], PRED)
    assert act.activity_anchor(preds).first().anchor == T0
    assert act.activity_anchor(empty, preds).first().anchor == T0
    assert act.activity_anchor(empty, empty, F.lit(T0 - HOUR)).first().anchor == T0 - HOUR


def test_totals_and_recent(preds):
    assert tuple(act.activity_totals(preds).first()) == (8, 7)
    assert tuple(act.recent_activity(preds).first()) == (4, 2)
    assert tuple(act.top_attacker(preds).first()) == ("b", "a", 1)
    assert tuple(act.ingest_and_alert_rate(preds).first()) == (0.1, 3)


def test_timeline_has_24_hours_and_exact_edges(preds):
    out = act.hourly_timeline(preds).orderBy("hour_start").collect()
    assert len(out) == 24 and out[-1].hour_start == T0.replace(minute=0) and out[0].hour_label == "13"
    # The hour 24 hours back is outside the 24 buckets, though its row is in the window.
    assert {r.hour_label: r.attacks for r in out if r.attacks} == {"12": 3, "10": 1, "23": 1}
    both = act.hourly_timeline(preds, [preds]).where("attacks > 0").collect()
    assert {r.hour_label: r.attacks for r in both} == {"12": 6, "10": 3, "23": 2}


def test_hourly_table_ties_and_priorities(preds):
    out = {r.hour_label: r for r in act.hourly_attack_table(preds).collect()}
    top = out["12"]
    assert (top.total_alerts, top.attacks, top.top_ip, top.top_attack_type, top.top_model) == (3, 3, "b", "xss", "Kaggle")
    assert top.avg_score == pytest.approx(0.5)
    two = out["10"]
    assert (two.total_alerts, two.attacks, two.top_ip, two.top_model) == (2, 1, None, "Custom")
    assert out["23"].top_model is None and out["05"].attacks == 0 and out["05"].top_ip is None


def test_severity_and_summary(preds):
    table = act.hourly_severity(act.hourly_attack_table(preds)).orderBy("hour_start").collect()
    assert [(r.hour_range, r.severity) for r in table] == [("23:00-00:00", "High"), ("10:00-11:00", "Medium"), ("12:00-13:00", "High")]
    assert tuple(act.hourly_summary_text(act.hourly_timeline(preds)).first()) == ("23: 1, 10: 1, 12: 3", 0)


def test_summary_text_counts_further_hours(rows):
    data = [(T0 - i * HOUR, "a", True) for i in range(20)]
    df = rows(data, "timestamp timestamp, source_ip string, is_attack boolean")
    text, more = act.hourly_summary_text(act.hourly_timeline(df)).first()
    assert text.count(":") == 12 and more == 8


def test_model_tags(rows):
    a, b = rows([(1,)], "x int"), rows([(2,), (3,)], "x int")
    out = act.tag_model({"unified": a, "custom": b}).groupBy("ml_model").count().collect()
    assert {r.ml_model: r["count"] for r in out} == {"unified": 1, "custom": 2}


@pytest.mark.parametrize("kind,hot,count", [
    ("brute_force", True, 6), ("brute_force", False, 3), ("sql_injection", True, 5), ("sql_injection", False, 3), ("xss", True, 4), ("xss", False, 1),
    ("escalation", True, 4), ("escalation", False, 2), ("unknown", True, 4), ("other", False, 2), ("", True, 4), (None, True, 4)])
def test_recommendations(rows, kind, hot, count):
    out = rsp.attach_recommendations(rows([(kind, hot)], "attack_type string, ml_anomaly boolean")).first()
    assert len(out.defense_recommendations.split(" | ")) == count


def test_recommendation_defaults(rows):
    assert rsp.attach_recommendations(rows([(1,)], "x int")).first().defense_recommendations == " | ".join(t for t, _ in rsp.actions("unknown", "medium"))
    given = rows([("keep",)], "defense_recommendations string")
    assert rsp.attach_recommendations(given).first().defense_recommendations == "keep"
    text = rsp.recommendation_text(rows([("xss", "medium")], "attack_type string, severity string")).first().recommendation_text
    assert text == "\n".join(f"{i}. {t}: {d}" for i, (t, d) in enumerate(rsp.actions("xss", "medium"), start=1))


def test_plan_and_summary(preds):
    plan = {r.attack_type: r for r in rsp.defense_plan(preds).collect()}
    assert {k: (r.ml_count, r.rule_count, r.severity) for k, r in plan.items()} == {
        "xss": (2, 5, "high"), "unknown": (1, 1, "high"), "brute_force": (1, 1, "high")}
    assert plan["xss"].actions.count("\n") == 2
    assert [tuple(r) for r in rsp.top_addresses(preds).collect()] == [("b", 3), ("a", 1), ("c", 1)]
    assert tuple(rsp.prediction_summary(preds).first()) == (8, 4, 7, "b")


def test_lone_prediction_counts_as_rule(rows):
    df = rows([("a", "x", False, False, "1"), ("a", "y", False, False, "0")],
              "attack_type string, source_ip string, ml_anomaly boolean, is_attack boolean, prediction string")
    r = rsp.defense_plan(df).first()
    assert (r.ml_count, r.rule_count, r.severity) == (0, 1, "medium")


def test_priority_pool(rows, preds):
    top = rsp.priority_alerts(preds)
    assert [r.ml_anomaly_score for r in top.orderBy(F.col("ml_anomaly_score").desc()).collect()] == [0.99, 0.9, 0.5]
    assert [r.source_ip for r in rsp.priority_alerts(preds.where("not ml_anomaly"), 2).collect()].count("d") <= 1
    one = rsp.priority_alerts(preds.where("source_ip in ('c', 'd')")).collect()
    assert [r.source_ip for r in one] == ["c"]  # the rule alert is another pool
    quiet = preds.withColumn("ml_anomaly", F.lit(False)).withColumn("is_attack", F.lit(False))
    assert rsp.priority_alerts(quiet).count() == 3


def test_checklist_is_distinct_in_order(rows):
    top = rows([(1, "Block it; - Patch "), (2, "block IT | Watch;;"), (3, None)], "n int, defense_recommendations string")
    out = rsp.defense_checklist(top, [F.col("n")]).orderBy("pos").collect()
    assert [(r.pos, r.item) for r in out] == [(1, "Block it"), (2, "Patch"), (3, "Watch")]


@pytest.mark.parametrize("total,ml,rule,want", [
    (30, 6, 0, ("high", "high", "act_now")), (30, 5, 9, ("medium", "high", "act_now")), (10, 3, 0, ("high", "high", "act_now")),
    (10, 0, 2, ("low", "medium", "watch_closely")), (5, 0, 0, ("info", "low", "keep_monitoring")), (0, 0, 0, ("info", "low", "keep_monitoring"))])
def test_incident_grades(rows, total, ml, rule, want):
    df = rows([(i < ml, i < rule) for i in range(total)], "ml_anomaly boolean, is_attack boolean")
    r = rsp.incident_summary(df, from_fallback=total > 10).first()
    assert (r.severity, r.confidence, r.action_status) == want
    assert r.data_scope == ("expanded_records_from_predictions_csv" if total > 10 else "preview_10_records")


def test_report_document(preds):
    alerts = preds.withColumn("defense_recommendations", F.when(F.col("source_ip") == "a", "—").otherwise("Patch"))
    top = rsp.priority_alerts(alerts)
    order = [-F.col("ml_anomaly_score")]
    report = rsp.incident_report(alerts, rsp.defense_checklist(top, order), top, "predictions.csv (fallback)", "m", "x-*", F.lit(T0))
    doc = json.loads(report.select(F.to_json(F.struct("*"))).first()[0])
    assert doc["severity"] == "high" and doc["run_index"] == "N/A (fallback mode)" and doc["next_actions"] == list(rsp.NEXT_ACTIONS["ml"])
    assert [a["ml_anomaly_score"] for a in doc["top_alerts"]] == [0.99, 0.9, 0.5]
    assert doc["top_alerts"][1]["defense_recommendations"] == "; ".join(t for t, _ in rsp.actions("xss", "high")[:3])
    assert doc["defense_checklist"][0] == "Patch" and doc["summary"] == {"records": 8, "ml_anomalies": 4, "rule_warnings": 7}
    assert doc["executive_conclusion"] and doc["analysis_scope_note"]


def test_a_playbook_can_be_given(spark, rows):
    playbook = rows([("xss", "high", 1, "Own step", "d"), ("unknown", "high", 1, "Other step", "d")],
                    "attack_type string, severity string, pos int, title string, detail string")
    df = rows([("xss", True), ("odd", True), (None, True)], "attack_type string, is_attack boolean")
    got = {r.attack_type: r.defense_recommendations for r in rsp.attach_recommendations(df, playbook).collect()}
    assert got == {"xss": "Own step", "odd": "Other step", None: "Other step"}


def test_report_without_checklist(rows, preds):
    none = rows([], "pos int, item string")
    doc = rsp.incident_report(preds, none, rsp.priority_alerts(preds.limit(0).withColumn("defense_recommendations", F.lit(""))),
                              "table", "m", "", F.lit(T0)).first()
    assert doc.defense_checklist == list(rsp.DEFAULT_CHECKLIST) and doc.run_index == "unknown" and doc.top_alerts == []


def test_feed_prefers_model_alerts(rows, preds):
    frame = preds.withColumn("timestamp", F.date_format("timestamp", "HH:mm")).withColumn("defense_recommendations", F.lit(""))
    out = rsp.alert_feed(frame, [F.col("ml_anomaly_score")]).orderBy("pos").collect()
    assert len(out) == 4 and out[0].line.startswith("10:30 | ML_ATTACK | RULE_ATTACK |")
    quiet = rsp.alert_feed(frame.withColumn("ml_anomaly", F.lit(False)), [F.col("ml_anomaly_score")]).count()
    assert quiet == 5


# --- quality -----------------------------------------------------------------

def _scored(rows, n, seed):
    rng = random.Random(seed)
    return [(rng.random() < 0.3, rng.choice([0.1, 0.2, 0.5, rng.random()])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_counts_pairs(rows, seed):
    data = _scored(rows, 200, seed)
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert M.roc_auc(rows(data, "y boolean, s double"), "y", "s").first().roc_auc == pytest.approx(want)
    assert M.roc_auc(rows([(True, 0.5)], "y boolean, s double"), "y", "s").first().roc_auc is None


def test_published_confusion_matrix(spark, rows):
    cells = rows([(0, 0, 1175), (0, 1, 1), (1, 0, 8), (1, 1, 1168)], "y int, p int, n int")
    df = cells.select("y", "p", F.explode(F.sequence(F.lit(1), "n")))
    m = M.binary_metrics(df, "y", "p").first()
    assert (round(m.precision, 5), round(m.recall, 5), round(m.f1, 5)) == (0.99914, 0.99320, 0.99616)
    report = {r.name: r for r in M.classification_report(df, "y", "p").collect()}
    assert round(report["accuracy"].f1, 5) == 0.99617 and report["weighted avg"].support == 2352
    assert {(r.label, r.predicted): r.n for r in M.confusion_matrix(df, "y", "p").collect()} == {
        (0, 0): 1175, (0, 1): 1, (1, 0): 8, (1, 1): 1168}


def test_zero_division_gives_zero(rows):
    m = M.binary_metrics(rows([(0, 0)], "y int, p int"), "y", "p").first()
    assert (m.precision, m.recall, m.f1) == (0.0, 0.0, 0.0)


def test_profile(rows):
    df = rows([("1.1.1.1", "True", T0), ("1.1.1.1", "False", None), (None, "1", T0)], "source_ip string, is_attack string, timestamp timestamp")
    assert tuple(M.dataset_profile(df).first()) == (3, 3, True, 2, 1, 1)
    bare = M.dataset_profile(rows([(1,)], "x int")).first()
    assert (bare.rows, bare.has_timestamp, bare.unique_ips) == (1, False, 0)
    assert [(r.name, r.type) for r in M.column_types(df).collect()][0] == ("source_ip", "string")


def test_hours_of_the_first_readable_time_in_a_zone(rows):
    data = [("2024-01-01 23:10:00", None, True), ("junk", "2024-01-01T23:20:00Z", True), (None, "2024-01-01 23:30:00", True), ("", "", True), (None, None, True),
            ("2024-01-01 22:00:00", "2024-01-01 10:00:00", False)]
    df = rows(data, "timestamp string, `@timestamp` string, is_attack boolean")
    got = {r.hour_start.hour: r.attacks for r in act.hourly_timeline(df).where("attacks > 0").collect()}
    assert got == {23: 3}
    there = act.hourly_timeline(df, zone="Asia/Ho_Chi_Minh").where("attacks > 0").orderBy("hour_start").collect()
    assert [(r.hour_start.day, r.hour_start.hour, r.attacks) for r in there] == [(1, 23, 2), (2, 6, 1)]
