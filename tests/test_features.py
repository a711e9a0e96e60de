import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardlog.operators import features as ft
from wardlog.operators import windows as win

T0 = dt.datetime(2024, 1, 1)


def test_web_features(rows):
    df = rows([("1.2.3.4", "GET /index HTTP/1.1", "200"), ("1.2.3.4", "GET /page?id=1 HTTP/1.1", "404"),
               ("5.6.7.8", "POST /form HTTP/1.1", "500"), (None, None, "abc"), ("9", "", None)],
              "source_ip string, request string, response string")
    out = ft.web_features(df).collect()
    by = {(r.source_ip, r.response): r for r in out}
    assert by["1.2.3.4", 404].has_query_string == 1 and by["1.2.3.4", 404].is_4xx == 1
    assert by["1.2.3.4", 200].error_rate_per_ip == 0.5 and by["5.6.7.8", 500].is_5xx == 1
    assert by[None, 0].requests_per_ip == 0 and by[None, 0].error_rate_per_ip == 0.0 and by["9", 0].request_length == 0


@pytest.mark.parametrize("code,four,five", [(399, 0, 0), (400, 1, 0), (499, 1, 0), (500, 0, 1), (700, 0, 1)])
def test_status_classes(rows, code, four, five):
    r = ft.request_features(rows([(code,)], "response int")).first()
    assert (r.is_4xx, r.is_5xx, r.request_length, r.has_query_string) == (four, five, 0, 0)


def test_missing_web_columns_give_zero(rows):
    r = ft.web_features(rows([("1.2.3.4", 1)], "source_ip string, other int")).first()
    assert (r.request_length, r.is_4xx, r.response, r.requests_per_ip) == (0, 0, 0, 1)


def test_time_features(rows):
    df = rows([("2025-06-15 09:00:00",), ("2025-06-16 17:59:00",), ("2025-06-16 18:00:00",), (None,)], "t string").select(
        F.col("t").cast("timestamp").alias("timestamp"))
    a, b, c, d = ft.time_features(df).collect()
    assert (a.hour, a.day_of_week, a.is_weekend, a.is_business_hours) == (9, 6, 1, 1)
    assert (b.day_of_week, b.is_weekend, b.is_business_hours, c.is_business_hours) == (0, 0, 1, 0)
    assert (d.hour, d.is_weekend, d.is_business_hours) == (None, 0, 0)


def test_clean(rows):
    df = rows([(1, None, "x", None), (1, None, "x", None), (None, 2.5, None, True)], "a int, b double, c string, d boolean")
    out = sorted(tuple(r) for r in ft.clean(df).collect())
    assert out == [(0, 2.5, "unknown", True), (1, 0.0, "x", None)]


def test_ip_hash_and_counts(rows):
    out = {r.source_ip: r for r in ft.ip_features(rows([("10.10.10.10",), ("10.10.10.10",), (None,)], "source_ip string")).collect()}
    assert (out["10.10.10.10"].ip_hash, out["10.10.10.10"].requests_per_ip) == (1405276814, 2)
    assert (out[None].ip_hash, out[None].requests_per_ip) == (0, None)


def test_feature_set_dispatch(rows):
    frame = lambda cols: rows([], ", ".join(f"{c} string" for c in cols))
    assert ft.feature_set(frame(["request", "response"])) == (False, True)
    assert ft.feature_set(frame(["status", "source_ip"])) == (True, False)
    assert ft.feature_set(frame(["request", "response", "status", "source_ip"])) == (True, True)
    assert ft.feature_set(frame(["x"])) == (True, False)


def test_normalise(rows):
    df = rows([(1, 5, True), (3, 5, False)], "a int, b int, is_attack boolean")
    out = ft.minmax_normalize(df).orderBy("a").collect()
    assert [(r.a_normalized, r.b_normalized) for r in out] == [(0.0, None), (1.0, None)]
    assert "b_normalized" not in ft.minmax_normalize(df, drop_constant=True).columns


def test_encoding_is_sorted_and_total(rows):
    df = rows([("b",), ("a",), (None,), ("b",)], "user string")
    codes = ft.label_codes(df, "user")
    assert {r.user: r.code for r in codes.collect()} == {"a": 0, "b": 1, "unknown": 2}
    again = ft.label_encode(rows([("a",), ("new",)], "user string"), "user", codes)
    assert {r.user: r.user_encoded for r in again.collect()} == {"a": 0, "new": 3}


def test_feature_matrix_shape(rows):
    df = rows([(T0, "1.1.1.1", "root", "accepted"), (T0, "1.1.1.1", "admin", "failed"), (None, "", None, None)],
              "timestamp timestamp, source_ip string, user string, status string")
    out = ft.prepare_features(df)
    assert ft.model_columns(out) == ["hour", "day_of_week", "is_weekend", "requests_per_ip", "failed_login_count", "ip_hash", "user_encoded"]
    blank = out.where("source_ip = ''").first()
    assert (blank.ip_hash, blank.hour, blank.failed_login_count) == (0, 0, 0)
    assert out.count() == 3


def _brute(events, minutes):
    width = dt.timedelta(minutes=minutes)
    failed = [(ip, t) for _, ip, t, s in events if s == "failed" and ip is not None and t is not None]
    return {i: sum(1 for q, u in failed if q == ip and t - width <= u <= t) if s == "failed" and ip is not None and t is not None else 0
            for i, ip, t, s in events}


@pytest.mark.parametrize("seed,minutes", [(1, 1), (2, 5), (3, 60)])
def test_window_equals_brute_force(rows, seed, minutes):
    rng = random.Random(seed)
    span = minutes * 60 * 30
    events = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice([T0 + dt.timedelta(seconds=rng.randrange(span))] * 9 + [None]),
               rng.choice(["failed", "failed", "accepted"])) for i in range(400)]
    df = rows(events, "id int, source_ip string, timestamp timestamp, status string")
    got = {r.id: r.failed_login_count_window for r in win.failed_login_window(df, minutes).collect()}
    assert got == _brute(events, minutes)


def test_window_borders(rows):
    at = T0 + dt.timedelta(hours=1)  # a block border of the five-minute window
    events = [(1, "x", at, "failed"), (2, "x", at, "failed"), (3, "x", at - dt.timedelta(minutes=5), "failed"),
              (4, "x", at - dt.timedelta(minutes=5, microseconds=1), "failed")]
    got = {r.id: r.failed_login_count_window for r in win.failed_login_window(
        rows(events, "id int, source_ip string, timestamp timestamp, status string"), 5).collect()}
    assert got == {1: 3, 2: 3, 3: 2, 4: 1}


def test_sessions_match_spark(rows):
    rng = random.Random(7)
    t, events = T0, []
    for _ in range(300):
        t += dt.timedelta(seconds=rng.choice([5, 100, 299, 301, 900, 9000]))
        events.append((rng.choice("ab"), t, "failed"))
    df = rows(events, "source_ip string, timestamp timestamp, status string")
    key = lambda frame: sorted(tuple(r) for r in frame.collect())
    assert key(win.failed_sessions(df, 5)) == key(win.failed_session_stream(df, 5))


def test_ssh_features_equal_their_parts(rows):
    rng = random.Random(5)
    data = [(i, T0 + dt.timedelta(seconds=i * 40), rng.choice(["a", "b", None]), rng.choice(["failed", "accepted"]),
             rng.choice(["", "brute_force"])) for i in range(200)]
    df = rows(data, "id int, timestamp timestamp, source_ip string, status string, attack_type string")
    whole = ft.ssh_features(df, 5)
    parts = ft.attack_features(ft.ip_features(ft.time_features(df)), 5).select(*whole.columns)
    assert whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty()
