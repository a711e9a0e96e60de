import datetime as dt

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import ORACLES
from wardlog.functions import parsing as P
from wardlog.functions import values as V
from wardlog.operators import records as rec

UTC = dt.timezone.utc
LINES = [
    ("Jan 19 10:01:01 h sshd[1]: Failed password for invalid user admin from 10.10.10.10 port 22 ssh2",
     "10.10.10.10", "admin", "failed", True, "brute_force"),
    ("Jan 19 10:01:01 h sshd[1]: Failed password for root from 1.2.3.4 port 22 ssh2", "1.2.3.4", "root", "failed", True, "brute_force"),
    ("Jan 19 10:00:01 h sshd[1]: Accepted password for user1 from 192.168.1.10 port 22 ssh2",
     "192.168.1.10", "user1", "accepted", False, ""),
    ("Accepted publickey for jhall from 1.2.3.4 port 2", "1.2.3.4", "jhall", "accepted", False, ""),
    ("Invalid user bob from 1.2.3.4 port 22", "1.2.3.4", "bob", "invalid_user", True, "brute_force"),
    ("authentication failure; rhost=1.2.3.4  user=root", "1.2.3.4", "", "failed", True, "brute_force"),
    ("Successful su for jhall by www-data", "", "jhall", "su", False, ""),
    ("pam_unix(sshd:session): session closed for user x", "", "x", "session", False, ""),
    ("Failed password for x from 2001:db8::1 port 22 ssh2", "2001", "x", "failed", True, "brute_force"),
    ("x sudo: y", "", "", "sudo", False, ""),
    ("Did not receive identification string from 9.9.9.9", "9.9.9.9", "", "connection_refused", False, ""),
    ("Received disconnect from 1.1.1.1: 11", "1.1.1.1", "", "disconnect", False, ""),
    ("nothing here", "", "", "", False, ""),
    ("", "", "", "", False, ""),
    (None, "", "", "", False, ""),
]


def test_ssh_message_fields(rows):
    out = rec.parse_ssh(rows([(i, line[0]) for i, line in enumerate(LINES)], "i int, message string")).orderBy("i").collect()
    for got, want in zip(out, LINES):
        assert (got.source_ip, got.user, got.status, got.is_attack, got.attack_type) == want[1:], want[0]


def test_ipv6_option(rows):
    df = rows([("from 2001:db8::1 port 22",), ("from 1.2.3.4 port",), ("from face to face",)], "m string")
    assert [r[0] for r in df.select(P.ssh_source_ip(F.col("m"), ipv6=True)).collect()] == ["2001:db8::1", "1.2.3.4", ""]


def test_syslog_time_with_padded_day_and_bad_lines(rows):
    df = rows([("Jan  3 01:02:03 h x: y",), ("Feb 29 01:02:03 h",), ("Feb 30 01:02:03 h",), ("junk",)], "m string")
    out = [r[0] for r in df.select(P.syslog_timestamp(F.col("m"), 2024).cast("string")).collect()]
    assert out == ["2024-01-03 01:02:03", "2024-02-29 01:02:03", None, None]


def test_syslog_header_drops_other_lines(rows):
    df = rows([("Jan 23 16:30:46 web sshd[25184]: Accepted x",), ("no header",), ("Jan 23 16:30:46 web CRON: run",)], "value string")
    out = rec.split_syslog(df).select("host", "process", "pid", "body").collect()
    assert [tuple(r) for r in out] == [("web", "sshd", "25184", "Accepted x"), ("web", "CRON", "", "run")]


@pytest.mark.parametrize("request_,rules", [
    ("/?id=1' OR '1'='1", []), ("/?a=1 union select 2", ["sql_injection"]), ("/?q=x' or a = b", ["sql_injection"]),
    ("/?cmd=<script>alert(1)</script>", ["xss"]), ("/?script=<script>", ["sql_injection", "xss"]), ("/index.html", []),
    (None, [])])
def test_web_rules(rows, request_, rules):
    df = rows([("m", request_)], "message string, request string")
    got = rec.apply_rules(df, F.lit("web")).first()
    assert got.matched_rules == rules and got.is_attack == bool(rules)
    assert got.attack_type == (rules[0] if rules else None)
    assert got.severity == ({"sql_injection": "high", "xss": "medium"}[rules[0]] if rules else None)
    assert rec.apply_rules(df, F.lit("ssh")).first().matched_rules == []


def test_quoted_injection_needs_the_strict_set(rows):
    df = rows([("m", "/?id=1' OR '1'='1")], "message string, request string")
    assert rec.apply_rules(df, F.lit("web"), quoted=True).first().matched_rules == ["sql_injection"]


def test_brute_force_rule_needs_ssh_input(rows):
    df = rows([("sshd[1]: Failed password",), ("Failed password",), ("sshd: failed password",)], "message string")
    assert [r.is_attack for r in rec.apply_rules(df, F.lit("system")).collect()] == [True, False, False]
    assert rec.apply_rules(df, F.lit("ssh")).collect()[1].tags == ["brute_force_attempt"]


def test_access_line(rows):
    df = rows([('1.2.3.4 - - [19/Feb/2026:22:20:01 +0700] "GET /a?b=1 HTTP/1.1" 401 567 "-" "UA"',), ("bad",)], "message string")
    good, bad = rec.extract_access_fields(df).collect()
    assert (good.clientip, good.verb, good.request, good.response, good.bytes) == ("1.2.3.4", "GET", "/a?b=1", 401, 567)
    assert bad.clientip is None and bad.timestamp is None


def test_timestamps_never_fail(rows):
    texts = ["2025-06-15T09:00:00.123Z", "2025-06-15T09:00:00+07:00", "2025-06-15 09:00:00", "junk", None]
    df = rows([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    utc = [r[0] for r in df.select(V.tolerant_timestamp(F.col("t")).cast("string")).collect()]
    assert utc == ["2025-06-15 09:00:00.123", "2025-06-15 02:00:00", "2025-06-15 09:00:00", None, None]
    local = [r[0] for r in df.select(V.display_timestamp(F.col("t")).cast("string")).collect()]
    assert local == ["2025-06-15 16:00:00.123", "2025-06-15 09:00:00", "2025-06-15 09:00:00", None, None]


def test_value_cleaning(rows):
    df = rows([("",), ("unknown",), ("NaN",), ("host1",), ("::1",), ("1.2.3.4",)], "ip string")
    assert [r[0] for r in df.select(V.clean_address(F.col("ip"))).collect()] == [None, None, None, None, "::1", "1.2.3.4"]
    flags = rows([("true", 2), ("Yes", 0), ("y", 1), ("no", None), (None, 0)], "a string, n int")
    assert [r[0] for r in flags.select(V.truthy_text(F.col("a"))).collect()] == [True, True, True, False, False]
    assert [r[0] for r in flags.select(V.truthy(F.col("n"))).collect()] == [True, False, True, False, False]


def test_log_type_precedence(rows):
    df = rows([("ssh", "web", "x"), ("", "web", "sshd"), (None, None, "SSHD: x"), (None, None, "GET /"), (None, None, "get /"),
               (None, None, "kernel: temperature")], "log_type string, f string, message string")
    docs = df.withColumn("fields", F.struct(F.col("f").alias("log_type")))
    assert [r[0] for r in docs.select(rec.document_log_type(docs)).collect()] == ["ssh", "web", "ssh", "web", None, None]


def test_multiline_across_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(rec, "LINE_BLOCK", 4)
    lines = ["tail of an older record"]
    for i in range(9):
        lines.append(f"Jan {i + 1} record {i}")
        lines += [f"  more {i}.{j}" for j in range(i % 4)]
    df = rows([("f", n, v) for n, v in enumerate(lines, start=1)], "file string, line_no long, value string")
    got = [r.value for r in rec.multiline_records(df).orderBy("line_no").collect()]
    want = []
    for line in lines:
        if line.startswith("Jan") or not want:
            want.append(line)
        else:
            want[-1] += "\n" + line
    assert got == want


def test_long_records_come_in_pieces(rows, monkeypatch):
    monkeypatch.setattr(rec, "LINE_BLOCK", 8)
    lines = [("f", n, f"x{n}") for n in range(1, 24)]  # no record starts here
    lines += [("g", n, "Jan 1 start" if n in (3, 20) else f"y{n}") for n in range(1, 31)] + [("h", 1, None), ("h", 2, "z")]
    got = rec.multiline_records(rows(lines, "file string, line_no long, value string"), piece_lines=5)
    read = {(r.file, r.line_no): (r.piece, r.value) for r in got.collect()}
    by_file = {f: sorted((n, p) for (g, n), (p, _) in read.items() if g == f) for f in "fgh"}
    assert by_file["f"] == [(1, 0), (6, 1), (11, 2), (16, 3), (21, 4)]
    assert by_file["g"] == [(1, 0), (3, 0), (8, 1), (13, 2), (18, 3), (20, 0), (25, 1), (30, 2)]
    assert read["h", 1] == (0, "z")
    for name in "fg":  # nothing is lost
        assert "\n".join(read[name, n][1] for n, _ in by_file[name]) == "\n".join(v for f, _, v in lines if f == name)


def test_records_are_whole_however_long(spark, monkeypatch):
    monkeypatch.setattr(rec, "LINE_BLOCK", 4096)
    starts = (12_000, 12_001, 12_500, 38_000)  # the longest record has 25,500 lines in seven blocks
    lines = [("f", n, None if n % 977 == 0 else f"Feb {n % 28 + 1} start" if n in starts else f"x{n}") for n in range(1, 40_001)]
    lines += [("g", n, f"y{n}") for n in range(1, 11_001)] + [("h", 1, None), ("h", 2, None)]
    lines += [("i", 1, "Mar 1 a")] + [("i", n, None) for n in range(2, 9_000)] + [("i", 9_000, "z")]
    frame = pd.DataFrame(lines, columns=["file", "line_no", "value"])
    df = spark.createDataFrame(lines, "file string, line_no long, value string").repartition(7)
    records = rec.multiline_records(df)
    assert records.columns == ["file", "line_no", "value"]
    got = {(r.file, r.line_no): r.value for r in records.collect()}
    want = {}
    for file, n, value in lines:
        if (value or "").startswith("Feb") or (file, n) in [("g", 1), ("h", 1), ("i", 1), ("f", 1)]:
            key = (file, n)
        want.setdefault(key, []).append(value)
    want = {k: "\n".join(v for v in values if v is not None) or None for k, values in want.items()}
    assert len(want) == 8 and got == want
    sql = ORACLES["multiline_records"]
    con = duckdb.connect()
    con.register("multiline_lines", frame)
    twin = con.execute(sql[sql.rindex("select file, min(line_no)"):]).fetchall()
    assert len(twin) == 8 and {(f, n): v for f, n, v in twin} == want


def test_labels_mark_attacks(rows):
    events = rows([("f", 1, False, ""), ("f", 2, True, "brute_force"), ("f", 3, False, ""), ("g", 1, False, "")],
                  "file string, line_no long, is_attack boolean, attack_type string")
    labels = rows([("f", 1, ["x_Attacker_y"]), ("f", 2, ["escalate"]), ("f", 3, ["benign"]), ("f", None, ["attacker"])],
                  "file string, line long, labels array<string>")
    marked = rec.apply_labels(events, rec.attack_label_lines(labels), "file").orderBy("file", "line_no")
    assert [(r.is_attack, r.attack_type) for r in marked.collect()] == [
        (True, "escalation"), (True, "brute_force"), (False, ""), (False, "")]
    loose = rec.apply_labels(events, rec.attack_label_lines(labels)).where("file = 'g'").first()
    assert loose.is_attack and loose.attack_type == "escalation"


def test_extract_reads_documents_once(spark, tmp_path):
    from wardlog.schema import RAW_DOCUMENT, conform

    def docs(*messages):
        frame = spark.createDataFrame(list(enumerate(messages)), "doc_id bigint, message string")
        path = str(tmp_path / f"docs-{len(messages)}")
        conform(frame, RAW_DOCUMENT).write.parquet(path)
        return spark.read.parquet(path)
    both = "Jan 3 10:00:00 h sshd[1]: Failed password for x from 1.2.3.4 port 22 ssh2"
    web = '9.9.9.9 - - [01/Jan/2024:00:00:00 +0700] "GET / HTTP/1.1" 200 5'
    typed = rec.extract(docs(both, "plain", web + " ssh"))
    got = sorted((r.doc_id, r.log_type, r.status) for r in typed.select("doc_id", "log_type", F.coalesce("status", F.lit("-")).alias("status")).collect())
    assert [g[0] for g in got].count(0) == 1 and 1 not in [g[0] for g in got] and [g[0] for g in got].count(2) == 2
    none = rec.extract(docs("plain", "words", "only", "here"))
    assert sorted((r.doc_id, r.log_type) for r in none.collect()) == [(k, "unknown") for k in range(4)]
    assert none.columns == typed.columns
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # the documents, and the search for a first typed one
