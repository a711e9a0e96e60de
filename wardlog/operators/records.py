"""From lines and raw documents to typed event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlog.functions import parsing as P
from wardlog.functions import rules as R
from wardlog.functions.values import blank_to_null
from wardlog.operators.keyed import scalar

# Label names that mark an attacker's line.
ATTACKER_LABEL = "attacker"
ESCALATION_LABELS = ("escalate", "escalated_command", "escalated_sudo_command", "escalated_sudo_session")
LINE_BLOCK = 65536


def split_syslog(lines: DataFrame, text: str = "value") -> DataFrame:
    """Add ``log_time, host, process, pid, body``; lines that do not fit are dropped."""
    line = F.trim(F.col(text))
    part = lambda group: F.regexp_extract(line, P.SYSLOG_LINE, group)
    return (lines.where(line.rlike(P.SYSLOG_LINE))
            .select("*", part(1).alias("log_time"), part(2).alias("host"), part(3).alias("process"),
                    part(4).alias("pid"), part(5).alias("body")))


def parse_ssh(df: DataFrame, text: str = "message", ipv6: bool = False) -> DataFrame:
    """Add ``source_ip, user, status, is_attack, attack_type`` from the text."""
    message = F.col(text)
    return (df.withColumn("source_ip", P.ssh_source_ip(message, ipv6))
            .withColumn("user", P.ssh_user(message))
            .withColumn("status", P.ssh_status(message))
            .withColumn("is_attack", P.ssh_is_attack(F.col("status")))
            .withColumn("attack_type", P.ssh_attack_type(F.col("status"))))


def text_log_events(lines: DataFrame, base_year: int, text: str = "value") -> DataFrame:
    """Plain syslog lines as canonical events (the file-fallback path)."""
    renamed = lines.withColumnRenamed(text, "message") if text != "message" else lines
    return (parse_ssh(renamed)
            .withColumn("timestamp", P.syslog_timestamp(F.col("message"), base_year))
            .withColumn("geoip_country", F.lit("")).withColumn("geoip_city", F.lit(""))
            .withColumn("log_type", F.lit("ssh")))


def auth_log_events(numbered: DataFrame, base_year: int, match_on: str = "body") -> DataFrame:
    """Numbered auth-log lines as events, irrelevant lines removed.

    The relevance test reads the body, as the process name is already cut off;
    ``match_on='line'`` tests the whole line instead.
    """
    rows = split_syslog(numbered)
    rows = rows.where(P.relevant_auth_body(F.col("body" if match_on == "body" else "value")))
    rows = parse_ssh(rows, "body").withColumn("message", F.trim("body"))
    return (rows.withColumn("timestamp", P.syslog_timestamp(F.col("log_time"), base_year))
            .withColumn("log_type", F.lit("ssh")))


def attack_label_lines(labels: DataFrame) -> DataFrame:
    """Line numbers whose labels name an attacker or an escalation."""
    hostile = F.exists("labels", lambda x: F.lower(x).contains(ATTACKER_LABEL) | x.isin(*ESCALATION_LABELS))
    keys = [c for c in labels.columns if c not in ("labels",)]
    return labels.where(F.col("line").isNotNull() & hostile).select(*keys).distinct()


def apply_labels(events: DataFrame, attack_lines: DataFrame, file_key: str | None = None) -> DataFrame:
    """Mark labelled lines as attacks; a blank attack type becomes ``escalation``.

    With ``file_key`` the label must come from the same file; without it any
    file's line number counts.
    """
    marks = attack_lines.select(
        *([F.col(file_key).alias("_file")] if file_key else []),
        F.col("line").alias("_line"), F.lit(True).alias("_hit")).distinct()
    on = F.col("line_no") == F.col("_line")
    if file_key:
        on = on & (F.col(file_key) == F.col("_file"))
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    joined = events.join(marks, on, "left")
    marked = joined.withColumn("is_attack", F.col("is_attack") | hit).withColumn(
        "attack_type", F.when(hit & (F.col("attack_type") == ""), "escalation").otherwise(F.col("attack_type")))
    return marked.select(*events.columns)


def extract_ssh_fields(lines: DataFrame, lower_status: bool = True) -> DataFrame:
    """Structured fields of password lines; other lines keep nulls.

    The status word is lower-cased so that counters of ``failed`` see it.
    """
    part = lambda group: P.first_group(F.col("message"), P.SSH_PASSWORD_LINE, group)
    return lines.select(
        "*", part(1).alias("log_time"), part(2).alias("host"), part(3).cast("int").alias("pid"),
        (F.lower(part(4)) if lower_status else part(4)).alias("status"), part(5).alias("user"), part(6).alias("source_ip"),
        part(7).cast("int").alias("port"))


def extract_access_fields(lines: DataFrame) -> DataFrame:
    """Structured fields of access-log lines; other lines keep nulls."""
    part = lambda group: P.first_group(F.col("message"), P.ACCESS_LINE, group)
    return lines.select(
        "*", part(1).alias("clientip"), P.access_timestamp(part(2)).alias("timestamp"),
        part(3).alias("verb"), part(4).alias("request"), part(5).alias("httpversion"),
        part(6).try_cast("int").alias("response"), part(7).try_cast("bigint").alias("bytes"))


def apply_rules(df: DataFrame, log_type: Column, quoted: bool = False) -> DataFrame:
    """Add ``matched_rules, attack_type, severity, is_attack, tags``.

    ``attack_type`` and ``severity`` come from the first matching rule in the
    order brute force, SQL injection, cross-site scripting.
    """
    request = F.col("request") if "request" in df.columns else F.lit(None).cast("string")
    checks = [
        (R.brute_force(F.col("message"), log_type), "brute_force", "high"),
        (R.sql_injection(request, log_type, quoted), "sql_injection", "high"),
        (R.xss(request, log_type), "xss", "medium"),
    ]
    matched = F.array_compact(F.array(*[F.when(hit, name) for hit, name, _ in checks]))
    levels = F.create_map(*[F.lit(x) for _, name, level in checks for x in (name, level)])
    out = df.withColumn("matched_rules", matched)
    first = F.get("matched_rules", F.lit(0))
    return (out.withColumn("attack_type", first)
            .withColumn("severity", F.try_element_at(levels, first))
            .withColumn("is_attack", F.size("matched_rules") > 0)
            .withColumn("tags", F.when(F.array_contains("matched_rules", "brute_force"),
                                       F.array(F.lit(R.BRUTE_FORCE_TAG)))
                        .otherwise(F.array().cast("array<string>"))))


def document_log_type(docs: DataFrame) -> Column:
    """Top-level tag, else the nested tag, else a guess from the text."""
    return F.coalesce(blank_to_null(F.col("log_type")), blank_to_null(F.col("fields.log_type")),
                      P.sniff_log_type(F.col("message")))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _address(docs: DataFrame) -> Column:
    return F.coalesce(blank_to_null(F.col("source_ip")), blank_to_null(F.col("source.ip")))


def _is_ssh() -> Column:
    return F.coalesce(F.lower("_type").contains("ssh"), F.lit(False)) | F.lower(_text("message")).contains("ssh")


def _is_web() -> Column:
    return F.coalesce(F.lower("_type").contains("web"), F.lit(False)) | P.looks_like_web(_text("message"))


def _typed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_type", document_log_type(docs))


def ssh_columns(docs: DataFrame) -> dict[str, Column]:
    """Columns of an SSH document: stored fields win, the parsed text fills the gaps."""
    message = _text("message")
    parsed = P.ssh_status(message)
    return {
        "timestamp": F.col("timestamp"),
        "source_ip": F.coalesce(_address(docs), P.ssh_source_ip(message)),
        "user": F.coalesce(blank_to_null(F.col("user")), P.ssh_user(message)),
        "status": F.coalesce(blank_to_null(F.col("status")), parsed),
        "message": message,
        "attack_type": F.coalesce(blank_to_null(F.col("attack_type")), P.ssh_attack_type(parsed)),
        "is_attack": F.coalesce("is_attack", F.lit(False)) | P.ssh_is_attack(parsed),
        "geoip_country": F.coalesce("geoip.country_name", F.lit("")),
        "geoip_city": F.coalesce("geoip.city_name", F.lit("")),
        "log_type": F.coalesce("_type", F.lit("ssh"))}


def web_columns(docs: DataFrame) -> dict[str, Column]:
    """Columns of a web document by tag, or by text when the tag says otherwise."""
    tagged = F.coalesce(F.lower("_type").contains("web"), F.lit(False))
    client = F.coalesce(
        blank_to_null(F.col("clientip")), F.when(tagged, blank_to_null(F.col("source.ip"))), F.lit(""))
    return {
        "timestamp": F.col("timestamp"), "source_ip": client, "clientip": client, "request": _text("request"),
        "response": F.col("response"), "bytes": F.coalesce("bytes", F.lit(0)), "verb": _text("verb"), "message": _text("message"),
        "is_attack": F.coalesce("is_attack", F.lit(False)), "attack_type": _text("attack_type"),
        "geoip_country": F.when(tagged, F.coalesce("geoip.country_name", F.lit(""))).otherwise(""),
        "log_type": F.when(tagged, F.col("_type")).otherwise("web")}


def raw_columns(docs: DataFrame) -> dict[str, Column]:
    """Columns of any document in one generic shape; here a parsed attack type overrides."""
    message = _text("message")
    ssh = _is_ssh()
    parsed = F.when(ssh, P.ssh_status(message)).otherwise("")
    return {
        "timestamp": F.col("timestamp"), "message": message, "log_type": F.coalesce("_type", F.lit("unknown")),
        "source_ip": F.coalesce(_address(docs), F.when(ssh, P.ssh_source_ip(message)), F.lit("")),
        "clientip": _text("clientip"),
        "user": F.coalesce(blank_to_null(F.col("user")), F.when(ssh, P.ssh_user(message)), F.lit("")),
        "status": F.coalesce(blank_to_null(F.col("status")), parsed),
        "request": _text("request"), "response": F.col("response"), "bytes": F.coalesce("bytes", F.lit(0)),
        "verb": _text("verb"),
        "is_attack": F.coalesce("is_attack", F.lit(False)) | P.ssh_is_attack(parsed),
        "attack_type": F.coalesce(blank_to_null(P.ssh_attack_type(parsed)), _text("attack_type")),
        "geoip_country": F.coalesce("geoip.country_name", F.lit("")),
        "geoip_city": F.coalesce("geoip.city_name", F.lit(""))}


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def ssh_records(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """SSH documents: stored fields win, the parsed text fills the gaps."""
    return _typed(docs).where(_is_ssh()).select(*keep, *_named(ssh_columns(docs)))


def web_records(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Web documents by tag, or by text when the tag says otherwise."""
    return _typed(docs).where(_is_web()).select(*keep, *_named(web_columns(docs)))


def raw_records(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every document in one generic shape; here a parsed attack type overrides."""
    extra = [F.map_filter("extra", lambda k, v: v.isNotNull()).alias("extra")] if "extra" in docs.columns else []
    return _typed(docs).select(*keep, *_named(raw_columns(docs)), *extra)


def extract(docs: DataFrame, mode: str = "all", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Typed rows for ``ssh``, ``web`` or ``all``.

    ``all`` gives both typed sets (a document may be in both), each document read once; only when
    no document at all is typed does it return the generic records.
    """
    if mode == "ssh":
        return ssh_records(docs, keep)
    if mode == "web":
        return web_records(docs, keep)
    hit = _is_ssh() | _is_web()
    # Looks for a single typed document: every task stops at its first.
    typed = scalar(_typed(docs).where(hit).select("_type").limit(1), F.count(F.lit(1)) > 0)
    shapes = {"ssh": ssh_columns(docs), "web": web_columns(docs), "raw": raw_columns(docs)}
    given = {"ssh": _is_ssh(), "web": _is_web(), "raw": ~hit & ~typed}
    shaped = _typed(docs).withColumn("_shape", F.explode(F.array_compact(F.array(*[F.when(given[k], k) for k in shapes]))))
    out = []
    for name in dict.fromkeys(c for columns in shapes.values() for c in columns):
        value = None
        for shape, columns in shapes.items():
            if name in columns:
                fits = F.col("_shape") == shape
                value = F.when(fits, columns[name]) if value is None else value.when(fits, columns[name])
        out.append(value.alias(name))
    return shaped.select(*keep, *out)


def _join_lines(lines: DataFrame, by: list[str]) -> DataFrame:
    """Texts joined in line order by group, null if all are, with the first line number."""
    texts = F.sort_array(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("line_no", "value"))))
    return lines.groupBy(*by).agg(F.min("line_no").alias("line_no"),
                                  F.when(F.count("value") > 0, F.array_join(texts["value"], "\n")).alias("value"))


def multiline_records(lines: DataFrame, piece_lines: int | None = None) -> DataFrame:
    """Join continuation lines to the record they follow: ``file, line_no, value``, one row for each record.

    A line belongs to the nearest start at or before it: the last one inside its block of lines, or else the
    last of the file's earlier blocks, so a long file needs no single sorted task. Lines
    before the first start form one record of their own. Lines between the first and the last start of a block make
    records that end there. The others are joined by block first, and then one text for each block
    by record, so a record of many blocks is never held as single lines. A null line starts no record and adds nothing.
    One row for each block of a file is broadcast.

    A record is one value, 2 GB at most; a longer one fails the job. With ``piece_lines`` a record comes in rows
    of that many lines instead, counted from its first: ``piece`` numbers them from 0, ``line_no`` is the first line of each.
    """
    rows = lines.select(
        "file", "line_no", "value", F.floor(F.col("line_no") / LINE_BLOCK).alias("_block"),
        F.when(F.col("value").rlike(P.RECORD_START), F.col("line_no")).alias("_start"))
    blocks = rows.groupBy("file", "_block").agg(
        F.min("_start").alias("_next"), F.max("_start").alias("_last"), F.min("line_no").alias("_first"))
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = F.min("_first").over(Window.partitionBy("file"))
    bounds = blocks.select("file", "_block", "_next", "_last", F.coalesce(F.max("_last").over(earlier), first).alias("_carried"))
    upto = (Window.partitionBy("file", "_block").orderBy("line_no")
            .rowsBetween(Window.unboundedPreceding, 0))
    known = rows.join(F.broadcast(bounds), ["file", "_block"])
    inside = F.coalesce((F.col("line_no") >= F.col("_next")) & (F.col("line_no") < F.col("_last")), F.lit(False))
    closed = known.where(inside).withColumn("_record", F.max("_start").over(upto))
    crossing = known.where(~inside).withColumn(
        "_record", F.when(F.col("line_no") >= F.col("_last"), F.col("_last")).otherwise(F.col("_carried")))
    row = ["file", "_record"]
    if piece_lines is not None:
        row.append("piece")
        piece = F.floor((F.col("line_no") - F.col("_record")) / piece_lines)
        closed, crossing = closed.withColumn("piece", piece), crossing.withColumn("piece", piece)
    found = [_join_lines(closed, [*row, "_block"]), _join_lines(_join_lines(crossing, [*row, "_block"]), row)]
    closed, crossing = [part.select("file", "line_no", "value", *row[2:]) for part in found]
    return closed.unionByName(crossing)
