"""Text-to-column expressions for syslog, SSH and access-log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and markers that decide what a line means.
SYSLOG_LINE = r"^(\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+(\S+?)(?:\[(\d+)\])?:\s*(.*)$"
SYSLOG_TIME = r"^([A-Z][a-z]{2}\s+\d{1,2}\s+\d{1,2}:\d{2}:\d{2})"
LEADING_TIME = r"^\s*\[?(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:[.,]\d{1,9})?(?:Z|[+-]\d{2}:?\d{2})?)"
BRACKETED_TIME = r"\[(\d{1,2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4})\]"
RECORD_START = r"^[A-Z][a-z]{2}\s+\d{1,2}\s"
IP_AFTER_FROM = r"from\s+([\d\.]+)"
IP_AFTER_FROM_V6 = r"from\s+([0-9A-Fa-f:\.]*[:\.][0-9A-Fa-f:\.]*)"
IP_DOTTED_QUAD = r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"
USER_PATTERNS = (
    r"(?i)for\s+(?:invalid\s+)?user\s+(\S+)",
    r"(?i)password for\s+(\S+)\s+from",
    r"(?i)publickey for\s+(\S+)\s+from",
    r"(?i)session opened for user\s+(\S+)",
    r"(?i)session closed for user\s+(\S+)",
    r"(?i)Successful su for\s+(\S+)\s+by",
    r"(?i)user\s+(\S+)",
)
# (markers, status, attack?) in order of precedence; markers are lower case.
STATUS_RULES = (
    (("failed password",), "failed", True),
    (("accepted password", "accepted publickey"), "accepted", False),
    (("authentication failure",), "failed", True),
    (("invalid user",), "invalid_user", True),
    (("session opened for user", "session closed for user"), "session", False),
    (("su for",), "su", False),
    (("sudo:", "pam_unix(sudo:session)"), "sudo", False),
    (("did not receive identification",), "connection_refused", False),
    (("disconnected from", "received disconnect"), "disconnect", False),
)
SSH_PASSWORD_LINE = (
    r"([A-Z][a-z]{2} +\d{1,2} \d{2}:\d{2}:\d{2}) ([0-9A-Za-z][0-9A-Za-z.-]*) sshd\[(\d+)\]: "
    r"(\w+) password for (?:invalid user )?([a-zA-Z0-9._-]+) "
    r"from ([0-9A-Fa-f.:]+) port (\d+) ssh2"
)
ACCESS_LINE = (
    r'([0-9A-Fa-f.:]+) - - \[(\d{1,2}/[A-Z][a-z]{2}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4})\] '
    r'"(\w+) (/\S*) HTTP/(\d+(?:\.\d+)?)" (\d+) (\d+)'
)
RELEVANT_BODY_MARKERS = ("sshd", "ssh", "su[", "sudo", "pam_unix", "cron")


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """Captured group, or null when the pattern does not match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def contains_any(text: Column, markers: tuple[str, ...]) -> Column:
    found = text.contains(markers[0])
    for marker in markers[1:]:
        found = found | text.contains(marker)
    return found


def ssh_source_ip(message: Column, ipv6: bool = False) -> Column:
    """Address after ``from``, else the first dotted quad, else blank."""
    options = [first_group(message, IP_AFTER_FROM), first_group(message, IP_DOTTED_QUAD)]
    if ipv6:
        options.insert(0, first_group(message, IP_AFTER_FROM_V6))
    return F.coalesce(*options, F.lit(""))


def ssh_user(message: Column) -> Column:
    return F.coalesce(*[first_group(message, p) for p in USER_PATTERNS], F.lit(""))


def ssh_status(message: Column) -> Column:
    lowered = F.lower(message)
    chain = None
    for markers, status, _ in STATUS_RULES:
        hit = contains_any(lowered, markers)
        chain = F.when(hit, status) if chain is None else chain.when(hit, status)
    return F.coalesce(chain.otherwise(""), F.lit(""))


# Exactly these outcomes come from attack rows of the table above.
ATTACK_STATUSES = tuple(sorted({status for _, status, attack in STATUS_RULES if attack}))


def ssh_is_attack(status: Column) -> Column:
    return status.isin(*ATTACK_STATUSES)


def ssh_attack_type(status: Column) -> Column:
    return F.when(ssh_is_attack(status), "brute_force").otherwise("")


def is_failed(status: Column) -> Column:
    """A failed login in any letter case, as structured sources write ``Failed``."""
    return F.lower(status) == "failed"


def syslog_timestamp(line: Column, base_year: int) -> Column:
    """Timestamp of a line that carries no year; null when there is none."""
    stamp = F.regexp_replace(F.regexp_extract(line, SYSLOG_TIME, 1), r"\s+", " ")
    return F.try_to_timestamp(
        F.concat(F.lit(f"{base_year} "), stamp), F.lit("yyyy MMM d H:mm:ss"))


def leading_timestamp(line: Column) -> Column:
    """ISO-like time at the start of a line, with or without zone; null when there is none."""
    stamp = F.regexp_extract(line, LEADING_TIME, 1)
    return F.try_to_timestamp(F.nullif(F.replace(stamp, F.lit(","), F.lit(".")), F.lit("")))


def line_timestamp(line: Column, base_year: int) -> Column:
    """Time of a line in any of the layouts logs start with: syslog, ISO-like, or a bracketed access-log time."""
    bracketed = F.nullif(F.regexp_extract(line, BRACKETED_TIME, 1), F.lit(""))
    return F.coalesce(syslog_timestamp(line, base_year), leading_timestamp(line), access_timestamp(bracketed))


def access_timestamp(stamp: Column) -> Column:
    return F.try_to_timestamp(stamp, F.lit("d/MMM/yyyy:HH:mm:ss Z"))


def relevant_auth_body(body: Column) -> Column:
    return (F.trim(body) != "") & contains_any(F.lower(body), RELEVANT_BODY_MARKERS)


def sniff_log_type(message: Column) -> Column:
    """Guess the log family from the text alone; null when nothing fits."""
    lowered = F.lower(message)
    return (
        F.when(lowered.contains("ssh"), "ssh")
        .when(looks_like_web(message), "web")
    )


def looks_like_web(message: Column) -> Column:
    return (F.lower(message).contains("http")
            | message.contains("GET") | message.contains("POST"))
