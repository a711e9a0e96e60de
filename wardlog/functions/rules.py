"""Rule detection as boolean column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The detection patterns, their attack type and severity.
BRUTE_FORCE_MARKERS = ("Failed password", "invalid user")
SQL_INJECTION = (
    r"(?i)(union\s+(all\s+)?select|select\s+.*\s+from|insert\s+into|delete\s+from"
    r"|drop\s+(table|database)|exec\s*\(|script\s*="
    r"|(%27|')(\s|%20)*(or|and)(\s|%20)+[\w]+(\s|%20)*=(\s|%20)+[\w]+)"
)
# Stricter addition: quoted operands and no blank around '=', as in ' OR '1'='1.
SQL_INJECTION_QUOTED = (
    r"(?i)(%27|')(\s|%20)*(or|and)(\s|%20)+(%27|')?\w+(%27|')?(\s|%20)*=(\s|%20)*(%27|')?\w+"
)
XSS = r"(?i)(<script|javascript:|onerror=|onload=)"
BRUTE_FORCE_TAG = "brute_force_attempt"


def is_ssh_input(message: Column, log_type: Column) -> Column:
    return F.coalesce(log_type == "ssh", F.lit(False)) | F.coalesce(
        message.contains("sshd"), F.lit(False))


def is_web_input(log_type: Column) -> Column:
    return F.coalesce(log_type == "web", F.lit(False))


def brute_force(message: Column, log_type: Column) -> Column:
    hit = message.contains(BRUTE_FORCE_MARKERS[0]) | message.contains(BRUTE_FORCE_MARKERS[1])
    return is_ssh_input(message, log_type) & F.coalesce(hit, F.lit(False))


def sql_injection(request: Column, log_type: Column, quoted: bool = False) -> Column:
    hit = request.rlike(SQL_INJECTION)
    if quoted:
        hit = hit | request.rlike(SQL_INJECTION_QUOTED)
    return is_web_input(log_type) & F.coalesce(hit, F.lit(False))


def xss(request: Column, log_type: Column) -> Column:
    return is_web_input(log_type) & F.coalesce(request.rlike(XSS), F.lit(False))
