"""Scalar enrichment rules: address class, browser, OS, suspicious flags.

All rules are plain ``Column`` expressions (substring tests after
lower-casing, first hit wins), evaluated inside the scan's codegen stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: rule tables that results must agree with -----------------
# Address class by prefix, first hit wins.
PRIVATE_PREFIXES = ["10.", "192.168.", "172."]
LOCALHOST_PREFIXES = ["127."]
# Browser by lower-cased substring, first hit wins; else "Other".
BROWSER_RULES = [
    ("Firefox", ["firefox"]),
    ("Chrome", ["chrome"]),
    ("Safari", ["safari"]),
    ("Internet Explorer", ["msie", "trident"]),
]
# Operating system by lower-cased substring, first hit wins; else "Other".
OS_RULES = [
    ("Windows", ["windows"]),
    ("macOS", ["mac", "darwin"]),
    ("Linux", ["linux"]),
    ("Android", ["android"]),
    ("iOS", ["ios", "iphone", "ipad"]),
]
# Attack patterns looked for in the lower-cased URL of a parsed event.
URL_ATTACK_PATTERNS = ["../", "script>", "union select", "/etc/passwd", "cmd="]
# Raw-line rule used when sampling log files: an error status after a quoted
# request, or one of these lower-cased substrings.
LINE_STATUS_PATTERN = r'" [4-5]\d{2} '
LINE_ATTACK_PATTERNS = [
    "../", "union select", "/etc/passwd", "cmd=",
    "<script", "exec(", "eval(", "phpinfo", "shell",
    "wget", "curl", "../../", "base64",
]
SUSPICIOUS_STATUS = 400
OTHER = "Other"
# ---------------------------------------------------------------------------


def _any(col: Column, needles: list[str]) -> Column:
    return reduce(lambda acc, n: acc | col.contains(n), needles[1:], col.contains(needles[0]))


def _starts(col: Column, prefixes: list[str]) -> Column:
    return reduce(lambda acc, p: acc | col.startswith(p), prefixes[1:], col.startswith(prefixes[0]))


def _first_hit(text: Column, rules: list[tuple[str, list[str]]]) -> Column:
    low = F.lower(text)
    out = None
    for label, needles in rules:
        cond = _any(low, needles)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(OTHER))


def ip_class(ip: Column) -> Column:
    """private (10., 192.168., all of 172.), localhost (127.), else public ('' too)."""
    return (
        F.when(_starts(ip, PRIVATE_PREFIXES), F.lit("private"))
        .when(_starts(ip, LOCALHOST_PREFIXES), F.lit("localhost"))
        .otherwise(F.lit("public"))
    )


def browser(user_agent: Column) -> Column:
    return _first_hit(user_agent, BROWSER_RULES)


def operating_system(user_agent: Column) -> Column:
    return _first_hit(user_agent, OS_RULES)


def attack_url(url: Column) -> Column:
    """One of the five URL attack patterns, case-insensitive."""
    return _any(F.lower(url), URL_ATTACK_PATTERNS)


def suspicious(status: Column, url: Column) -> Column:
    """Status >= 400 or an attack pattern in the URL."""
    return (status >= F.lit(SUSPICIOUS_STATUS)) | attack_url(url)


def suspicious_line(line: Column) -> Column:
    """Raw-line rule of the log sampler (differs from :func:`suspicious`)."""
    return line.rlike(LINE_STATUS_PATTERN) | _any(F.lower(line), LINE_ATTACK_PATTERNS)


def enrich_events(parsed: DataFrame) -> DataFrame:
    """Add ip_class, browser, os and suspicious to parsed events (one projection)."""
    return parsed.withColumns(
        {
            "ip_class": ip_class(F.col("ip")),
            "browser": browser(F.col("user_agent")),
            "os": operating_system(F.col("user_agent")),
            "suspicious": suspicious(F.col("status"), F.col("url")),
        }
    )
