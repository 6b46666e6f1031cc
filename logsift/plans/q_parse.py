"""Parse job (§2.2) and scalar enrichment (§2.3) queries.

All of them are projections/filters of one scan of the derived lines table:
no shuffle anywhere, the parse runs in the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.functions import enrich as E
from logsift.functions.parse import KIND_ACCESS, KIND_ERROR, KIND_REJECT
from logsift.functions.rows import keep_where
from logsift.plans.catalog import query
from logsift.plans.oracle import ATTACK_URL, with_ctes
from logsift.session import prepare
from logsift.sources.fixtures import log_lines
from logsift.sources.logs import clean_lines, index_events, parse_all, parse_events

FIELDS = ["line_id", "ip", "timestamp", "method", "url", "status", "bytes", "referer", "user_agent"]
_FIELDS_SQL = ", ".join(FIELDS)


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    """Every non-blank line with its kind and fields (rejects included)."""
    return parse_all(log_lines(prepare(spark), sf))


def events(spark: SparkSession, sf: str) -> DataFrame:
    """The events table built from the derived lines (15 columns)."""
    return index_events(parse_events(log_lines(prepare(spark), sf)))


@query("parse_logs", "2.2", with_ctes(f"SELECT {_FIELDS_SQL} FROM parsed_all WHERE kind <> 'X'", "parsed_all"))
def parse_logs(spark, sf):
    return keep_where(parsed(spark, sf), F.col("kind") != KIND_REJECT).select(*FIELDS)


@query("parse_error_log", "2.2", with_ctes(f"SELECT {_FIELDS_SQL} FROM parsed_all WHERE kind = 'E'", "parsed_all"))
def parse_error_log(spark, sf):
    return keep_where(parsed(spark, sf), F.col("kind") == KIND_ERROR).select(*FIELDS)


@query("parse_access_log", "2.2", with_ctes(f"SELECT {_FIELDS_SQL} FROM parsed_all WHERE kind = 'A'", "parsed_all"))
def parse_access_log(spark, sf):
    return keep_where(parsed(spark, sf), F.col("kind") == KIND_ACCESS).select(*FIELDS)


@query("parse_rejects", "2.2", with_ctes("SELECT line_id, line FROM parsed_all WHERE kind = 'X'", "parsed_all"))
def parse_rejects(spark, sf):
    return keep_where(parsed(spark, sf), F.col("kind") == KIND_REJECT).select("line_id", "line")


@query("parse_timestamp_error", "2.2",
       with_ctes("SELECT line_id, timestamp, ingested_at FROM parsed_all WHERE kind = 'E'", "parsed_all"))
def parse_timestamp_error(spark, sf):
    return keep_where(parsed(spark, sf), F.col("kind") == KIND_ERROR).select("line_id", "timestamp", "ingested_at")


@query("parse_timestamp_access", "2.2",
       with_ctes("SELECT line_id, timestamp, ingested_at FROM parsed_all WHERE kind = 'A'", "parsed_all"))
def parse_timestamp_access(spark, sf):
    return keep_where(parsed(spark, sf), F.col("kind") == KIND_ACCESS).select("line_id", "timestamp", "ingested_at")


@query("parse_bytes", "2.2", with_ctes("SELECT line_id, a6 AS bytes_text, bytes FROM parsed_all "
                                       "JOIN groups USING (line_id) WHERE parsed_all.kind = 'A'", "parsed_all"))
def parse_bytes(spark, sf):
    from logsift.functions.parse import ACCESS_PATTERN, _JAVA

    p = keep_where(parsed(spark, sf), F.col("kind") == KIND_ACCESS)
    return p.select("line_id", F.regexp_extract("line", _JAVA + ACCESS_PATTERN, 6).alias("bytes_text"), "bytes")


@query("extract_client_ip", "2.2",
       with_ctes("SELECT line_id, referer AS context, ip FROM parsed_all WHERE kind = 'E'", "parsed_all"))
def extract_client_ip(spark, sf):
    return keep_where(parsed(spark, sf), F.col("kind") == KIND_ERROR).select(
        "line_id", F.col("referer").alias("context"), "ip"
    )


@query("level_to_status", "2.2",
       with_ctes("SELECT user_agent AS level, status, count(*) AS n FROM parsed_all WHERE kind = 'E' "
                 "GROUP BY ALL", "parsed_all"))
def level_to_status(spark, sf):
    return (
        keep_where(parsed(spark, sf), F.col("kind") == KIND_ERROR)
        .groupBy(F.col("user_agent").alias("level"), "status").agg(F.count("*").alias("n"))
    )


@query("truncate_message", "2.2", with_ctes(
    """SELECT line_id, substring(whole, 1, 100) AS message, length(substring(whole, 1, 100)) AS message_chars
    FROM (SELECT line_id, e4 || ' ' || line || line AS whole FROM groups WHERE kind = 'E')""", "groups"))
def truncate_message(spark, sf):
    """Every message is lengthened by its line, twice, so most are cut."""
    lines = clean_lines(log_lines(prepare(spark), sf))
    long = parse_all(lines.withColumn("line", F.concat("line", F.lit(" "), "line", "line")))
    return keep_where(long, F.col("kind") == KIND_ERROR).select(
        "line_id", F.col("url").alias("message"), F.length("url").alias("message_chars")
    )


# --- §2.3 enrichment -------------------------------------------------------

@query("enrich_ip_class", "2.3", with_ctes("SELECT event_id, ip, ip_class FROM log_events", "log_events"))
def enrich_ip_class(spark, sf):
    return events(spark, sf).select("event_id", "ip", "ip_class")


@query("enrich_browser", "2.3", with_ctes("SELECT event_id, user_agent, browser FROM log_events", "log_events"))
def enrich_browser(spark, sf):
    return events(spark, sf).select("event_id", "user_agent", "browser")


@query("enrich_os", "2.3", with_ctes("SELECT event_id, user_agent, os FROM log_events", "log_events"))
def enrich_os(spark, sf):
    return events(spark, sf).select("event_id", "user_agent", "os")


@query("flag_suspicious", "2.3",
       with_ctes("SELECT event_id, status, url, suspicious FROM log_events", "log_events"))
def flag_suspicious(spark, sf):
    return events(spark, sf).select("event_id", "status", "url", "suspicious")


@query("flag_attack_url", "2.3", with_ctes(f"SELECT event_id, url, {ATTACK_URL} AS attack FROM log_events", "log_events"))
def flag_attack_url(spark, sf):
    return events(spark, sf).select("event_id", "url", E.attack_url(F.col("url")).alias("attack"))


@query("flag_suspicious_line", "2.3", with_ctes("SELECT line_id, suspicious FROM line_flags", "line_flags"))
def flag_suspicious_line(spark, sf):
    lines = clean_lines(log_lines(prepare(spark), sf))
    return lines.select("line_id", E.suspicious_line(F.col("line")).alias("suspicious"))


@query("enrich_events", "2.3", with_ctes("SELECT * FROM log_events", "log_events"))
def enrich_events(spark, sf):
    return events(spark, sf)
