"""Alert queries (§2.6): sliding count, candidates, cooldown, records,
flush-aligned evaluation, breakdowns.  Clock: ``ingested_at``; flush batch 50.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from logsift.operators import alerts as A
from logsift.operators import reports as R
from logsift.plans.catalog import query
from logsift.plans.oracle import with_ctes
from logsift.plans.q_parse import events

CLOCK = "ingested_at"
FLUSH_BATCH = 50


def event_alerts(spark, sf):
    return A.alerts_event_time(events(spark, sf), time_col=CLOCK)


def events_and_alerts(spark, sf):
    """The narrow events that the reports read, materialised (one parse), and
    their alerts."""
    ev = R.report_columns(events(spark, sf))
    return ev, A.alerts_event_time(ev, time_col=CLOCK, stored=True)


def _counts(spark, sf):
    return A.sliding_count(events(spark, sf), time_col=CLOCK).select(
        "event_id", "ip", F.timestamp_micros("t_us").alias("t"), "count"
    )


@query("sliding_error_count", "2.6", with_ctes("SELECT * FROM sliding", "sliding"))
def sliding_error_count(spark, sf):
    return _counts(spark, sf)


@query("alert_candidates", "2.6", with_ctes("SELECT * FROM sliding WHERE count >= 5", "sliding"))
def alert_candidates(spark, sf):
    return _counts(spark, sf).filter(F.col("count") >= A.THRESHOLD)


@query("alerts_event_time", "2.6", with_ctes("SELECT * FROM alerts", "alerts"))
def alerts_event_time(spark, sf):
    return event_alerts(spark, sf)


@query("alert_record", "2.6", with_ctes(
    "SELECT 'HIGH_ERROR_RATE' AS alert_type, ip, count, t - INTERVAL 60 SECOND AS window_start, "
    "t AS window_end, t AS created_at FROM cand", "cand"))
def alert_record(spark, sf):
    """The alert row builder applied to every candidate (before cooldown)."""
    c = A.alert_candidates(A.sliding_count(events(spark, sf), time_col=CLOCK))
    return A.alert_records(c.groupBy("ip", "t_us").agg(F.max("count").alias("count")))


@query("flush_candidates", "2.6", with_ctes("SELECT * FROM fcand", "fcand"))
def flush_candidates(spark, sf):
    c = A.flush_candidates(events(spark, sf), time_col=CLOCK, batch=FLUSH_BATCH)
    return c.select("ip", "flush_id", F.timestamp_micros("t_us").alias("t"), "count")


@query("alerts_flush_aligned", "2.6", with_ctes("SELECT * FROM fl_alerts", "fl_alerts"))
def alerts_flush_aligned(spark, sf):
    return A.alerts_flush_aligned(events(spark, sf), time_col=CLOCK, batch=FLUSH_BATCH)


@query("alert_breakdown", "2.4", with_ctes(
    "SELECT ip, count(*) AS alert_count, max(count) AS max_errors FROM alerts GROUP BY ip "
    "ORDER BY alert_count DESC, ip LIMIT 10", "alerts"))
def alert_breakdown(spark, sf):
    return (
        event_alerts(spark, sf).groupBy("ip")
        .agg(F.count("*").alias("alert_count"), F.max("count").alias("max_errors"))
        .orderBy(F.desc("alert_count"), "ip").limit(10)
    )


@query("recent_alerts", "2.4", with_ctes(
    "SELECT * FROM alerts ORDER BY created_at DESC, ip LIMIT 20", "alerts"))
def recent_alerts(spark, sf):
    return A.recent_alerts(event_alerts(spark, sf), k=20)


@query("alert_potential", "2.5", with_ctes(
    "SELECT ip, count(*) AS candidate_events FROM sliding WHERE count >= 5 GROUP BY ip", "sliding"))
def alert_potential(spark, sf):
    return _counts(spark, sf).filter(F.col("count") >= A.THRESHOLD).groupBy("ip").agg(
        F.count("*").alias("candidate_events"))
