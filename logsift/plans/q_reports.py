"""Reports (§2.4, §2.5), log preparation (§2.4) and run time series (§2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from logsift.operators import prep as P
from logsift.operators import reports as R
from logsift.operators import timeseries as T
from logsift.functions.rows import keep_where, side_by_side
from logsift.plans.catalog import query
from logsift.plans.oracle import cte, with_ctes
from logsift.plans.q_alerts import events_and_alerts
from logsift.plans.q_parse import events
from logsift.session import prepare
from logsift.sources.fixtures import log_lines
from logsift.sources.logs import clean_lines

SAMPLE_NORMAL = 2000
EVENTS_LIMIT = 100
_LAT = "(epoch_us(indexed_at) - epoch_us(ingested_at)) / 1000.0"


def flagged_lines(spark, sf):
    return P.flag_lines(clean_lines(log_lines(prepare(spark), sf)))


# --- §2.4 filters, top-k, limits -------------------------------------------

@query("filter_suspicious", "2.4", with_ctes("SELECT * FROM log_events WHERE suspicious", "log_events"))
def filter_suspicious(spark, sf):
    return keep_where(events(spark, sf), F.col("suspicious"))


@query("filter_latency_known", "2.4", with_ctes(
    f"""SELECT event_id, round({_LAT}, 6) AS latency_ms FROM (SELECT event_id,
      CASE WHEN event_id % 7 <> 3 THEN ingested_at END AS ingested_at, CASE WHEN event_id % 11 <> 5 THEN indexed_at END AS indexed_at
      FROM log_events) WHERE indexed_at IS NOT NULL AND ingested_at IS NOT NULL""", "log_events"))
def filter_latency_known(spark, sf):
    """One or the other time of every seventh and eleventh event is unknown."""
    eid = F.col("event_id")
    ev = events(spark, sf).withColumns({
        "ingested_at": F.when(eid % 7 != 3, F.col("ingested_at")), "indexed_at": F.when(eid % 11 != 5, F.col("indexed_at"))})
    return R.known_latency(ev).select("event_id", F.round("latency_ms", 6).alias("latency_ms"))


@query("top_status", "2.4", with_ctes(
    "SELECT status, count(*) AS cnt FROM log_events GROUP BY status ORDER BY cnt DESC, status LIMIT 10", "log_events"))
def top_status(spark, sf):
    return R.top_counts(events(spark, sf), "status", 10)


@query("top_ips", "2.4", with_ctes(
    "SELECT ip, count(*) AS cnt FROM log_events GROUP BY ip ORDER BY cnt DESC, ip LIMIT 50", "log_events"))
def top_ips(spark, sf):
    return R.top_counts(events(spark, sf), "ip", 50)


@query("events_limit", "2.4", with_ctes(
    f"SELECT * FROM log_events ORDER BY indexed_at, event_id LIMIT {EVENTS_LIMIT}", "log_events"))
def events_limit(spark, sf):
    return events(spark, sf).orderBy("indexed_at", "event_id").limit(EVENTS_LIMIT)


@query("partition_lines", "2.4", with_ctes(
    "SELECT line_id, CASE WHEN suspicious THEN 'suspicious' ELSE 'normal' END AS line_class FROM line_flags",
    "line_flags"))
def partition_lines(spark, sf):
    return flagged_lines(spark, sf).select(
        "line_id", F.when(F.col("suspicious"), "suspicious").otherwise("normal").alias("line_class")
    )


@query("union_all_lines", "2.4", with_ctes(
    "SELECT line_id, line FROM line_flags WHERE suspicious UNION ALL "
    "SELECT line_id, line FROM line_flags WHERE NOT suspicious", "line_flags"))
def union_all_lines(spark, sf):
    f = flagged_lines(spark, sf)
    return keep_where(f, F.col("suspicious")).select("line_id", "line").unionByName(
        keep_where(f, ~F.col("suspicious")).select("line_id", "line"))


_MD5 = "md5('42' || CAST(line_id AS VARCHAR))"


@query("sample_normal_keep_suspicious", "2.4", with_ctes(
    f"SELECT line_id, line FROM line_flags WHERE suspicious UNION ALL "
    f"(SELECT line_id, line FROM line_flags WHERE NOT suspicious ORDER BY {_MD5}, line_id LIMIT {SAMPLE_NORMAL})",
    "line_flags"))
def sample_normal_keep_suspicious(spark, sf):
    return P.sample_normal_keep_suspicious(flagged_lines(spark, sf), SAMPLE_NORMAL).select("line_id", "line")


@query("shuffle_lines", "2.4", with_ctes(
    f"SELECT row_number() OVER (ORDER BY {_MD5}, line_id) AS position, line_id, line FROM line_flags", "line_flags"))
def shuffle_lines(spark, sf):
    return P.shuffle_lines(clean_lines(log_lines(prepare(spark), sf))).select("position", "line_id", "line")


# --- §2.5 aggregations ------------------------------------------------------

@query("status_counts", "2.5", with_ctes("SELECT status, count(*) AS cnt FROM log_events GROUP BY status", "log_events"))
def status_counts(spark, sf):
    return events(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("cnt"))


@query("total_counts", "2.5", with_ctes(
    "SELECT (SELECT count(*) FROM log_events) AS total_events, (SELECT count(*) FROM alerts) AS total_alerts",
    "log_events", "alerts"))
def total_counts(spark, sf):
    ev, alerts = events_and_alerts(spark, sf)
    return side_by_side(ev.agg(F.count(F.lit(1)).alias("total_events")), alerts.agg(F.count(F.lit(1)).alias("total_alerts")))


_RUNTIME = "((epoch_us(max(indexed_at)) - epoch_us(min(ingested_at))) / 1e6)"


@query("run_summary", "2.5", with_ctes(
    f"""SELECT count(*) AS total_events, count(*) FILTER (WHERE suspicious) AS suspicious_events,
      round(CAST(count(*) FILTER (WHERE suspicious) AS DOUBLE) * 100.0 / count(*), 6) AS suspicious_pct,
      (SELECT count(*) FROM alerts) AS total_alerts,
      round({_RUNTIME}, 6) AS runtime_sec,
      round(CAST(count(*) AS DOUBLE) / {_RUNTIME}, 6) AS throughput_eps
    FROM log_events""", "log_events", "alerts"))
def run_summary(spark, sf):
    return R.run_summary(*events_and_alerts(spark, sf))


@query("latency_avg_min_max", "2.5", with_ctes(
    f"SELECT round(avg({_LAT}), 6) AS avg_latency_ms, round(min({_LAT}), 6) AS min_latency_ms, "
    f"round(max({_LAT}), 6) AS max_latency_ms FROM log_events WHERE indexed_at IS NOT NULL", "log_events"))
def latency_avg_min_max(spark, sf):
    return R.latency_avg_min_max(events(spark, sf))


cte("lat", ["log_events"], f"SELECT event_id, {_LAT} AS x FROM log_events "
                           "WHERE indexed_at IS NOT NULL AND ingested_at IS NOT NULL")


@query("latency_stats", "2.5", with_ctes(
    """SELECT count(*) AS count, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.5), 6) AS median,
      round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max,
      round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.9), 6) AS p90,
      round(quantile_cont(x, 0.95), 6) AS p95, round(quantile_cont(x, 0.99), 6) AS p99 FROM lat""", "lat"))
def latency_stats(spark, sf):
    return R.latency_stats(events(spark, sf))


_EPS = R.rank_error(R.SKETCH_K)


@query("latency_stats_approx", "2.5", with_ctes(
    f"""SELECT s.name, s.p, (SELECT count(*) FROM lat) AS count, true AS within_bound,
      (SELECT round(avg(x), 6) FROM lat) AS mean, (SELECT round(min(x), 6) FROM lat) AS min, (SELECT round(max(x), 6) FROM lat) AS max
    FROM (VALUES ('median', 0.5::DOUBLE), ('p50', 0.5), ('p90', 0.9), ('p95', 0.95), ('p99', 0.99)) s(name, p)""", "lat"))
def latency_stats_approx(spark, sf):
    """Statistics from daily sketches; each quantile's rank, counted in the
    events themselves, must be within the sketch's stated error."""
    ev = R.report_columns(events(spark, sf))
    return R.check_approx(ev, R.latency_stats_approx(ev))


@query("line_class_stats", "2.5", with_ctes(
    """SELECT count(*) AS total_lines, count(*) FILTER (WHERE NOT suspicious) AS normal_lines,
      count(*) FILTER (WHERE suspicious) AS suspicious_lines,
      round(CAST(count(*) FILTER (WHERE suspicious) AS DOUBLE) * 100.0 / count(*), 6) AS suspicious_pct
    FROM line_flags""", "line_flags"))
def line_class_stats(spark, sf):
    return P.line_class_stats(flagged_lines(spark, sf))


# --- §2.6 run time series ---------------------------------------------------

cte("grid", ["log_events"], """
SELECT g.range AS k, b.s FROM (SELECT epoch_us(min(ingested_at)) AS s, epoch_us(max(indexed_at)) AS e FROM log_events) b,
  range(1, greatest(1, (b.e - b.s + 4999999) // 5000000) + 1) g
""")


def _series(name: str, deltas: str) -> str:
    return f"""
SELECT g.k, make_timestamp(g.s + g.k * 5000000) AS timestamp, CAST(g.k * 5 AS DOUBLE) AS runtime_sec,
  CAST(sum(coalesce(d.d, 0)) OVER (ORDER BY g.k) AS BIGINT) AS {name}
FROM grid g LEFT JOIN (
  SELECT greatest(1, (epoch_us(t) - s + 4999999) // 5000000) AS k, sum(v) AS d
  FROM ({deltas}) x, (SELECT DISTINCT s FROM grid) gs GROUP BY 1
) d ON d.k = g.k
"""


cte("ts_events", ["grid"], _series("events_processed", "SELECT indexed_at AS t, 1 AS v FROM log_events"))


@query("metrics_timeseries", "2.6", with_ctes(
    "SELECT k, timestamp, runtime_sec, events_processed, round(events_processed / runtime_sec, 6) AS throughput_eps "
    "FROM ts_events", "ts_events"))
def metrics_timeseries(spark, sf):
    return T.metrics_timeseries(events(spark, sf))


cte("ts_backlog", ["grid"], _series(
    "queue_size", "SELECT ingested_at AS t, 1 AS v FROM log_events UNION ALL SELECT indexed_at, -1 FROM log_events"))


@query("backlog_timeseries", "2.6", with_ctes("SELECT * FROM ts_backlog", "ts_backlog"))
def backlog_timeseries(spark, sf):
    return T.backlog_timeseries(events(spark, sf))


cte("ts_alerts", ["grid", "alerts"], _series("alerts_count", "SELECT created_at AS t, 1 AS v FROM alerts"))


@query("alerts_cumulative", "2.6", with_ctes("SELECT * FROM ts_alerts", "ts_alerts"))
def alerts_cumulative(spark, sf):
    return T.alerts_cumulative(*events_and_alerts(spark, sf))
