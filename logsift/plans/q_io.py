"""Sources and sinks (§2.1): every query writes data derived from the input
tables to a fresh folder below the session's checkpoint folder and returns
what the matching reader reads back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from logsift.operators import prep as P
from logsift.operators import reports as R
from logsift.operators import timeseries as T
from logsift.plans.catalog import query
from logsift.plans.oracle import with_ctes
from logsift.plans.q_alerts import event_alerts, events_and_alerts
from logsift.plans.q_parse import events
from logsift.plans.q_reports import SAMPLE_NORMAL, _MD5, flagged_lines
from logsift.plans.q_runs import lat_by_run
from logsift.schemas import ALERTS, EVENTS, LATENCY, METRICS
from logsift.session import prepare, scratch_path
from logsift.sources import io
from logsift.sources.fixtures import log_lines, metric_samples, run_records
from logsift.sources.logs import scan_log_lines as read_log_files


@query("scan_log_lines", "2.1", with_ctes("SELECT line FROM clean_lines", "clean_lines"))
def scan_log_lines(spark, sf):
    path = scratch_path(spark, "raw-log")
    io.write_lines(log_lines(prepare(spark), sf), path)
    return read_log_files(spark, path).select("line")


@query("events_table", "2.1", with_ctes("SELECT * FROM log_events", "log_events"))
def events_table(spark, sf):
    path = scratch_path(spark, "events")
    io.write_events(events(spark, sf), path)
    return io.read_events(spark, path)


@query("alerts_table", "2.1", with_ctes("SELECT * FROM alerts", "alerts"))
def alerts_table(spark, sf):
    path = scratch_path(spark, "alerts")
    io.write_alerts(event_alerts(spark, sf), path)
    return io.read_alerts(spark, path)


@query("sink_clean_log", "2.1", with_ctes(
    f"SELECT line FROM line_flags WHERE suspicious UNION ALL "
    f"(SELECT line FROM line_flags WHERE NOT suspicious ORDER BY {_MD5}, line_id LIMIT {SAMPLE_NORMAL})",
    "line_flags"))
def sink_clean_log(spark, sf):
    """The log sampler's output file: all suspicious + sampled normal lines,
    shuffled, written as text, read back."""
    kept = P.sample_normal_keep_suspicious(flagged_lines(spark, sf), SAMPLE_NORMAL)
    path = scratch_path(spark, "clean-log")
    io.write_lines(P.random_order(kept), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("export_events_csv", "2.1", with_ctes(
    "SELECT * EXCLUDE (suspicious), CAST(suspicious AS INTEGER) AS suspicious FROM log_events", "log_events"))
def export_events_csv(spark, sf):
    path = scratch_path(spark, "events-csv")
    io.export_events_csv(events(spark, sf), path)  # whole table (limit 0)
    schema = StructType([StructField(f.name, IntegerType() if f.name == "suspicious" else f.dataType)
                         for f in EVENTS.fields])
    return io.read_csv(spark, path, schema)


@query("export_alerts_csv", "2.1", with_ctes("SELECT * FROM alerts", "alerts"))
def export_alerts_csv(spark, sf):
    path = scratch_path(spark, "alerts-csv")
    io.export_csv(event_alerts(spark, sf).orderBy(F.desc("created_at"), "ip"), path)
    return io.read_csv(spark, path, ALERTS)


@query("export_summary", "2.1", with_ctes(
    """SELECT 'Total Events' AS section, '' AS key, count(*) AS value FROM log_events
    UNION ALL (SELECT 'Status', CAST(status AS VARCHAR), count(*) AS c FROM log_events GROUP BY status
               ORDER BY c DESC, status LIMIT 10)
    UNION ALL (SELECT 'Top IP', ip, count(*) AS c FROM log_events GROUP BY ip ORDER BY c DESC, ip LIMIT 50)""",
    "log_events"))
def export_summary(spark, sf):
    path = scratch_path(spark, "summary-csv")
    io.export_csv(R.export_summary(events(spark, sf)), path)
    return io.read_csv(spark, path, "section string, key string, value bigint")


@query("scan_metrics", "2.1", with_ctes(
    "SELECT exp_id, timestamp, runtime_sec, events_processed, ingestion_queue_size, parsed_queue_size, "
    "cpu_percent, memory_mb, throughput_eps, alerts_count FROM samples", "samples"))
def scan_metrics(spark, sf):
    path = scratch_path(spark, "metrics")
    io.write_metrics_by_run(metric_samples(spark, sf), path)
    return io.scan_metrics(spark, path)


@query("scan_run_records", "2.1", with_ctes("SELECT * FROM runs", "runs"))
def scan_run_records(spark, sf):
    path = scratch_path(spark, "runs-json")
    io.write_json(run_records(spark, sf), path)
    return io.scan_run_records(spark, path)


@query("scan_latency_json", "2.1", with_ctes("SELECT * FROM lat_by_run", "lat_by_run"))
def scan_latency_json(spark, sf):
    path = scratch_path(spark, "latency-json")
    io.write_json(lat_by_run(spark, sf), path, partition_by="exp_id")
    return io.scan_latency_json(spark, path).select("exp_id", "count", "mean", "p50", "p95", "p99")


@query("sink_latency_json", "2.1", with_ctes(
    """SELECT count(*) AS count, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.5), 6) AS median,
      round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max,
      round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.9), 6) AS p90,
      round(quantile_cont(x, 0.95), 6) AS p95, round(quantile_cont(x, 0.99), 6) AS p99 FROM lat""", "lat"))
def sink_latency_json(spark, sf):
    path = scratch_path(spark, "latency-stats")
    io.write_json(R.latency_stats(events(spark, sf)).coalesce(1), path)
    return spark.read.schema(LATENCY).json(path)


@query("metrics_sink", "2.1", with_ctes(
    """SELECT e.timestamp, e.runtime_sec, e.events_processed, b.queue_size AS ingestion_queue_size,
      CAST(NULL AS BIGINT) AS parsed_queue_size, CAST(NULL AS DOUBLE) AS cpu_percent, CAST(NULL AS DOUBLE) AS memory_mb,
      round(e.events_processed / e.runtime_sec, 6) AS throughput_eps, a.alerts_count
    FROM ts_events e JOIN ts_backlog b USING (k) JOIN ts_alerts a USING (k)""", "ts_events", "ts_backlog", "ts_alerts"))
def metrics_sink(spark, sf):
    ev, alerts = events_and_alerts(spark, sf)
    path = scratch_path(spark, "metrics-csv")
    io.export_csv(T.metrics_table(ev, alerts), path)
    return io.read_csv(spark, path, METRICS)
