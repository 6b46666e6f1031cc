"""Run-comparison analytics (§2.7) over derived run records, metric samples
and per-run latencies."""

from __future__ import annotations

from pyspark.sql import functions as F

from logsift.operators import reports as R
from logsift.operators import runs as U
from logsift.plans.catalog import query
from logsift.plans.oracle import cte, with_ctes
from logsift.sources.fixtures import metric_samples, run_latency, run_records


def _r(c):
    return F.round(c, 6)


def steady(spark, sf):
    return U.steady_throughput(metric_samples(spark, sf))


def steady_cfg(spark, sf):
    return U.with_run_config(steady(spark, sf))


def lat_by_run(spark, sf):
    lat = run_latency(spark, sf)
    basic = lat.groupBy("exp_id").agg(F.count(F.lit(1)).alias("count"), _r(F.avg("latency_ms")).alias("mean"))
    q = R.grouped_quantiles(lat, "latency_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, "event_id", ["exp_id"])
    q = q.select("exp_id", *[_r(F.col(c)).alias(c) for c in ["p50", "p95", "p99"]])
    return basic.join(q, "exp_id")


@query("parse_run_id", "2.7", with_ctes(
    "SELECT exp_id, metrics_file, "
    "CAST(regexp_extract(metrics_file, 'w(\\d+)_r(\\d+)_b(\\d+)', 1) AS INTEGER) AS workers, "
    "CAST(regexp_extract(metrics_file, 'w(\\d+)_r(\\d+)_b(\\d+)', 2) AS INTEGER) AS rate, "
    "CAST(regexp_extract(metrics_file, 'w(\\d+)_r(\\d+)_b(\\d+)', 3) AS INTEGER) AS batch FROM runs", "runs"))
def parse_run_id(spark, sf):
    runs = run_records(spark, sf).select("exp_id", "metrics_file")
    return runs.withColumns(U.parse_run_id(F.col("metrics_file")))


@query("run_steady_throughput", "2.7", with_ctes(
    "SELECT exp_id, round(avg_throughput, 6) AS avg_throughput, round(max_throughput, 6) AS max_throughput "
    "FROM steady", "steady"))
def run_steady_throughput(spark, sf):
    return steady(spark, sf).select("exp_id", _r(F.col("avg_throughput")).alias("avg_throughput"),
                                    _r(F.col("max_throughput")).alias("max_throughput"))


@query("run_report", "2.7", with_ctes(
    """SELECT s.exp_id, round(s.avg_throughput, 6) AS avg_throughput, round(s.max_throughput, 6) AS max_throughput,
      round(p.avg_cpu, 6) AS avg_cpu, round(p.max_memory_mb, 6) AS max_memory_mb, p.total_alerts, p.total_events
    FROM steady s JOIN (
      SELECT exp_id, avg(cpu_percent) AS avg_cpu, max(memory_mb) AS max_memory_mb,
        arg_max(alerts_count, runtime_sec) AS total_alerts, arg_max(events_processed, runtime_sec) AS total_events
      FROM samples GROUP BY exp_id) p USING (exp_id)""", "steady", "samples"))
def run_report(spark, sf):
    r = U.run_report(metric_samples(spark, sf))
    return r.select("exp_id", *[_r(F.col(c)).alias(c) for c in ["avg_throughput", "max_throughput", "avg_cpu",
                                                                  "max_memory_mb"]],
                    F.col("total_alerts").cast("bigint").alias("total_alerts"),
                    F.col("total_events").cast("bigint").alias("total_events"))


@query("throughput_by_rate_workers", "2.7", with_ctes(
    "SELECT rate, workers, round(avg(avg_throughput), 6) AS avg_throughput FROM steady_cfg GROUP BY rate, workers",
    "steady_cfg"))
def throughput_by_rate_workers(spark, sf):
    return steady_cfg(spark, sf).groupBy("rate", "workers").agg(_r(F.avg("avg_throughput")).alias("avg_throughput"))


@query("throughput_by_batch", "2.7", with_ctes(
    "SELECT batch, round(avg(avg_throughput), 6) AS avg_throughput FROM steady_cfg GROUP BY batch", "steady_cfg"))
def throughput_by_batch(spark, sf):
    return steady_cfg(spark, sf).groupBy("batch").agg(_r(F.avg("avg_throughput")).alias("avg_throughput"))


@query("throughput_by_rate", "2.7", with_ctes(
    "SELECT rate, round(avg(avg_throughput), 6) AS avg_throughput FROM steady_cfg GROUP BY rate", "steady_cfg"))
def throughput_by_rate(spark, sf):
    return steady_cfg(spark, sf).groupBy("rate").agg(_r(F.avg("avg_throughput")).alias("avg_throughput"))


@query("run_success_counts", "2.7", with_ctes(
    "SELECT count(*) AS total_runs, count(*) FILTER (WHERE success) AS successful, "
    "count(*) FILTER (WHERE NOT success) AS failed FROM runs", "runs"))
def run_success_counts(spark, sf):
    return U.success_counts(run_records(spark, sf))


@query("latency_by_run", "2.7", with_ctes("SELECT * FROM lat_by_run", "lat_by_run"))
def latency_by_run(spark, sf):
    return lat_by_run(spark, sf)


@query("latency_tier", "2.7", with_ctes(
    "SELECT exp_id, p95, CASE WHEN p95 < 50 THEN 'Excellent' WHEN p95 < 100 THEN 'Good' "
    "WHEN p95 > 200 THEN 'Investigate' ELSE 'Fair' END AS tier "
    "FROM (SELECT exp_id, round(p95 * factor, 4) AS p95 FROM lat_by_run, (VALUES (0.5::DOUBLE), (1.0), (2.0), (4.0)) f(factor))", "lat_by_run"))
def latency_tier(spark, sf):
    """Also for runs half, twice and four times as slow, so all tiers occur."""
    slower = F.explode(F.array(*[F.lit(x) for x in (0.5, 1.0, 2.0, 4.0)]))
    runs = lat_by_run(spark, sf).select("exp_id", "p95", slower.alias("factor")).select("exp_id", F.round(F.col("p95") * F.col("factor"), 4).alias("p95"))
    return runs.withColumn("tier", U.latency_tier(F.col("p95")))


@query("speedup_efficiency", "2.7", with_ctes(
    """SELECT exp_id, workers, rate, batch, round(avg_throughput, 6) AS avg_throughput, round(baseline, 6) AS baseline,
      round(avg_throughput / baseline, 6) AS speedup, round(avg_throughput / baseline / workers, 6) AS efficiency
    FROM (SELECT *, first_value(avg_throughput) OVER (PARTITION BY rate, batch ORDER BY workers, exp_id) AS baseline
          FROM steady_cfg)""", "steady_cfg"))
def speedup_efficiency(spark, sf):
    s = U.speedup_efficiency(steady_cfg(spark, sf))
    return s.select("exp_id", "workers", "rate", "batch",
                    *[_r(F.col(c)).alias(c) for c in ["avg_throughput", "baseline", "speedup", "efficiency"]])


@query("peak_summary", "2.7", with_ctes(
    """SELECT (SELECT count(*) FROM steady) AS experiment_count,
      (SELECT round(max(avg_throughput), 6) FROM steady) AS peak_throughput,
      (SELECT exp_id FROM steady ORDER BY avg_throughput DESC, exp_id LIMIT 1) AS best_config,
      (SELECT round(avg(cpu_percent), 6) FROM samples) AS avg_cpu,
      (SELECT round(avg(memory_mb), 6) FROM samples) AS avg_memory_mb,
      (SELECT round(avg(mean), 6) FROM lat_by_run) AS avg_latency_ms,
      (SELECT round(avg(p95), 6) FROM lat_by_run) AS p95_latency_ms""", "steady", "samples", "lat_by_run"))
def peak_summary(spark, sf):
    return U.peak_summary(steady(spark, sf), metric_samples(spark, sf), lat_by_run(spark, sf))


@query("series_throughput", "2.7", with_ctes("SELECT exp_id, runtime_sec, throughput_eps FROM samples", "samples"))
def series_throughput(spark, sf):
    return metric_samples(spark, sf).select("exp_id", "runtime_sec", "throughput_eps")


@query("series_queues", "2.7", with_ctes(
    "SELECT exp_id, runtime_sec, 'ingestion_queue_size' AS queue, CAST(ingestion_queue_size AS DOUBLE) AS value "
    "FROM samples UNION ALL SELECT exp_id, runtime_sec, 'parsed_queue_size', CAST(parsed_queue_size AS DOUBLE) "
    "FROM samples", "samples"))
def series_queues(spark, sf):
    return U.unpivot_series(metric_samples(spark, sf), ["ingestion_queue_size", "parsed_queue_size"], "queue")


@query("series_resources", "2.7", with_ctes(
    "SELECT exp_id, runtime_sec, 'cpu_percent' AS resource, round(cpu_percent, 6) AS value FROM samples UNION ALL "
    "SELECT exp_id, runtime_sec, 'memory_mb', round(memory_mb, 6) FROM samples", "samples"))
def series_resources(spark, sf):
    s = U.unpivot_series(metric_samples(spark, sf), ["cpu_percent", "memory_mb"], "resource")
    return s.withColumn("value", _r(F.col("value")))
