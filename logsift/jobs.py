"""End-to-end jobs over real paths: the entry points a user runs.

Each job is a composition of the library's operators; nothing here
computes on the driver beyond the scalar results the operators return.

* :func:`ingest` -- the live pipeline: text log files -> parse/enrich ->
  events table, and suspicious events -> stateful alerts -> alerts table.
* :func:`compact` -- finished days of the live events table in few files.
* :func:`batch_alerts` -- the alert rule over a stored events table, on a
  clock of choice.
* :func:`summary`, :func:`metrics` -- end-of-run report and metrics series of
  stored tables.
* :func:`preprocess` -- flag suspicious lines, keep all of them plus an exact
  uniform sample of the normal ones, shuffle, write a clean log.
* :func:`latency_report` -- latency statistics of an events table, optionally
  written as JSON.
* :func:`export` -- events, alerts and summary as CSV.
* :func:`analyze_runs` -- run-comparison tables from metric CSVs, run
  records and latency JSON files.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from logsift.operators import alerts as A
from logsift.operators import prep as P
from logsift.operators import reports as R
from logsift.operators import runs as U
from logsift.operators import timeseries as T
from logsift.schemas import EVENTS
from logsift.session import prepare
from logsift.sources import io
from logsift.sources.logs import parse_events, parse_rejects, scan_log_lines
from logsift.streaming import stream as S
from logsift.streaming.progress import ProgressLog


#: Input of one micro-batch of the live pipeline, unless files are limited instead.
MAX_BYTES_PER_TRIGGER = "64g"
#: Event columns that the batch alert rule can run on.
CLOCKS = ("timestamp", "ingested_at", "indexed_at")


def ingest(
    spark: SparkSession,
    logs_path: str,
    events_path: str,
    alerts_path: str,
    checkpoint: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str = MAX_BYTES_PER_TRIGGER,
    lateness: str = "10 minutes",
    progress_path: str | None = None,
    rejects_path: str | None = None,
) -> tuple[StreamingQuery, ...]:
    """The live pipeline on a folder of log files, which may grow.

    Two chained streaming queries: lines -> parse/enrich -> events table
    (days of ``indexed_at`` as partitions; each event has its own arrival and
    index time, and an id made of file and byte); then the events table, read
    as a stream through its manifest, -> stateful alerts on ``indexed_at`` ->
    alerts table.  A batch that fails and is run again leaves nothing behind in
    either table.  With ``available_now`` the input present now is processed
    and both queries stop (the second starts when the first ends), and a last
    line without a line end is taken as it is.  A micro-batch takes
    ``max_bytes_per_trigger`` of input, or ``max_files_per_trigger`` files if
    that is given.  ``progress_path``: table of a row per micro-batch of each
    query.  ``rejects_path``: text files of the lines that match no format, by
    a third query over the same files (the last one returned).
    """
    prepare(spark)
    log = ProgressLog(spark, progress_path) if progress_path else None

    def lines(state: str) -> DataFrame:
        return S.stream_log_source(spark, logs_path, fmt="tail", max_files_per_trigger=max_files_per_trigger,
                                   max_bytes_per_trigger=None if max_files_per_trigger else max_bytes_per_trigger,
                                   state=f"{checkpoint}/{state}", unfinished=available_now)

    events = S.stream_index(parse_events(lines("tail")), clock="ingested_at")
    q_events = S.start_events_sink(events, events_path, f"{checkpoint}/events")
    if available_now:
        S.finish(q_events)
    schema = StructType(EVENTS.fields + [StructField("date", DateType())])
    stored = spark.readStream.schema(schema).parquet(events_path)
    alerts = S.stream_alerts(stored, time_col="indexed_at", lateness=lateness)
    q_alerts = S.start_parquet_sink(alerts, alerts_path, f"{checkpoint}/alerts", available_now=available_now)
    queries = [q_events, q_alerts]
    if rejects_path:
        rejects = parse_rejects(lines("tail-rejects")).select(F.col("line").alias("value"))
        queries.append(rejects.writeStream.format("text").option("path", rejects_path).option("checkpointLocation", f"{checkpoint}/rejects").start())
        if available_now:
            S.finish(queries[-1])
    if log and available_now:
        q_alerts.awaitTermination()
        for q in queries:
            log.wait(q)
        log.stop()
    return tuple(queries)


def compact(spark: SparkSession, events_path: str, archive_path: str, before: str) -> None:
    """Copy the days before ``before`` of a live events table, which many
    micro-batches wrote as many small files, into files of the advisory
    partition size under ``archive_path``.

    Days are replaced as a whole, so the job can be run again; a large day is
    split over as many tasks as it has files' worth of rows.  Read the rest of
    the live table with ``io.read_events(..., start=before)``.
    """
    prepare(spark)
    days = io.read_events(spark, events_path, end=before).filter(F.col("indexed_at") < F.lit(before).cast("date"))
    (days.withColumn("date", F.to_date("indexed_at")).hint("rebalance", "date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(archive_path))


#: The alert rules: checked at every suspicious event, or at every full flush
#: of a batch of events, as the batching indexer does.
RULES = {"event": partial(A.alerts_event_time, stored=True), "flush": A.alerts_flush_aligned}


def batch_alerts(spark: SparkSession, events_path: str, alerts_path: str, clock: str = "timestamp",
                 start: str | None = None, end: str | None = None, rule: str = "event") -> None:
    """Alerts of a stored events table, written to ``alerts_path`` (replaced).

    ``clock`` is the event column that the window and the cooldown run on:
    ``timestamp`` (log time), ``ingested_at`` or ``indexed_at``.  ``start`` and
    ``end`` restrict ``indexed_at`` and prune the table's partitions.  ``rule``
    is one of :data:`RULES`.
    """
    if clock not in CLOCKS:
        raise ValueError(f"clock must be one of {', '.join(CLOCKS)}")
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    prepare(spark)
    events = io.read_events(spark, events_path, start, end)
    io.write_alerts(RULES[rule](events, time_col=clock), alerts_path, mode="overwrite")


def summary(spark: SparkSession, events_path: str, alerts_path: str, out_dir: str | None = None) -> dict[str, DataFrame]:
    """The end-of-run report: ``run_summary`` (one row), ``top_status`` (10),
    ``top_ips`` (50) and ``alert_breakdown`` (the 10 addresses with most
    alerts); each written as CSV below ``out_dir`` if given."""
    prepare(spark)
    events, alerts = io.read_events(spark, events_path), io.read_alerts(spark, alerts_path)
    out = {
        "run_summary": R.run_summary(events, alerts),
        "top_status": R.top_counts(events, "status", 10),
        "top_ips": R.top_counts(events, "ip", 50),
        "alert_breakdown": alerts.groupBy("ip").agg(F.count(F.lit(1)).alias("alert_count"), F.max("count").alias("max_errors"))
        .orderBy(F.desc("alert_count"), "ip").limit(10),
    }
    for name, df in out.items() if out_dir else ():
        io.export_csv(df, f"{out_dir}/{name}")
    return out


def metrics(spark: SparkSession, events_path: str, alerts_path: str, out_path: str, interval_sec: int = T.INTERVAL_SEC) -> None:
    """The metrics series of a stored run (a row per interval), as CSV."""
    prepare(spark)
    io.export_csv(T.metrics_table(io.read_events(spark, events_path), io.read_alerts(spark, alerts_path), interval_sec), out_path)


def preprocess(spark: SparkSession, logs_path: str, out_path: str, sample: int = 0, seed: str = P.SEED) -> dict:
    """Clean log for replay: every suspicious line plus exactly ``sample``
    normal lines (all of them when ``sample`` is 0 or too large), in a
    reproducible random order.  Returns the line-class statistics."""
    lines = scan_log_lines(spark, logs_path, lenient=True)
    keyed = lines.withColumn("line_id", F.monotonically_increasing_id())  # unique in a batch read
    flagged = P.flag_lines(keyed)
    stats = P.line_class_stats(flagged).collect()[0].asDict()
    kept = P.sample_normal_keep_suspicious(flagged, sample, seed=seed)
    io.write_lines(P.random_order(kept.select("line_id", "line"), seed=seed), out_path)
    return stats


def latency_report(spark: SparkSession, events_path: str, out_path: str | None = None) -> DataFrame:
    """Latency statistics (ms) of an events table; written as JSON when
    ``out_path`` is given."""
    stats = R.latency_stats(io.read_events(spark, events_path))
    if out_path:
        io.write_json(stats, out_path)
    return stats


def export(spark: SparkSession, events_path: str, alerts_path: str, out_dir: str, limit: int = 0) -> None:
    """``events``, ``alerts`` (newest first) and ``summary`` CSV folders."""
    events = io.read_events(spark, events_path)
    io.export_events_csv(events, f"{out_dir}/events", limit)
    io.export_csv(A.recent_alerts(io.read_alerts(spark, alerts_path)), f"{out_dir}/alerts")
    io.export_csv(R.export_summary(events), f"{out_dir}/summary")


def analyze_runs(spark: SparkSession, metrics_path: str, latency_path: str | None = None, records_path: str | None = None) -> dict[str, DataFrame]:
    """Run-comparison tables from a folder of per-run metric CSVs (run id in
    the path) and, optionally, per-run latency JSON files and run records:
    reports and comparisons, the series behind the plots (``series_*``), and
    with the optional inputs latency tiers, the peak summary and the success
    counts."""
    samples = io.scan_metrics(spark, metrics_path).withColumn(
        "sample_id", F.unix_micros("timestamp")  # tie-break within a run: sample time
    )
    report = U.run_report(samples)
    steady = U.with_run_config(U.steady_throughput(samples))
    out = {
        "run_report": report,
        "throughput_by_rate_workers": steady.groupBy("rate", "workers").agg(F.avg("avg_throughput").alias("avg_throughput")),
        "throughput_by_batch": steady.groupBy("batch").agg(F.avg("avg_throughput").alias("avg_throughput")),
        "throughput_by_rate": steady.groupBy("rate").agg(F.avg("avg_throughput").alias("avg_throughput")),
        "speedup_efficiency": U.speedup_efficiency(steady),
        "series_throughput": samples.select("exp_id", "runtime_sec", "throughput_eps"),
        "series_queues": U.unpivot_series(samples, ["ingestion_queue_size", "parsed_queue_size"], "queue"),
        "series_resources": U.unpivot_series(samples, ["cpu_percent", "memory_mb"], "resource"),
    }
    if latency_path:
        lat = io.scan_latency_json(spark, latency_path)
        out["latency_tier"] = lat.withColumn("tier", U.latency_tier(F.col("p95")))
        out["peak_summary"] = U.peak_summary(steady, samples, lat)
    if records_path:
        out["run_success_counts"] = U.success_counts(io.scan_run_records(spark, records_path))
    return out
