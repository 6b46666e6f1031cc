"""End-to-end jobs on files derived from the test tables: raw log files ->
live pipeline -> events/alerts tables -> latency, exports; the log sampler;
run analysis from metric CSVs.  Results are compared with the batch
operators on the same data."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from logsift import jobs
from logsift.operators.alerts import alerts_event_time
from logsift.operators import prep
from logsift.operators.prep import flag_lines, line_class_stats
from logsift.session import prepare, scratch_path
from logsift.sources import io
from logsift.sources.fixtures import log_lines, metric_samples
from logsift.sources.logs import parse_events, scan_log_lines


def _log_files(spark):
    folder = scratch_path(spark, "raw-logs")
    io.write_lines(log_lines(prepare(spark), SMALL).repartition(3), folder)
    return folder


def test_ingest_latency_export(spark):
    logs = _log_files(spark)
    ev_path, al_path = scratch_path(spark, "ev"), scratch_path(spark, "al")
    q_ev, q_al = jobs.ingest(spark, logs, ev_path, al_path, scratch_path(spark, "ck"), max_files_per_trigger=1)
    q_al.awaitTermination()
    assert q_ev.exception() is None and q_al.exception() is None
    stored = io.read_events(spark, ev_path)
    expect = parse_events(scan_log_lines(spark, logs))
    assert stored.count() == expect.count() > 0
    assert stored.select("event_id").distinct().count() == stored.count()
    # alerts follow the batch rule on the stored indexing clock
    got = sorted((r["ip"], r["created_at"]) for r in io.read_alerts(spark, al_path).collect())
    batch = sorted((r["ip"], r["created_at"]) for r in alerts_event_time(stored).collect())
    assert got == batch
    again = scratch_path(spark, "al-batch")
    for clock in jobs.CLOCKS:  # the stored table again, by the batch job
        jobs.batch_alerts(spark, ev_path, again, clock)
        rule = alerts_event_time(stored, time_col=clock)
        assert sorted(map(str, io.read_alerts(spark, again).select(rule.columns).collect())) == sorted(map(str, rule.collect()))
    with pytest.raises(ValueError):
        jobs.batch_alerts(spark, ev_path, again, "ip")
    lat = jobs.latency_report(spark, ev_path).collect()[0]
    assert lat["count"] == stored.count()
    out = scratch_path(spark, "export")
    jobs.export(spark, ev_path, al_path, out, limit=10)
    assert spark.read.option("header", True).csv(f"{out}/events").count() == 10
    assert spark.read.option("header", True).csv(f"{out}/alerts").count() == len(got)


def test_preprocess_sample(spark):
    logs = _log_files(spark)
    out = scratch_path(spark, "clean")
    stats = jobs.preprocess(spark, logs, out, sample=100)
    expect = line_class_stats(flag_lines(scan_log_lines(spark, logs))).collect()[0].asDict()
    assert stats == expect
    kept = spark.read.text(out).count()
    assert kept == stats["suspicious_lines"] + min(100, stats["normal_lines"])


def test_sampled_lines_are_mixed_throughout(spark):
    """Every tenth of the output holds its share of the sampled lines."""
    flagged = spark.range(20_000).select(F.col("id").alias("line_id"), F.lit("x").alias("line"), (F.col("id") % 4 == 0).alias("suspicious"))
    kept = prep.sample_normal_keep_suspicious(flagged, 5000)
    rows = prep.random_order(kept).collect()
    assert len(rows) == 10_000
    for k in range(10):
        share = sum(not r["suspicious"] for r in rows[k * 1000 : (k + 1) * 1000])
        assert 420 < share < 580


def test_analyze_runs_from_csv(spark):
    path = scratch_path(spark, "metrics")
    io.write_metrics_by_run(metric_samples(spark, SMALL), path)
    tables = jobs.analyze_runs(spark, path)
    report = tables["run_report"]
    assert report.count() == metric_samples(spark, SMALL).select("exp_id").distinct().count()
    assert report.filter(F.col("avg_throughput").isNull()).count() == 0
    assert json.dumps(tables["speedup_efficiency"].first().asDict(), default=str)
    assert os.path.basename(path)
