"""Reports from one evaluation of the events: scalar subqueries, run series,
quantile sketches; the report jobs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from logsift import jobs
from logsift.functions.rows import side_by_side
from logsift.operators import reports as R
from logsift.operators import timeseries as T
from logsift.operators.alerts import alerts_event_time, alerts_flush_aligned
from logsift.session import prepare, scratch_path
from logsift.sources import io
from logsift.sources.fixtures import log_lines, metric_samples, run_records
from logsift.sources.logs import index_events, parse_events

EV = "event_id long, ip string, suspicious boolean, ingested_at timestamp, indexed_at timestamp"
T0 = 1_704_067_200_000_000


def events_of(spark, rows):
    df = spark.createDataFrame(rows, "event_id long, ip string, suspicious boolean, i long, x long")
    return df.select("event_id", "ip", "suspicious", F.timestamp_micros("i").alias("ingested_at"), F.timestamp_micros("x").alias("indexed_at"))


def test_side_by_side_is_one_row_of_subqueries(spark):
    df = spark.range(10)
    out = side_by_side(df.agg(F.sum("id").alias("a")), df.filter("id > 20").agg(F.max("id").alias("b"), F.count("id").alias("c")), df.agg(F.min("id").alias("d")))
    assert [tuple(r) for r in out.collect()] == [(45, None, 0, 0)]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_series_equal_counting(spark):
    prepare(spark)
    rnd = random.Random(5)
    rows = []
    for k in range(400):
        a = T0 + rnd.randrange(120_000_000)
        rows.append((k, "x", False, a if rnd.random() < 0.95 else None, a + rnd.randrange(9_000_000) if rnd.random() < 0.95 else None))
    alerts = [T0 + rnd.randrange(130_000_000) for _ in range(20)]
    al = spark.createDataFrame([(t,) for t in alerts], "t long").select(F.timestamp_micros("t").alias("created_at"))
    got = T.run_series(events_of(spark, rows), al).orderBy("k").collect()
    start, end = min(r[3] for r in rows if r[3]), max(r[4] for r in rows if r[4])
    assert len(got) == -(-(end - start) // 5_000_000)
    upto = lambda times, k: sum(t is not None and t <= start + k * 5_000_000 for t in times)
    for r in got:
        assert (r.arrived, r.indexed, r.alerts) == (upto([x[3] for x in rows], r.k), upto([x[4] for x in rows], r.k), upto(alerts, r.k))
    assert T.run_series(events_of(spark, rows).limit(0), al).count() == 0
    assert T.metrics_table(events_of(spark, rows[:0] or rows).limit(0), al).count() == 0


def test_sketches_of_days_merge_within_their_error(spark):
    prepare(spark)
    rnd = np.random.default_rng(3)
    ms = np.concatenate([rnd.lognormal(3, 1, 60_000), np.full(20_000, 40.0)])
    rows = [(k, "x", False, T0 + k * 5_000_000, T0 + k * 5_000_000 + int(v * 1000)) for k, v in enumerate(ms)]  # four and a half days
    ev = events_of(spark, rows)
    daily = R.latency_sketches(ev)
    assert daily.count() == 5
    got, exact = R.sketch_stats(daily).first(), np.floor(ms * 1000) / 1000
    assert got["count"] == 80_000 and got["min"] == pytest.approx(exact.min()) and got["max"] == pytest.approx(exact.max())
    assert got["mean"] == pytest.approx(exact.mean(), rel=1e-9) and got["std"] == pytest.approx(exact.std(), rel=1e-6)
    for name, p in {"median": 0.5, **R.PERCENTILES}.items():
        below, upto = (exact < got[name] - 1e-9).mean(), (exact <= got[name] + 1e-9).mean()
        assert below <= p + R.rank_error() and upto >= p - R.rank_error()
    assert all(r.within_bound for r in R.check_approx(ev, R.latency_stats_approx(ev)).collect())
    wrong = R.latency_stats_approx(ev).withColumn("p90", F.col("p99"))
    assert {r.name: r.within_bound for r in R.check_approx(ev, wrong).collect()}["p90"] is False
    none = R.latency_stats_approx(ev.limit(0)).first()
    assert none["count"] == 0 and none["p50"] is None and none["mean"] is None


def test_report_jobs(spark):
    prepare(spark)
    lines = log_lines(spark, SMALL)
    stored, alerts, out = scratch_path(spark, "rep-ev"), scratch_path(spark, "rep-al"), scratch_path(spark, "rep-out")
    ev = index_events(parse_events(lines).withColumn("indexed_at", F.col("ingested_at") + F.expr("interval 1 second")))
    io.write_events(ev, stored)
    for rule, fn in (("event", alerts_event_time), ("flush", alerts_flush_aligned)):
        jobs.batch_alerts(spark, stored, alerts, "ingested_at", rule=rule)
        assert io.read_alerts(spark, alerts).count() == fn(ev, time_col="ingested_at").count() > 0
    with pytest.raises(ValueError):
        jobs.batch_alerts(spark, stored, alerts, rule="x")
    tables = jobs.summary(spark, stored, alerts, out)
    one = tables["run_summary"].first()
    assert one.total_events == ev.count() and one.total_alerts == io.read_alerts(spark, alerts).count()
    assert spark.read.option("header", True).csv(f"{out}/top_ips").count() == tables["top_ips"].count() > 0
    jobs.metrics(spark, stored, alerts, f"{out}/metrics")
    last = spark.read.option("header", True).csv(f"{out}/metrics").agg(F.max(F.col("events_processed").cast("long")), F.max(F.col("alerts_count").cast("long"))).first()
    assert tuple(last) == (one.total_events, one.total_alerts)


def test_run_analysis_with_all_inputs(spark):
    prepare(spark)
    metrics, records = scratch_path(spark, "an-metrics"), scratch_path(spark, "an-records")
    io.write_metrics_by_run(metric_samples(spark, SMALL), metrics)
    io.write_json(run_records(spark, SMALL), records)
    tables = jobs.analyze_runs(spark, metrics, None, records)
    assert tables["run_success_counts"].first().total_runs == run_records(spark, SMALL).count()
    assert tables["series_queues"].count() == 2 * tables["series_throughput"].count() > 0


def test_rejects_are_kept_by_the_live_job(spark):
    import os

    prepare(spark)
    logs = scratch_path(spark, "rej-logs")
    os.makedirs(logs)
    with open(f"{logs}/a.log", "w") as f:
        f.write("garbage one\n[Sun Mar 07 16:02:00 2004] [error] x\n\n  garbage two \n")
    ev, al, rej = (scratch_path(spark, f"rej-{k}") for k in ("ev", "al", "out"))
    for q in jobs.ingest(spark, logs, ev, al, scratch_path(spark, "rej-ck"), rejects_path=rej):
        q.awaitTermination()
    assert sorted(r.value for r in spark.read.text(rej).collect()) == ["garbage one", "garbage two"] and io.read_events(spark, ev).count() == 1


def test_filter_on_stored_events_reaches_the_scan(spark):
    from logsift.operators.alerts import suspicious_points

    prepare(spark)
    path = scratch_path(spark, "pushed-ev")
    io.write_events(index_events(parse_events(log_lines(spark, SMALL))), path)
    stored = io.read_events(spark, path)
    scans = [suspicious_points(stored, stored=x)._jdf.queryExecution().executedPlan().toString() for x in (True, False)]
    assert "EqualTo(suspicious,true)" in scans[0] and "EqualTo(suspicious,true)" not in scans[1]
    assert suspicious_points(stored, stored=True).count() == suspicious_points(stored).count() > 0
