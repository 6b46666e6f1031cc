"""Sampled time series of a run: events indexed so far, throughput, backlog,
alerts so far -- the data the metrics collector writes every interval.

Each series is "count of things with time <= sample time" on a fixed grid
(start + k * interval).  All series of a run come from one narrow table: each
event gives a step of +1 to the arrived and to the indexed series, each alert
one to the alerts; steps are added up per sample (map-side first), the grid
(one row per sample, bounded by run length / interval, not by data volume) is
left-joined so empty intervals appear, and one range-partitioned numbering
accumulates all series at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.operators.sequence import number_rows
from logsift.session import checkpoint_dir

INTERVAL_SEC = 5
_US = 1_000_000


def _bucket(t: Column, start_us: int, interval_us: int) -> Column:
    """Index k >= 1 of the first sample time >= t (times before start -> 1;
    null for a null time)."""
    d = F.unix_micros(t) - F.lit(start_us)
    k = F.floor((d + F.lit(interval_us - 1)) / F.lit(interval_us)).cast("bigint")
    return F.when(t.isNotNull(), F.greatest(k, F.lit(1)))


def event_times(events: DataFrame) -> DataFrame:
    """The two times of every event, materialised: all that the series read,
    so that the events (a parse, perhaps) are evaluated once."""
    checkpoint_dir(events.sparkSession)
    return events.select("ingested_at", "indexed_at").checkpoint(eager=True)


SERIES = ("arrived", "indexed", "alerts")


def run_series(events: DataFrame, alerts: DataFrame | None = None, interval_sec: int = INTERVAL_SEC) -> DataFrame:
    """Per sample ``k``: ``timestamp``, ``runtime_sec`` and how many events had
    ``arrived`` and were ``indexed``, and how many ``alerts`` were raised so far.

    The grid runs from the first arrival to the last index time; no events, no
    samples.  Times before the first sample count there; a null time counts
    nowhere.
    """
    spark = events.sparkSession
    times = event_times(events)
    ends = times.agg(F.unix_micros(F.min("ingested_at")).alias("s"), F.unix_micros(F.max("indexed_at")).alias("e")).first()
    empty = "k bigint, timestamp timestamp, runtime_sec double, arrived bigint, indexed bigint, alerts bigint"
    if ends["s"] is None:
        return spark.createDataFrame([], empty)
    start, iv = ends["s"], interval_sec * _US
    samples = max(1, -(-((ends["e"] if ends["e"] is not None else start) - start) // iv))

    def step(t: str, series: str) -> Column:
        return F.struct(_bucket(F.col(t), start, iv).alias("k"), *[F.lit(int(s == series)).alias(s) for s in SERIES])

    steps = times.select(F.explode(F.array(step("ingested_at", "arrived"), step("indexed_at", "indexed"))).alias("s")).select("s.*")
    if alerts is not None:
        steps = steps.unionByName(alerts.select(step("created_at", "alerts").alias("s")).select("s.*"))
    per = steps.filter("k is not null").groupBy("k").agg(*[F.sum(s).alias(s) for s in SERIES])
    grid = spark.range(1, samples + 1).select(F.col("id").alias("k"))
    filled = grid.join(per, "k", "left").fillna(0, list(SERIES))
    out = number_rows(filled.withColumnsRenamed({s: f"d_{s}" for s in SERIES}), order=["k"], sums={s: F.col(f"d_{s}") for s in SERIES})
    return out.select("k", F.timestamp_micros(F.lit(start) + F.col("k") * F.lit(iv)).alias("timestamp"),
                      (F.col("k") * interval_sec).cast("double").alias("runtime_sec"), *SERIES)


def _throughput() -> Column:
    return F.round(F.col("indexed") / F.col("runtime_sec"), 6).alias("throughput_eps")


def metrics_timeseries(events: DataFrame, interval_sec: int = INTERVAL_SEC) -> DataFrame:
    """Per sample: events indexed so far and throughput (events / runtime)."""
    return run_series(events, None, interval_sec).select("k", "timestamp", "runtime_sec", F.col("indexed").alias("events_processed"), _throughput())


def backlog_timeseries(events: DataFrame, interval_sec: int = INTERVAL_SEC) -> DataFrame:
    """Per sample: events that arrived but were not yet indexed."""
    return run_series(events, None, interval_sec).select("k", "timestamp", "runtime_sec", (F.col("arrived") - F.col("indexed")).alias("queue_size"))


def alerts_cumulative(events: DataFrame, alerts: DataFrame, interval_sec: int = INTERVAL_SEC) -> DataFrame:
    """Per sample: alerts raised so far (grid of the events' run)."""
    return run_series(events, alerts, interval_sec).select("k", "timestamp", "runtime_sec", F.col("alerts").alias("alerts_count"))


def metrics_table(events: DataFrame, alerts: DataFrame, interval_sec: int = INTERVAL_SEC) -> DataFrame:
    """The rows that a live run writes every interval, rebuilt from the tables.
    The parsed queue and the host's CPU and memory are not in the tables and
    stay null."""
    return run_series(events, alerts, interval_sec).select(
        "timestamp", "runtime_sec", F.col("indexed").alias("events_processed"), (F.col("arrived") - F.col("indexed")).alias("ingestion_queue_size"),
        F.lit(None).cast("bigint").alias("parsed_queue_size"), F.lit(None).cast("double").alias("cpu_percent"),
        F.lit(None).cast("double").alias("memory_mb"), _throughput(), F.col("alerts").alias("alerts_count"))
