"""Streaming queries (§2.1 source, §2.6 live job): the derived lines are
replayed as files in time order; each query runs its streaming job to the
end of the input (``availableNow``) and returns what its sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from logsift.plans.catalog import query
from logsift.plans.oracle import with_ctes
from logsift.session import prepare, scratch_path
from logsift.sources import io
from logsift.sources.fixtures import log_lines
from logsift.streaming import stream as S
from logsift.streaming.progress import ProgressLog, read_progress

REPLAY_CHUNKS = 4
EVENT_COLS = ["event_id", "ip", "timestamp", "method", "url", "status", "bytes", "referer", "user_agent",
              "browser", "os", "ip_class", "suspicious", "ingested_at"]

_CHUNK = f"""coalesce(least(greatest(line_id // ((SELECT max(event_id) FROM events) // {REPLAY_CHUNKS} + 1), 0), {REPLAY_CHUNKS - 1}), 0)"""


def files_per_chunk(spark) -> int:
    return spark.sparkContext.defaultParallelism


def replay_files(spark, sf, chunks: int = REPLAY_CHUNKS) -> str:
    """Write ``(line_id, line, ingested_at)`` as ``chunks`` parquet folders in
    arrival order, one write job each, every chunk as exactly
    :func:`files_per_chunk` files.  The file source takes files oldest first,
    so with that many files per trigger each micro-batch is one chunk."""
    lines = log_lines(prepare(spark), sf).select("line_id", "line", "ingested_at")
    base = scratch_path(spark, "replay")
    top = lines.agg(F.max("line_id")).collect()[0][0] or 0
    size = top // chunks + 1
    k_files = files_per_chunk(spark)
    # the outer chunks have open ends: negative and NULL ids are in the first
    chunk = F.coalesce(F.least(F.greatest(F.floor(F.col("line_id") / size), F.lit(0)), F.lit(chunks - 1)), F.lit(0))
    for k in range(chunks):
        lines.filter(chunk == k).repartition(k_files).write.parquet(f"{base}/{k:04d}")
    return f"{base}/*"


def run_to_end(df, name: str, spark, partition_by: str | None = None):
    out = scratch_path(spark, f"{name}-out")
    q = S.start_parquet_sink(df, out, scratch_path(spark, f"{name}-ckpt"), partition_by=partition_by)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return q, out


def _parsed_stream(spark, sf):
    src = S.stream_log_source(spark, replay_files(spark, sf), fmt="parquet",
                              max_files_per_trigger=files_per_chunk(spark))
    return S.stream_parse_enrich(src)


@query("stream_log_source", "2.1", with_ctes("SELECT line FROM clean_lines", "clean_lines"))
def stream_log_source(spark, sf):
    raw = scratch_path(spark, "raw-stream")
    io.write_lines(log_lines(prepare(spark), sf), raw)
    source = S.stream_log_source(spark, raw, fmt="tail", max_files_per_trigger=2, state=scratch_path(spark, "source-state"), unfinished=True)
    out = scratch_path(spark, "source-out")
    S.finish(S.start_parquet_sink(source, out, scratch_path(spark, "source-ckpt"), available_now=False))
    return spark.read.parquet(out).select("line")


@query("stream_parse_enrich", "2.6", with_ctes(f"SELECT {', '.join(EVENT_COLS)} FROM log_events", "log_events"))
def stream_parse_enrich(spark, sf):
    ev = _parsed_stream(spark, sf).withColumnRenamed("line_id", "event_id")
    q, out = run_to_end(ev.select(*EVENT_COLS), "parse", spark)
    return spark.read.parquet(out)


@query("stream_index", "2.6", with_ctes("SELECT event_id, true AS indexed FROM log_events", "log_events"))
def stream_index(spark, sf):
    ev = S.stream_index(_parsed_stream(spark, sf))
    q, out = run_to_end(ev, "index", spark)
    return spark.read.parquet(out).select("event_id", F.col("indexed_at").isNotNull().alias("indexed"))


@query("stream_alerts", "2.6", with_ctes("SELECT * FROM alerts", "alerts"))
def stream_alerts(spark, sf):
    alerts = S.stream_alerts(_parsed_stream(spark, sf), time_col="ingested_at")
    q, out = run_to_end(alerts, "alerts", spark)
    return spark.read.parquet(out)


@query("stream_progress_metrics", "2.6", with_ctes(f"""
SELECT l.batch_id, l.num_input_rows, coalesce(e.indexed_rows, 0) AS indexed_rows, true AS timed
FROM (SELECT {_CHUNK} AS batch_id, count(*) AS num_input_rows FROM log_lines GROUP BY 1) l
LEFT JOIN (SELECT {_CHUNK} AS batch_id, count(*) AS indexed_rows FROM (SELECT event_id AS line_id FROM log_events) GROUP BY 1) e USING (batch_id)
""", "log_events"))
def stream_progress_metrics(spark, sf):
    """The progress table of an indexing run; rows in and rows indexed of every
    batch are held against the input."""
    path = scratch_path(spark, "progress-table")
    log = ProgressLog(spark, path)
    indexed = S.stream_index(_parsed_stream(spark, sf)).observe("events", F.count(F.lit(1)).alias("indexed_rows"))
    q, _ = run_to_end(indexed, "progress", spark)
    log.wait(q)
    log.stop()
    return read_progress(spark, path).filter(F.col("query_id") == str(q.id)).select(
        "batch_id", "num_input_rows", F.col("observed")["events"]["indexed_rows"].cast("bigint").alias("indexed_rows"),
        (F.col("trigger_ms") > 0).alias("timed"))
