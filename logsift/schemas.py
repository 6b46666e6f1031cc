"""Table schemas (column names and Spark types) of the library's tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

EVENT_COLUMNS = [
    "event_id", "ip", "timestamp", "method", "url", "status", "bytes", "referer", "user_agent",
    "browser", "os", "ip_class", "suspicious", "ingested_at", "indexed_at",
]

EVENTS = StructType([
    StructField("event_id", LongType()),
    StructField("ip", StringType()),
    StructField("timestamp", TimestampType()),
    StructField("method", StringType()),
    StructField("url", StringType()),
    StructField("status", IntegerType()),
    StructField("bytes", LongType()),
    StructField("referer", StringType()),
    StructField("user_agent", StringType()),
    StructField("browser", StringType()),
    StructField("os", StringType()),
    StructField("ip_class", StringType()),
    StructField("suspicious", BooleanType()),
    StructField("ingested_at", TimestampType()),
    StructField("indexed_at", TimestampType()),
])

ALERT_TYPE = "HIGH_ERROR_RATE"

ALERTS = StructType([
    StructField("alert_type", StringType()),
    StructField("ip", StringType()),
    StructField("count", LongType()),
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
    StructField("created_at", TimestampType()),
])

METRICS = StructType([
    StructField("timestamp", TimestampType()),
    StructField("runtime_sec", DoubleType()),
    StructField("events_processed", LongType()),
    StructField("ingestion_queue_size", LongType()),
    StructField("parsed_queue_size", LongType()),
    StructField("cpu_percent", DoubleType()),
    StructField("memory_mb", DoubleType()),
    StructField("throughput_eps", DoubleType()),
    StructField("alerts_count", LongType()),
])

RUNS = StructType([
    StructField("exp_id", StringType()),
    StructField("workers", IntegerType()),
    StructField("rate", IntegerType()),
    StructField("batch", IntegerType()),
    StructField("duration", IntegerType()),
    StructField("success", BooleanType()),
    StructField("start_time", TimestampType()),
    StructField("end_time", TimestampType()),
    StructField("db_file", StringType()),
    StructField("metrics_file", StringType()),
])

LATENCY = StructType([
    StructField("count", LongType()),
    StructField("mean", DoubleType()),
    StructField("median", DoubleType()),
    StructField("std", DoubleType()),
    StructField("min", DoubleType()),
    StructField("max", DoubleType()),
    StructField("p50", DoubleType()),
    StructField("p90", DoubleType()),
    StructField("p95", DoubleType()),
    StructField("p99", DoubleType()),
])
