"""Readers and sinks: text logs, events/alerts tables, CSV exports, metric
CSVs, run-record and latency JSON.

All writers are plain ``DataFrameWriter`` calls (parallel file writers, one
commit per job); all readers take an explicit schema (no inference pass).
CSV round trips use ``escape='"'`` and a ``\\N`` null marker so empty
strings, NULLs and quotes survive; CSV meant for other tools keeps the
default null handling (NULL -> empty field), as the reference's exports do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logsift.operators.runs import RUN_ID_PATTERN
from logsift.schemas import ALERTS, EVENTS, LATENCY, METRICS, RUNS

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ROUND_TRIP = {"escape": '"', "nullValue": "\\N", "timestampFormat": TS_FORMAT}


# --- text -----------------------------------------------------------------

def write_lines(df: DataFrame, path: str, col: str = "line", mode: str = "overwrite") -> None:
    """One line per row (the cleaned-log sink)."""
    df.select(F.col(col).alias("value")).write.mode(mode).text(path)


# --- events / alerts tables -------------------------------------------------

def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    """Parquet, partitioned by index date (partition pruning on time ranges)."""
    events.withColumn("date", F.to_date("indexed_at")).write.mode(mode).partitionBy("date").parquet(path)


def read_events(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The events table (partition column ``date`` is discovered, then dropped).

    ``start`` / ``end`` (timestamps, end exclusive) restrict ``indexed_at``;
    the same range on ``date`` prunes whole partitions before any file is
    opened, and the ``indexed_at`` bounds are pushed into the parquet scan.
    """
    df = spark.read.parquet(path)
    if start is not None:
        df = df.filter((F.col("date") >= F.to_date(F.lit(start))) & (F.col("indexed_at") >= F.lit(start).cast("timestamp")))
    if end is not None:
        df = df.filter((F.col("date") <= F.to_date(F.lit(end))) & (F.col("indexed_at") < F.lit(end).cast("timestamp")))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in EVENTS.fields])


def write_alerts(alerts: DataFrame, path: str, mode: str = "append") -> None:
    alerts.write.mode(mode).parquet(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ALERTS).parquet(path)


# --- CSV ----------------------------------------------------------------------

def export_csv(df: DataFrame, path: str, round_trip: bool = True, mode: str = "overwrite") -> None:
    """CSV with header; booleans as 0/1 (how the reference's store keeps them)."""
    out = df.select(*[F.col(f.name).cast("int").alias(f.name) if f.dataType.typeName() == "boolean" else F.col(f.name)
                      for f in df.schema.fields])
    w = out.write.mode(mode).option("header", True)
    if round_trip:
        w = w.options(**ROUND_TRIP)
    else:
        w = w.option("timestampFormat", TS_FORMAT)
    w.csv(path)


def export_events_csv(events: DataFrame, path: str, limit: int = 0) -> None:
    """The events export: all columns with a header; ``limit > 0`` keeps the
    first ``limit`` events by (indexed_at, event_id), a deterministic order
    for the export's optional row limit."""
    if limit > 0:
        events = events.orderBy("indexed_at", "event_id").limit(limit)
    export_csv(events, path)


def read_csv(spark: SparkSession, path: str, schema: StructType, round_trip: bool = True) -> DataFrame:
    r = spark.read.schema(schema).option("header", True)
    if round_trip:
        r = r.options(**ROUND_TRIP)
    else:
        r = r.option("timestampFormat", TS_FORMAT)
    return r.csv(path)


def write_metrics_by_run(samples: DataFrame, path: str, run: str = "exp_id") -> None:
    """One metrics CSV set per run: ``<path>/exp_id=<run>/part-*.csv``."""
    cols = [f.name for f in METRICS.fields]
    samples.select(run, *cols).write.mode("overwrite").partitionBy(run).option("header", True).options(
        **ROUND_TRIP
    ).csv(path)


def scan_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metric CSVs of many runs; the run id comes from the file path."""
    df = spark.read.schema(METRICS).option("header", True).options(**ROUND_TRIP).option(
        "recursiveFileLookup", True
    ).csv(path)
    run = F.regexp_extract(F.col("_metadata.file_path"), f"({RUN_ID_PATTERN})", 1)
    return df.select(run.alias("exp_id"), *df.columns)


# --- JSON -------------------------------------------------------------------

def write_json(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = df.write.mode("overwrite").option("timestampFormat", TS_FORMAT)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)


def scan_run_records(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Run records: JSON lines, or a JSON array per file with ``multi_line``."""
    return spark.read.schema(RUNS).option("multiLine", multi_line).option("timestampFormat", TS_FORMAT).json(path)


def scan_latency_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Latency records of many runs; the run id comes from the file path."""
    df = spark.read.schema(LATENCY).option("multiLine", multi_line).option("recursiveFileLookup", True).json(path)
    return df.select(F.regexp_extract(F.col("_metadata.file_path"), f"({RUN_ID_PATTERN})", 1).alias("exp_id"),
                     *df.columns)
