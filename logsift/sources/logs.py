"""Log sources: raw text files or a lines table -> cleaned lines -> events.

``scan_log_lines`` reads text files (any number, any size: Spark splits them);
``clean_lines`` strips and drops blank lines; ``parse_events`` /
``index_events`` produce the fixed-schema events table.  Each step is a
narrow projection/filter, so the whole chain is one codegen stage per scan
split with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.functions.enrich import enrich_events
from logsift.functions.parse import KIND_REJECT, parse_lines, strip_line
from logsift.functions.rows import keep_where
from logsift.schemas import EVENT_COLUMNS


# Spark decodes invalid UTF-8 bytes as this character.
REPLACEMENT_CHAR = "\ufffd"


def scan_log_lines(spark: SparkSession, path: str, arrival: str | None = None, lenient: bool = False) -> DataFrame:
    """Read text log files; ``line`` is stripped, blank lines dropped.

    ``ingested_at`` is the file's modification time when ``arrival`` is
    None (a batch read has no per-line arrival clock), else the given column
    expression (e.g. ``"current_timestamp()"``).  ``lenient`` drops bytes
    that are not valid UTF-8 (decoded as U+FFFD), as the log sampler's
    reader ignores decoding errors.
    """
    raw = spark.read.text(path)
    ing = F.expr(arrival) if arrival else F.col("_metadata.file_modification_time")
    value = F.regexp_replace(F.col("value"), REPLACEMENT_CHAR, "") if lenient else F.col("value")
    df = raw.select(
        value.alias("line"),
        ing.alias("ingested_at"),
        F.col("_metadata.file_name").alias("source_file"),
    )
    return clean_lines(df)


def clean_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Strip whitespace at both ends and drop lines that are then empty."""
    stripped = lines.withColumn(line_col, strip_line(F.col(line_col)))
    return keep_where(stripped, F.length(F.col(line_col)) > 0)


def parse_all(lines: DataFrame, fallback_time: str = "ingested_at") -> DataFrame:
    """Clean + classify + parse; keeps rejects (``kind = 'X'``)."""
    return parse_lines(clean_lines(lines), fallback_time=fallback_time)


def parse_events(lines: DataFrame, fallback_time: str = "ingested_at") -> DataFrame:
    """Parsed and enriched events (rejects removed)."""
    parsed = keep_where(parse_all(lines, fallback_time), F.col("kind") != KIND_REJECT)
    return enrich_events(parsed)


def parse_rejects(lines: DataFrame) -> DataFrame:
    """Lines that match neither format (the quarantine table)."""
    return keep_where(parse_all(lines), F.col("kind") == KIND_REJECT)


def index_events(events: DataFrame, id_col: str = "line_id") -> DataFrame:
    """The events table: fixed column set, defaults filled ('' / 0 / false).

    ``indexed_at`` is kept if present (replayed runs, fixtures), otherwise
    stamped with the current time, as the indexer does at write time.
    """
    if "indexed_at" not in events.columns:
        events = events.withColumn("indexed_at", F.current_timestamp())
    filled = events.select(
        F.col(id_col).cast("bigint").alias("event_id"),
        F.coalesce("ip", F.lit("")).alias("ip"),
        F.col("timestamp"),
        F.coalesce("method", F.lit("")).alias("method"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("status", F.lit(0)).cast("int").alias("status"),
        F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"),
        F.coalesce("referer", F.lit("")).alias("referer"),
        F.coalesce("user_agent", F.lit("")).alias("user_agent"),
        F.coalesce("browser", F.lit("")).alias("browser"),
        F.coalesce("os", F.lit("")).alias("os"),
        F.coalesce("ip_class", F.lit("")).alias("ip_class"),
        F.coalesce("suspicious", F.lit(False)).alias("suspicious"),
        F.col("ingested_at"),
        F.col("indexed_at"),
    )
    return filled.select(*EVENT_COLUMNS)
