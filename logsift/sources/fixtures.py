"""Log-shaped inputs derived from the driver's ``events`` table.

The test tables hold no web-server logs, so a deterministic ``log_lines``
table (and the run / metric-sample tables of the run analytics) is derived
from ``events`` with column expressions only.  The same rules exist as SQL in
:mod:`logsift.plans.oracle`; both must stay in step.  Work grows linearly
with ``events``; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.functions.rows import spread
from logsift.operators.sequence import number_rows

# --- fixed values: derivation rules shared with the SQL oracle --------------
BASE_EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC: arrival of event 0
IP_BY_USER_MOD10 = {0: "10.0.0.1", 1: "192.168.1.7", 2: "172.32.0.9", 3: "127.0.0.1"}
PUBLIC_IP_PREFIX = "203.0.113."
USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; rv:91.0) Gecko/20100101 Firefox/91.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) Chrome/91.0 Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_0 like Mac OS X) Safari/604.1",
    "Mozilla/5.0 (Linux; Android 13) Chrome/110.0",
    "Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 6.1; Trident/4.0)",
    "curl/7.0",
]
URL_TRAVERSAL = "/a/../../etc/passwd"
URL_COMMAND = "/run?CMD=ls"
URL_SCRIPT = "/s?q=<script>x</script>"
MSG_INJECTION = "union SELECT from /x"
MSG_NORMAL = "mod_jk child init "
ERROR_TIME_OUT = "EEE MMM dd HH:mm:ss yyyy"
ACCESS_TIME_OUT = "dd/MMM/yyyy:HH:mm:ss"
WORKERS = [2, 4, 6, 8]
RATES = [300, 500, 1000]
BATCHES = [50, 100]
SAMPLE_INTERVAL_SEC = 5
RUN_DURATION_SEC = 60
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mod(c: Column, m: int) -> Column:
    return F.pmod(c, F.lit(m))


def _ip(user_id: Column) -> Column:
    out = None
    for k, v in IP_BY_USER_MOD10.items():
        cond = _mod(user_id, 10) == k
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out.otherwise(F.concat(F.lit(PUBLIC_IP_PREFIX), _mod(user_id, 10).cast("string")))


def _pick(index: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(line_id, line, ingested_at, indexed_at)`` -- one raw line per event.

    ``indexed_at`` stands in for the indexer's clock: arrival plus
    ``round(value * 1000)`` microseconds.
    """
    ev = spread(read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"))
    eid, uid, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    ingested = F.timestamp_seconds(F.lit(BASE_EPOCH) + eid)
    indexed = F.timestamp_micros(
        (F.lit(BASE_EPOCH) + eid) * F.lit(1_000_000) + F.round(F.col("value") * 1000).cast("bigint")
    )
    status = (
        F.when(etype == "error", F.when(_mod(eid, 2) == 0, F.lit(404)).otherwise(F.lit(500)))
        .when(etype == "signup", F.lit(201))
        .when(etype == "view", F.lit(304))
        .otherwise(F.lit(200))
    ).cast("string")
    level = F.when(etype == "error", F.lit("error")).otherwise(F.lit("notice"))
    url = (
        F.when(_mod(eid, 53) == 0, F.lit(URL_TRAVERSAL))
        .when(_mod(eid, 59) == 0, F.lit(URL_COMMAND))
        .when(_mod(eid, 61) == 0, F.lit(URL_SCRIPT))
        .otherwise(F.concat(F.lit("/p/"), uid.cast("string")))
    )
    nbytes = F.when(_mod(eid, 7) == 0, F.lit("-")).otherwise(F.floor(F.col("value")).cast("bigint").cast("string"))
    ua = _pick(_mod(uid, 6), USER_AGENTS)
    ip = F.col("ip")
    err_time = F.date_format(F.col("ingested_at"), ERROR_TIME_OUT)
    acc_time = F.date_format(F.col("ingested_at"), ACCESS_TIME_OUT)
    error_line = F.concat(
        F.lit("["), err_time, F.lit("] ["), level, F.lit("] "),
        F.when(_mod(eid, 3) == 0, F.lit("")).otherwise(F.concat(F.lit("[client "), ip, F.lit("] "))),
        F.when(_mod(eid, 15) == 0, F.lit(MSG_INJECTION)).otherwise(F.concat(F.lit(MSG_NORMAL), eid.cast("string"))),
    )
    common = F.concat(ip, F.lit(" - - ["), acc_time, F.lit(' +0000] "GET '), url, F.lit(' HTTP/1.0" '), status, F.lit(" "), nbytes)
    combined = F.concat(
        ip, F.lit(" - - ["), acc_time, F.lit(' +0000] "POST '), url, F.lit(' HTTP/1.1" '), status, F.lit(" "), nbytes,
        F.lit(' "-" "'), ua, F.lit('"'),
    )
    line = (
        F.when(_mod(eid, 97) == 0, F.concat(F.lit("garbage "), eid.cast("string")))
        .when(_mod(eid, 101) == 0, F.lit("   "))
        .when(_mod(eid, 5) == 0, error_line)
        .when(_mod(eid, 4) == 0, common)
        .otherwise(combined)
    )
    return (
        ev.withColumns({"ingested_at": ingested, "indexed_at": indexed, "ip": _ip(uid)})
        .select(eid.alias("line_id"), line.alias("line"), "ingested_at", "indexed_at")
    )


def _run_columns(uid: Column) -> dict[str, Column]:
    workers = _pick(_mod(uid, 4), WORKERS)
    rate = _pick(_mod(uid, 3), RATES)
    batch = _pick(_mod(F.floor(uid / 12).cast("bigint"), 2), BATCHES)
    exp_id = F.concat(F.lit("w"), workers.cast("string"), F.lit("_r"), rate.cast("string"), F.lit("_b"), batch.cast("string"))
    return {"workers": workers, "rate": rate, "batch": batch, "exp_id": exp_id}


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metrics sample (the 9 columns of a metrics CSV) per event, plus
    ``exp_id`` naming the run it belongs to."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    ev = ev.withColumns(_run_columns(F.col("user_id")))
    numbered = number_rows(
        ev.withColumn("_err", (F.col("event_type") == "error").cast("bigint")),
        order=["event_id"],
        group=["exp_id"],
        sums={"alerts_count": F.col("_err")},
    )
    runtime = (F.col("rn") * SAMPLE_INTERVAL_SEC).cast("double")
    return numbered.select(
        "exp_id",
        F.timestamp_seconds(F.lit(BASE_EPOCH) + F.col("rn") * SAMPLE_INTERVAL_SEC).alias("timestamp"),
        runtime.alias("runtime_sec"),
        F.col("rn").cast("bigint").alias("events_processed"),
        _mod(F.col("event_id"), 100).cast("bigint").alias("ingestion_queue_size"),
        _mod(F.col("user_id"), 50).cast("bigint").alias("parsed_queue_size"),
        (F.col("value") % 100).alias("cpu_percent"),
        (F.lit(20.0) + F.col("value") % 10).alias("memory_mb"),
        F.col("value").alias("throughput_eps"),
        F.col("alerts_count").cast("bigint").alias("alerts_count"),
        F.col("event_id").alias("sample_id"),
    )


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run record per ``exp_id`` (the 10 fields of the run summary JSON)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id")
    ev = ev.withColumns(_run_columns(F.col("user_id")))
    runs = ev.groupBy("exp_id", "workers", "rate", "batch").agg(
        F.min("event_id").alias("_first"), F.max("event_id").alias("_last")
    )
    return runs.select(
        "exp_id",
        F.col("workers").cast("int").alias("workers"),
        F.col("rate").cast("int").alias("rate"),
        F.col("batch").cast("int").alias("batch"),
        F.lit(RUN_DURATION_SEC).cast("int").alias("duration"),
        (_mod(F.col("_last"), 2) == 0).alias("success"),
        F.timestamp_seconds(F.lit(BASE_EPOCH) + F.col("_first")).alias("start_time"),
        F.timestamp_seconds(F.lit(BASE_EPOCH) + F.col("_last")).alias("end_time"),
        F.concat(F.lit("results/events_"), F.col("exp_id"), F.lit(".db")).alias("db_file"),
        F.concat(F.lit("results/metrics_"), F.col("exp_id"), F.lit(".csv")).alias("metrics_file"),
    )


def run_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-event indexing latency (ms) tagged with the run it belongs to --
    the rows behind one latency JSON file per run."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    ev = ev.withColumns(_run_columns(F.col("user_id")))
    return ev.select("exp_id", "event_id", (F.round(F.col("value") * 1000).cast("bigint") / 1000.0).alias("latency_ms"))
