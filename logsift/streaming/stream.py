"""The live job on Structured Streaming.

source (growing log files, files of raw lines, or replayed ``(line_id, line,
ingested_at)`` records) -> the same parse/enrich Column expressions as the
batch job (stateless, fused into the scan stage) -> two sinks:

* the events table, a parquet file sink: its manifest lists the files of the
  batches that were committed, and the stream of alerts reads that manifest,
  so files of a failed attempt are never read;
* alerts, in two levels.  Each task first packs its suspicious events into one
  row per address and minute; these few rows, not the events, are dealt by
  address to a stateful processor that keeps the last ``cap`` times and the
  last firing.  An event-time timer drops an address once it can no longer
  influence a result.  Events behind the watermark are counted, not processed.

Admission control (the reference's bounded queues) is an option of the
source: each micro-batch holds a bounded amount of input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from logsift.operators.alerts import CAP, COOLDOWN_SEC, THRESHOLD, WINDOW_SEC, alert_records
from logsift.functions.rows import keep_where, spread
from logsift.sources import tail
from logsift.sources.logs import clean_lines, index_events, parse_events
from logsift.streaming.progress import progress_row

REPLAY_SCHEMA = StructType([
    StructField("line_id", LongType()),
    StructField("line", StringType()),
    StructField("ingested_at", TimestampType()),
])
_US = 1_000_000


def byte_count(size: str | int | None) -> int:
    """``"64g"`` -> bytes; None and empty: 0."""
    text = str(size or 0).strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[-1:], 0)
    return int(text[:-1] if unit else text) << unit


def stream_log_source(
    spark: SparkSession, path: str, fmt: str = "text", max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | int | None = None, state: str | None = None, unfinished: bool = False,
) -> DataFrame:
    """Unbounded line source.  ``tail``: growing log files, each line with its
    own arrival and an id (``state``: folder for the reader's position, see
    :mod:`logsift.sources.tail`); ``text``: finished files, arrival =
    micro-batch time; ``parquet``/``json``: replayed records that carry their
    arrival."""
    if fmt == "tail":
        if not state:
            raise ValueError("the tail source needs a state folder")
        return clean_lines(tail.follow(spark, path, state, byte_count(max_bytes_per_trigger), max_files_per_trigger or 0, unfinished))
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if fmt == "text":
        df = r.text(path).select(
            F.col("value").alias("line"),
            F.current_timestamp().alias("ingested_at"),
            F.col("_metadata.file_name").alias("source_file"),
        )
    else:
        df = r.schema(REPLAY_SCHEMA).format(fmt).load(path)
    return clean_lines(df)


def stream_parse_enrich(lines: DataFrame) -> DataFrame:
    """Stateless parse + enrich on a streaming DataFrame (rejects dropped)."""
    return parse_events(lines)


def now_after(arrival: Column) -> Column:
    """The clock when a row passes by (one reading per Arrow batch), which is
    after its arrival; ``current_timestamp`` would be the start of the batch."""

    def clock(t: pd.Series) -> pd.Series:
        return pd.Series(pd.Timestamp.now(tz="UTC"), index=t.index)

    return F.pandas_udf(clock, TimestampType()).asNondeterministic()(arrival)


def stream_index(events: DataFrame, id_col: str = "line_id", clock: str | None = None) -> DataFrame:
    """Events table rows; ``indexed_at`` is the micro-batch time or, given the
    arrival column ``clock``, the time when the row is indexed."""
    events = events.drop("indexed_at")
    return index_events(events.withColumn("indexed_at", now_after(F.col(clock))) if clock else events, id_col)


def number_batch(df: DataFrame, base: int, name: str = "event_id") -> DataFrame:
    """Unique, retry-stable ids for one micro-batch in a single pass, from
    ``base`` on: partitions take turns (``base + row * partitions +
    partition``), so ids stay close to the number of rows, whatever the
    number of partitions or of rows in one."""
    mid = F.monotonically_increasing_id()  # partition << 33 | row
    width = max(1, df.rdd.getNumPartitions())
    row = mid.bitwiseAND(F.lit((1 << 33) - 1))
    return df.withColumn(name, F.lit(base).cast("bigint") + row * F.lit(width) + F.shiftright(mid, 33))


def _first_id(spark: SparkSession, path: str, batch_id: int) -> int:
    """First free id of a batch: the one that its predecessor noted."""
    if batch_id == 0:
        return 0
    return spark.read.schema("next bigint").json(f"{path}/_next/{batch_id - 1}").first()["next"]


def start_indexer(lines: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Index raw lines (no id column): per micro-batch, parse/enrich, stamp
    ``indexed_at``, give the events ids (:func:`number_batch`) and write them to
    ``<path>/batch=<id>/date=<day>/`` with overwrite -- a retried batch
    replaces its own output, so the sink is idempotent.  ``_next/<id>`` notes
    the first id after the batch, for its successor."""

    def write(batch: DataFrame, batch_id: int) -> None:
        raw = spread(batch.withColumn("line_id", F.lit(0).cast("bigint")))  # few small files: use every core
        parsed = stream_index(parse_events(raw))
        spark = batch.sparkSession
        base = _first_id(spark, path, batch_id)
        events = number_batch(parsed.drop("event_id"), base).select(*parsed.columns)
        out = f"{path}/batch={batch_id}"
        events.withColumn("date", F.to_date("indexed_at")).write.mode("overwrite").partitionBy("date").parquet(out)
        last = spark.read.schema("event_id bigint").parquet(out).agg(F.max("event_id")).first()[0]
        after = base if last is None else last + 1
        spark.createDataFrame([(after,)], "next bigint").coalesce(1).write.mode("overwrite").json(f"{path}/_next/{batch_id}")

    w = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()


def start_events_sink(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The events table (days of ``indexed_at`` as partitions) from rows whose
    ids come from the source.  The file sink's manifest makes a batch appear as
    a whole, once; a failed attempt's files are never listed in it."""
    return start_parquet_sink(events.withColumn("date", F.to_date("indexed_at")), path, checkpoint, available_now=False, partition_by="date")


def finish(query: StreamingQuery) -> None:
    """Let a running query take all input that is there, then stop it."""
    query.processAllAvailable()
    query.stop()


def start_parquet_sink(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                       partition_by: str | None = None) -> StreamingQuery:
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.outputMode("append").start()


# --- stateful alerts -------------------------------------------------------

ALERT_STATE = "ring array<bigint>, last bigint, newest bigint"
PACKED_SCHEMA = "ip string, times binary, counts binary, clock_us bigint"
FIRE_SCHEMA = "ip string, t_us bigint, count bigint, late bigint"
PACK_ROWS = 1_000_000  # points that a task packs at a time (bounds its memory)
SLOT_US = 60 * _US  # time that one packed row covers (bounds its size)


def _ring_counts(seq: np.ndarray, ends: np.ndarray, now: np.ndarray, window_us: int, cap: int,
                 block: int = 65_536) -> np.ndarray:
    """For each check ``k``: how many of the last ``cap`` entries of
    ``seq[: ends[k] + 1]`` (the ring at that moment) satisfy
    ``0 <= now[k] - x <= window``.  Vectorised in blocks of checks."""
    pad = np.full(cap - 1, np.iinfo(np.int64).min // 2, dtype=np.int64)  # never inside a window
    rings = np.lib.stride_tricks.sliding_window_view(np.concatenate([pad, seq]), cap)
    out = np.empty(len(ends), dtype=np.int64)
    for lo in range(0, len(ends), block):
        hi = min(lo + block, len(ends))
        age = now[lo:hi, None] - rings[ends[lo:hi]]
        out[lo:hi] = ((age >= 0) & (age <= window_us)).sum(axis=1)  # a late event does not see later ones
    return out


def _packed(ip: pa.Array, t_us: np.ndarray) -> pa.RecordBatch:
    """One row per address and slot of time: its distinct times and how often
    each occurs; and a row without times that carries the largest time."""
    coded = ip.dictionary_encode("encode")
    code = coded.indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((t_us, code))
    code, t = code[order], t_us[order]
    new = np.ones(len(t), bool)
    new[1:] = (code[1:] != code[:-1]) | (t[1:] != t[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(t)))
    code, t = code[first], t[first]
    slot = t // SLOT_US
    new = np.ones(len(t), bool)
    new[1:] = (code[1:] != code[:-1]) | (slot[1:] != slot[:-1])
    cuts = [*np.flatnonzero(new).tolist(), len(t)]
    times, counts = t.astype("<i8").tobytes(), n.astype("<i8").tobytes()
    pieces = [(times[8 * a : 8 * b], counts[8 * a : 8 * b]) for a, b in zip(cuts, cuts[1:])]
    newest = int(t.argmax())
    owner = pa.array([*code[cuts[:-1]].tolist(), int(code[newest])], pa.int32())
    clock = [None] * len(pieces) + [int(t[newest])]
    return pa.RecordBatch.from_arrays(
        [coded.dictionary.take(owner), pa.array([p[0] for p in pieces] + [b""], pa.binary()), pa.array([p[1] for p in pieces] + [b""], pa.binary()),
         pa.array(clock, pa.int64())], names=["ip", "times", "counts", "clock_us"])


def pack_points(points: DataFrame) -> DataFrame:
    """First level of the alerts: ``(ip, t_us)`` -> rows of :func:`_packed`,
    made by each task from its own events.  An address with most of the events
    is packed by all tasks; what is then dealt by address is one row per task
    and slot of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= PACK_ROWS:
                yield pack(held)
                held, rows = [], 0
        if held:
            yield pack(held)

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        table = table.filter(pc.is_valid(table.column("t_us")))
        if not table.num_rows:
            return pa.RecordBatch.from_arrays([pa.array([], f) for f in (pa.string(), pa.binary(), pa.binary(), pa.int64())],
                                              names=["ip", "times", "counts", "clock_us"])
        return _packed(table.column("ip").combine_chunks(), table.column("t_us").to_numpy())

    return points.select("ip", "t_us").mapInArrow(run, PACKED_SCHEMA)


def _counts(ring: np.ndarray, times: np.ndarray, n: np.ndarray, window_us: int, cap: int) -> np.ndarray:
    """Events within the window at each of the sorted distinct ``times``, after
    the stored ``ring``; at most ``cap``."""
    if not len(ring) or (ring[-1] <= times[0] and (np.diff(ring) >= 0).all()):  # in order: sums instead of rings
        at = np.concatenate([ring, times])
        total = np.concatenate([[0], np.cumsum(np.concatenate([np.ones(len(ring), np.int64), n]))])
        return np.minimum(total[len(ring) + 1 :] - total[np.searchsorted(at, times - window_us, side="left")], cap)
    n = np.minimum(n, cap)
    seq = np.concatenate([ring, np.repeat(times, n)])
    return _ring_counts(seq, len(ring) + np.cumsum(n) - 1, times, window_us, cap)


def _alert_fold(window_us: int, threshold: int, cap: int, cooldown_us: int):
    """Greedy cooldown of one address over the sorted distinct ``times`` of a
    batch (``n`` events each), after the stored ``ring`` and last firing: the
    firings, and the ring and last firing afterwards."""

    def fold(ring: np.ndarray, last: int | None, times: np.ndarray, n: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray, int | None]:
        counts = _counts(ring, times, n, window_us, cap)
        at = np.flatnonzero(counts >= threshold)
        cand, fired, i = times[at], [], 0
        while i < len(cand):  # jump to the first candidate past the cooldown
            if last is None or cand[i] - last >= cooldown_us:
                last = int(cand[i])
                fired.append((last, int(counts[at[i]])))
            i = int(np.searchsorted(cand, last + cooldown_us, side="left"))
        newest = np.repeat(times[-cap:], np.minimum(n[-cap:], cap))
        return fired, np.concatenate([ring, newest])[-cap:], last

    return fold


class AlertProcessor(StatefulProcessor):
    """Second level: per address the last ``cap`` times, the last firing and
    the newest time."""

    def __init__(self, window_us: int, threshold: int, cap: int, cooldown_us: int):
        self.keep_us = max(window_us, cooldown_us)
        self.fold = _alert_fold(window_us, threshold, cap, cooldown_us)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.address = handle.getValueState("address", ALERT_STATE)

    def _stored(self) -> tuple | None:
        return self.address.get() if self.address.exists() else None

    def _done_ms(self, newest: int) -> int:
        return (newest + self.keep_us) // 1000 + 1

    def _out(self, ip, fired: list[tuple[int, int]], late: int) -> pd.DataFrame:
        rows = [(ip, t, c, None) for t, c in fired] + ([(ip, None, None, late)] if late else [])
        ips, t, c, n = zip(*rows) if rows else ((), (), (), ())
        whole = lambda v: pd.Series(v, dtype="Int64")
        return pd.DataFrame({"ip": pd.Series(ips, dtype=object), "t_us": whole(t), "count": whole(c), "late": whole(n)})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        t, n = [], []
        for pdf in rows:
            t += [np.frombuffer(b, "<i8") for b in pdf["times"]]
            n += [np.frombuffer(b, "<i8") for b in pdf["counts"]]
        times, where = np.unique(np.concatenate(t), return_inverse=True)
        n = np.bincount(where, weights=np.concatenate(n), minlength=len(times)).astype(np.int64)
        on_time = times >= timerValues.getCurrentWatermarkInMs() * 1000
        late = int(n[~on_time].sum())
        fired: list[tuple[int, int]] = []
        if on_time.any():
            stored = self._stored()
            ring, last = (np.array(stored[0], np.int64), stored[1]) if stored else (np.zeros(0, np.int64), None)
            fired, ring, last = self.fold(ring, last, times[on_time], n[on_time])
            newest = max(int(ring.max()), last or 0, stored[2] if stored else 0)
            self.address.update((ring.tolist(), last, newest))
            if not stored:  # a timer that finds its address still in use sets itself again
                self.handle.registerTimer(self._done_ms(newest))
        yield self._out(key[0], fired, late)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        stored = self._stored()
        if stored:
            done = self._done_ms(stored[2])
            if done > timerValues.getCurrentWatermarkInMs():
                self.handle.registerTimer(done)
            else:
                self.address.clear()
        yield self._out(key[0], [], 0)


def stream_alerts(
    events: DataFrame,
    time_col: str = "ingested_at",
    lateness: str = "10 minutes",
    window_sec: int = WINDOW_SEC,
    threshold: int = THRESHOLD,
    cap: int = CAP,
    cooldown_sec: int = COOLDOWN_SEC,
) -> DataFrame:
    """Alert rows from a stream of enriched events (same rule as the batch
    :func:`logsift.operators.alerts.alerts_event_time`).

    Events more than ``lateness`` behind are not processed; the query's
    progress counts them (observation ``alerts``, ``late_rows``).  The state is
    kept in RocksDB, which this function selects for the session.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    # not a filter: that would run the patterns of the parser again for every use of their groups
    points = keep_where(events, F.col("suspicious")).select("ip", F.unix_micros(F.col(time_col)).alias("t_us"))
    # only the rows without times carry the event clock: the watermark follows
    # them, and rows with times always reach the processor, which counts late ones
    fires = (
        pack_points(points)
        .select("ip", "times", "counts", F.timestamp_micros("clock_us").alias("clock"))
        .withWatermark("clock", lateness)
        .groupBy("ip")
        .transformWithStateInPandas(
            AlertProcessor(window_sec * _US, threshold, cap, cooldown_sec * _US),
            outputStructType=FIRE_SCHEMA, outputMode="append", timeMode="EventTime")
        .observe("alerts", F.count("t_us").alias("fired"), F.coalesce(F.sum("late"), F.lit(0)).alias("late_rows"))
    )
    return alert_records(fires.filter(F.col("t_us").isNotNull()), window_sec)


def progress_rows(query: StreamingQuery) -> list[dict]:
    """Records of the last micro-batches that Spark still holds; the whole run
    is in the table of a :class:`logsift.streaming.progress.ProgressLog`."""
    return [progress_row(p) for p in query.recentProgress]
