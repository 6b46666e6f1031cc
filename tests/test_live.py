"""The live job: lines appended to files, batches that fail and are run again,
hot addresses, late events, progress of long runs."""

import glob
import json
import os
import random
import shutil

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from logsift import jobs
from logsift.operators.alerts import alerts_event_time
from logsift.schemas import EVENTS
from logsift.session import prepare, scratch_path
from logsift.sources import io, tail
from logsift.streaming import stream as S
from logsift.streaming.progress import ProgressLog, read_progress

US = 1_000_000
T0 = 1_704_067_200 * US
ERROR_LINE = '{ip} - - [01/Jan/2024:00:00:{s:02d} +0000] "GET /p/{k} HTTP/1.0" 404 12\n'


def folder(spark, name):
    path = scratch_path(spark, name)
    os.makedirs(path)
    return path


# ---------------------------------------------------------------- source

def test_appended_lines_arrive_once_each_with_its_own_arrival(spark):
    prepare(spark)
    logs, out = folder(spark, "tail-logs"), scratch_path(spark, "tail-out")
    state, checkpoint = scratch_path(spark, "tail-state"), scratch_path(spark, "tail-ck")

    def run():
        lines = S.stream_log_source(spark, logs, fmt="tail", state=state)
        S.finish(S.start_parquet_sink(lines, out, checkpoint, available_now=False))
        return spark.read.parquet(out)

    with open(f"{logs}/a.log", "w") as f:
        f.write("a one\na two\na unfin")
        f.flush()
        assert sorted(r.line for r in run().collect()) == ["a one", "a two"]
        f.write("ished\n\n  \na four\n")
    with open(f"{logs}/b.log", "wb") as f:
        f.write(b"b one\xff\r\n")
    got = run().collect()
    assert sorted(r.line for r in got) == ["a four", "a one", "a two", "a unfinished", "b one"]
    assert len({r.line_id for r in got}) == 5
    with open(f"{logs}/a.log", "w") as f:
        f.write("anew\n")  # a file begun anew under the same name
    got = run().collect()
    assert sorted(r.line for r in got) == ["a four", "a one", "a two", "a unfinished", "anew", "b one"]
    assert len({r.line_id for r in got}) == 6
    with open(f"{logs}/c.log", "w") as f:
        f.writelines(f"line {k}\n" for k in range(30_000))
    many = run().filter("source_file = 'c.log'")
    assert many.count() == 30_000 and many.select("ingested_at").distinct().count() > 100


def test_batches_of_the_tail_source_are_limited(spark):
    logs, out = folder(spark, "limit-logs"), scratch_path(spark, "limit-out")
    for k in range(3):
        with open(f"{logs}/{k}.log", "w") as f:
            f.writelines(f"{k} {j:04d}\n" for j in range(1000))  # 7,000 bytes
    lines = S.stream_log_source(spark, logs, fmt="tail", state=scratch_path(spark, "limit-state"), max_bytes_per_trigger=3000)
    q = S.start_parquet_sink(lines, out, scratch_path(spark, "limit-ck"), available_now=False)
    S.finish(q)
    rows = [p["num_input_rows"] for p in S.progress_rows(q) if p["num_input_rows"]]
    assert sum(rows) == 3000 and max(rows) <= 3000 // 7 and spark.read.parquet(out).select("line").distinct().count() == 3000


def test_splits_of_a_file_share_its_lines():
    import pyarrow as pa

    rnd = random.Random(2)
    for _ in range(60):
        lines = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(9))) for _ in range(rnd.randrange(1, 40))]
        data = b"\n".join(lines) + rnd.choice([b"", b"\n"])
        first = rnd.choice([0, *[k + 1 for k, c in enumerate(data[:-1]) if c == 10]])
        size = rnd.randrange(1, 30)
        got = []
        for a in range(first, len(data), size):
            split = tail.Split("x", 0, first, a, min(a + size, len(data)), len(data))
            got += tail._lines(pa.BufferReader(data), split)
        want, at = [], first
        for line in data[first:].split(b"\n"):
            want.append((at, line))
            at += len(line) + 1
        if data.endswith(b"\n") or not want[-1][1]:
            want.pop()
        assert got == want


# ---------------------------------------------------------------- events and alerts

def burst(path, ips, lines):
    with open(path, "a") as f:
        f.writelines(ERROR_LINE.format(ip=ip, s=k % 60, k=k) for k in range(lines) for ip in ips)


def test_a_batch_that_failed_after_writing_its_files_leaves_nothing_behind(spark):
    logs, events, alerts, ck = folder(spark, "retry-logs"), scratch_path(spark, "retry-ev"), scratch_path(spark, "retry-al"), scratch_path(spark, "retry-ck")
    burst(f"{logs}/0.log", ["10.0.0.1", "10.0.0.2"], 8)
    run = lambda *paths: [q.awaitTermination() for q in jobs.ingest(spark, *paths)]
    run(logs, events, alerts, ck)
    burst(f"{logs}/0.log", ["10.0.0.3"], 7)
    shutil.copytree(f"{ck}/events", f"{ck}/before")
    S.finish(S.start_events_sink(_events(spark, logs, f"{ck}/tail"), events, f"{ck}/events"))
    # as if the second batch had ended before its commits: its files lie there, no log lists it
    batch = max(int(os.path.basename(p)) for p in glob.glob(f"{ck}/events/commits/[0-9]*"))
    os.replace(f"{events}/_spark_metadata/{batch}", f"{ck}/lost-manifest")
    os.replace(f"{ck}/events/commits/{batch}", f"{ck}/lost-commit")
    for crc in (f"{events}/_spark_metadata/.{batch}.crc", f"{ck}/events/commits/.{batch}.crc"):
        if os.path.exists(crc):
            os.replace(crc, f"{ck}/{os.path.basename(crc)}-{len(crc)}")
    orphans = len(glob.glob(f"{events}/date=*/*.parquet"))
    run(logs, events, alerts, ck)
    stored = io.read_events(spark, events)
    assert len(glob.glob(f"{events}/date=*/*.parquet")) > orphans
    assert stored.count() == stored.select("event_id").distinct().count() == 23
    clean = [folder(spark, "clean-logs"), *(scratch_path(spark, f"clean-{k}") for k in ("ev", "al", "ck"))]
    shutil.copy(f"{logs}/0.log", clean[0])
    run(*clean)
    columns = [f.name for f in EVENTS.fields if f.name not in ("event_id", "ingested_at", "indexed_at")]
    same = lambda path: sorted(map(str, io.read_events(spark, path).select(columns).collect()))
    assert same(events) == same(clean[1])
    fired = lambda path: sorted(r.ip for r in io.read_alerts(spark, path).collect())
    assert fired(alerts) == fired(clean[2]) == ["10.0.0.1", "10.0.0.2", "10.0.0.3"]


def _events(spark, logs, state):
    from logsift.sources.logs import parse_events

    return S.stream_index(parse_events(S.stream_log_source(spark, logs, fmt="tail", state=state, unfinished=True)), clock="ingested_at")


def test_live_latency_is_each_events_own_and_the_table_can_be_compacted(spark):
    logs, events, alerts = folder(spark, "lat-logs"), scratch_path(spark, "lat-ev"), scratch_path(spark, "lat-al")
    for k in range(4):
        burst(f"{logs}/{k}.log", ["203.0.113.9"], 3000)
    jobs.ingest(spark, logs, events, alerts, scratch_path(spark, "lat-ck"), max_files_per_trigger=2, progress_path=(table := scratch_path(spark, "lat-progress")))
    stored = io.read_events(spark, events)
    latency = stored.select((F.unix_micros("indexed_at") - F.unix_micros("ingested_at")).alias("us"))
    assert latency.distinct().count() > 100 and latency.agg(F.min("us")).first()[0] >= 0
    got = sorted((r.ip, r.created_at) for r in io.read_alerts(spark, alerts).collect())
    assert got == sorted((r.ip, r.created_at) for r in alerts_event_time(stored).collect()) and got
    assert read_progress(spark, table).agg(F.sum("num_input_rows")).first()[0] >= 12_000
    archive = scratch_path(spark, "lat-archive")
    for _ in range(2):  # again: days are replaced
        jobs.compact(spark, events, archive, "2999-01-01")
    assert sorted(map(str, io.read_events(spark, archive).collect())) == sorted(map(str, stored.collect()))
    assert len(glob.glob(f"{archive}/date=*/*.parquet")) < len(glob.glob(f"{events}/date=*/*.parquet"))
    jobs.compact(spark, events, scratch_path(spark, "lat-none"), "2000-01-01")


def replayed(spark, rows, chunks, lateness="10 minutes", files=4):
    """Alerts and progress of points replayed in ``chunks`` batches of ``files`` files."""
    src = scratch_path(spark, "points")
    for k, part in enumerate(chunks):
        pdf = pd.DataFrame([rows[j] for j in part], columns=["event_id", "ip", "t"])
        spark.createDataFrame(pdf, "event_id long, ip string, t long").repartition(files).select(
            "event_id", "ip", F.lit(True).alias("suspicious"), F.timestamp_micros("t").alias("ingested_at")).write.parquet(f"{src}/{k:04d}")
    stream = spark.readStream.schema("event_id long, ip string, suspicious boolean, ingested_at timestamp").option("maxFilesPerTrigger", files).parquet(f"{src}/*")
    out, table = scratch_path(spark, "points-out"), scratch_path(spark, "points-progress")
    log = ProgressLog(spark, table)
    q = S.start_parquet_sink(S.stream_alerts(stream, lateness=lateness), out, scratch_path(spark, "points-ck"))
    q.awaitTermination()
    log.wait(q)
    log.stop()
    return spark.read.parquet(out), read_progress(spark, table)


def test_an_address_with_nine_tenths_of_the_rows(spark):
    prepare(spark)
    rnd = random.Random(9)
    rows = []
    for k in range(40_000):
        ip = "" if rnd.random() < 0.9 else rnd.choice(["a", "b", "c"])
        rows.append((k, ip, T0 + k * 25_000 + rnd.randrange(25_000)))  # 1,000 s
    got, _ = replayed(spark, rows, np.array_split(np.arange(len(rows)), 4))
    every = spark.createDataFrame(rows, "event_id long, ip string, t long").select(
        "event_id", "ip", F.lit(True).alias("suspicious"), F.timestamp_micros("t").alias("ingested_at"))
    cols = ["ip", "count", "created_at"]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, alerts_event_time(every, "ingested_at").select(cols).collect()))
    # what is dealt by address: at most a row per task and minute of each, whatever its events
    dealt = S.pack_points(every.repartition(4).select("ip", F.unix_micros("ingested_at").alias("t_us")))
    per = {r.ip: r.n for r in dealt.groupBy("ip").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per[""] <= 2 * np.median(list(per.values())) and per[""] <= 4 * 19
    sizes = [r.n for r in dealt.groupBy(F.spark_partition_id()).agg(F.sum(F.length("times") / 8).alias("n")).collect()]
    assert max(sizes) <= 2 * np.median(sizes)


def test_late_events_are_counted(spark):
    prepare(spark)
    rows = [(k, "a", T0 + k * US) for k in range(6)] + [(10, "b", T0 + 7200 * US)] + [(20, "c", T0 + 7200 * US), *((30 + k, "a", T0 + k * US) for k in range(3))]
    got, progress = replayed(spark, rows, [range(6), range(6, 7), range(7, 11)], files=1)
    assert [r.ip for r in got.collect()] == ["a"]
    late = {r.batch_id: int(r.observed["alerts"]["late_rows"]) for r in progress.collect() if r.observed.get("alerts")}
    assert sum(late.values()) == 3 and late[2] == 3


def test_packing_keeps_every_time_and_its_number(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["x", "y", None]), T0 + rnd.randrange(500) * US if rnd.random() < 0.9 else None) for _ in range(3000)]
    got = {}
    for r in S.pack_points(spark.createDataFrame(rows, "ip string, t_us long").repartition(3)).collect():
        times, n = np.frombuffer(r.times, "<i8").tolist(), np.frombuffer(r.counts, "<i8").tolist()
        assert len({t // S.SLOT_US for t in times}) <= 1 and times == sorted(set(times))
        for t, k in zip(times, n):
            got[r.ip, t] = got.get((r.ip, t), 0) + k
    want = {}
    for ip, t in rows:
        if t is not None:
            want[ip, t] = want.get((ip, t), 0) + 1
    assert got == want


def test_counts_in_and_out_of_order_are_the_ring_counts():
    rnd = random.Random(3)
    for _ in range(300):
        cap = rnd.choice([3, 100])
        ring = [rnd.randrange(0, 500) for _ in range(rnd.randrange(0, 120))][-cap:]
        low = max(ring, default=0) if rnd.random() < 0.5 else 0
        times = sorted({rnd.randrange(low, low + 300) for _ in range(rnd.randrange(1, 60))})
        n = [rnd.choice([1, 1, 2, 200]) for _ in times]
        win, expect = list(ring), []
        for t, k in zip(times, n):
            win = (win + [t] * k)[-cap:]
            expect.append(sum(0 <= t - x <= 60 for x in win))
        got = S._counts(np.array(ring, np.int64), np.array(times, np.int64), np.array(n, np.int64), 60, cap)
        assert got.tolist() == expect


# ---------------------------------------------------------------- progress

def test_every_batch_of_a_long_run_has_its_row(spark):
    logs = folder(spark, "long-logs")
    for k in range(110):  # more than Spark holds reports for
        with open(f"{logs}/{k:03d}.log", "w") as f:
            f.writelines(f"{k} {j}\n" for j in range(k % 7 + 1))
    table = scratch_path(spark, "long-progress")
    log = ProgressLog(spark, table)
    lines = S.stream_log_source(spark, logs, fmt="tail", state=scratch_path(spark, "long-state"), max_files_per_trigger=1)
    q = S.start_parquet_sink(lines, scratch_path(spark, "long-out"), scratch_path(spark, "long-ck"), available_now=False)
    S.finish(q)
    log.wait(q)
    log.stop()
    rows = read_progress(spark, table).filter("num_input_rows > 0").collect()
    assert sorted(r.batch_id for r in rows) == list(range(110))
    assert {r.batch_id: r.num_input_rows for r in rows} == {k: k % 7 + 1 for k in range(110)}
    assert json.dumps(S.progress_rows(q)[-1]) and len(S.progress_rows(q)) <= 100
