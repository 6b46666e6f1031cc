"""Live alert job: files replayed in order through the file source; the
stateful fold gives the batch result, and an address idle for longer than
window + cooldown (past the watermark) has its state removed."""

import time

from pyspark.sql import functions as F

from logsift.operators.alerts import alerts_event_time
from logsift.session import prepare, scratch_path
from logsift.streaming import stream as S

US = 1_000_000
T0 = 1_704_067_200 * US


def _chunk(spark, rows):
    df = spark.createDataFrame(rows, "event_id long, ip string, t long")
    return df.select("event_id", "ip", F.lit(True).alias("suspicious"), F.timestamp_micros("t").alias("ingested_at"))


def test_stream_alerts_expire_state_and_match_batch(spark):
    prepare(spark)
    burst = lambda ip, start, n, base: [(base + i, ip, start + i * US) for i in range(n)]
    chunks = [
        burst("a", T0, 6, 0) + burst("b", T0, 6, 100),
        burst("b", T0 + 2 * 3600 * US, 6, 200),
        burst("b", T0 + 2 * 3600 * US + 400 * US, 6, 300),
    ]
    src = scratch_path(spark, "stream-test-in")
    for k, rows in enumerate(chunks):
        _chunk(spark, rows).coalesce(1).write.parquet(f"{src}/{k:04d}")
        time.sleep(1.1)  # the file source orders files by modification time
    schema = "event_id long, ip string, suspicious boolean, ingested_at timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    out = scratch_path(spark, "stream-test-out")
    q = S.start_parquet_sink(S.stream_alerts(stream), out, scratch_path(spark, "stream-test-ckpt"))
    q.awaitTermination()
    assert q.exception() is None
    got = sorted((r["ip"], r["created_at"]) for r in spark.read.parquet(out).collect())

    every = _chunk(spark, [r for c in chunks for r in c])
    expect = sorted((r["ip"], r["created_at"]) for r in alerts_event_time(every, time_col="ingested_at").collect())
    assert got == expect and len(expect) == 4

    states = [p["state_rows"] for p in S.progress_rows(q)]
    assert max(states) == 2  # both addresses held state after the first batch
    assert states[-1] == 1  # "a" expired once the watermark passed its timeout


def test_ring_counts_match_direct_fold():
    """The vectorised ring counts of the live fold equal the per-event
    definition: append all events of a time, keep the last ``cap``, count
    those within the window."""
    import random

    import numpy as np

    rnd = random.Random(3)
    for _ in range(300):
        cap = rnd.choice([3, 100])
        ring = [rnd.randrange(0, 500) for _ in range(rnd.randrange(0, 120))][-cap:]
        times = sorted(rnd.randrange(0, 800) for _ in range(rnd.randrange(1, 300)))
        w = rnd.choice([5, 60, 200])
        values, first = np.unique(np.array(times), return_index=True)
        ends = len(ring) + np.append(first[1:], len(times)) - 1
        got = S._ring_counts(np.array(ring + times, dtype=np.int64), ends, values, w, cap, block=7)
        win, expect = list(ring), []
        for t in values.tolist():
            win = (win + [t] * times.count(t))[-cap:]
            expect.append(sum(1 for x in win if 0 <= t - x <= w))
        assert got.tolist() == expect


def test_batch_ids_unique_stable_and_unbounded(spark):
    df = spark.range(0, 5000, numPartitions=5).select(F.col("id").alias("x"))
    a = S.number_batch(df, 1 << 40).collect()
    b = S.number_batch(df, 1 << 40).collect()
    assert {r["event_id"] for r in a} == set(range(1 << 40, (1 << 40) + 5000))
    assert sorted((r["x"], r["event_id"]) for r in a) == sorted((r["x"], r["event_id"]) for r in b)
    big = S.number_batch(spark.range(0, 9_000_000, numPartitions=1), 0)  # more rows in a partition than 2 ** 23
    assert big.agg(F.max("event_id")).first()[0] == 8_999_999


def test_package_functions_ship_by_value():
    """Python workers may not have the package on their path (another
    working directory, a cluster without it installed): functions of the
    package used inside pandas folds must unpickle without importing it."""
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    blob = cloudpickle.dumps(S._alert_fold(60, 5, 100, 300))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = "import pickle, sys; f = pickle.loads(sys.stdin.buffer.read()); print(f.__name__)"
    out = subprocess.run([sys.executable, "-c", code], input=blob, capture_output=True, cwd="/", env=env, timeout=120)
    assert out.returncode == 0, out.stderr.decode()[-500:]


def test_late_check_does_not_count_later_events():
    import numpy as np

    seq = np.array([100, 100, 100, 100, 50], dtype=np.int64)
    assert S._ring_counts(seq, np.array([4]), np.array([50]), 60, 100).tolist() == [1]


def test_alerts_run_the_parser_once_a_line(spark, tmp_path, capsys):
    """Both patterns stand in the plan once; a filter on the flag would hold
    them again for every use of a captured group."""
    lines = S.stream_log_source(spark, str(tmp_path), fmt="parquet")
    S.stream_alerts(S.stream_parse_enrich(lines)).explain(True)
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.count("RLIKE(") == 2
