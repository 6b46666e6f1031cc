"""Alert rule against a brute-force Python version of it, on random and
hand-made inputs; the hot-key (sliced) path against the per-key fold; the
flush-aligned form against a direct evaluation; streaming against batch."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from logsift.operators import alerts as A

S = 1_000_000


def brute_candidates(points, window=60 * S, cap=100, threshold=5):
    by_ip = defaultdict(list)
    for ip, t in points:
        by_ip[ip].append(t)
    out = {}
    for ip, ts in by_ip.items():
        for t in set(ts):
            n = min(cap, sum(1 for x in ts if t - window <= x <= t))
            if n >= threshold:
                out[(ip, t)] = n
    return out


def brute_alerts(points, cooldown=300 * S, **kw):
    cands = brute_candidates(points, **kw)
    fires = []
    for ip in sorted({ip for ip, _ in cands}):
        last = None
        for t in sorted(t for i, t in cands if i == ip):
            if last is None or t - last >= cooldown:
                fires.append((ip, t, cands[(ip, t)]))
                last = t
    return sorted(fires)


def to_events(spark, points):
    rows = [(i, ip, t, True) for i, (ip, t) in enumerate(points)]
    df = spark.createDataFrame(rows, "event_id long, ip string, t long, suspicious boolean")
    return df.withColumn("ts", F.timestamp_micros("t"))


def spark_alerts(spark, points, fold_limit=A.FOLD_LIMIT, slice_sec=A.SLICE_SEC):
    ev = to_events(spark, points)
    counts = A.sliding_count(ev, time_col="ts")
    cands = A.alert_candidates(counts).select("ip", "t_us", "count")
    fires = A.cooldown(cands, slice_sec=slice_sec, fold_limit=fold_limit)
    return sorted((r["ip"], r["t_us"], r["count"]) for r in fires.collect())


def random_points(seed, n=600, ips=("", "a", "b"), span_sec=4 * 3600):
    rnd = random.Random(seed)
    pts = []
    for _ in range(n):
        ip = rnd.choice(ips)
        base = rnd.randrange(0, span_sec) * S
        burst = rnd.randrange(1, 8)
        for k in range(burst):
            pts.append((ip, base + k * rnd.randrange(0, 20) * S))
    return pts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_brute_force(spark, seed):
    pts = random_points(seed)
    expect = brute_alerts(pts)
    assert spark_alerts(spark, pts) == expect
    # hot-key path: every key sliced (10 minute slices -> many slices, doubling rounds)
    assert spark_alerts(spark, pts, fold_limit=0, slice_sec=600) == expect


def test_window_edges_and_cooldown(spark):
    t0 = 10_000 * S
    four = [("x", t0 + i * S) for i in range(4)]
    assert spark_alerts(spark, four) == []
    five = [("x", t0 + i * S) for i in range(5)]
    assert spark_alerts(spark, five) == [("x", t0 + 4 * S, 5)]
    edge = [("x", t0)] + [("x", t0 + 60 * S - 3 + i) for i in range(4)]  # first exactly 60 s before the 5th
    assert spark_alerts(spark, edge) == [("x", t0 + 60 * S, 5)]
    outside = [("x", t0)] + [("x", t0 + 60 * S - 2 + i) for i in range(4)]  # 60 s + 1 us
    assert spark_alerts(spark, outside) == []
    burst = [("x", t0 + i * S) for i in range(5)]  # fires at t0 + 4 s
    early = [("x", t0 + 4 * S + 295 * S + i * S) for i in range(5)]  # 5th at 299 s after the alert
    late = [("x", t0 + 4 * S + 296 * S + i * S) for i in range(5)]  # 5th exactly 300 s after
    assert spark_alerts(spark, burst + early) == [("x", t0 + 4 * S, 5)]
    assert spark_alerts(spark, burst + late) == [("x", t0 + 4 * S, 5), ("x", t0 + 304 * S, 5)]
    assert spark_alerts(spark, burst + late) == brute_alerts(burst + late)


def test_cap_at_100(spark):
    pts = [("x", 50_000 * S + i * 100_000) for i in range(150)]
    ev = to_events(spark, pts)
    top = A.sliding_count(ev, time_col="ts").agg(F.max("count")).collect()[0][0]
    assert top == 100


def test_hot_key_spread_over_slices(spark):
    pts = [("", 7 * 3600 * S + i * 7 * S) for i in range(3000)]  # ~6 hours, one key
    assert spark_alerts(spark, pts, fold_limit=0, slice_sec=900) == brute_alerts(pts)


def test_one_dense_minute_is_linear(spark):
    """A million events of one address within a minute, ties included."""
    ev = (spark.range(1_000_000).select(F.col("id").alias("event_id"), F.lit("").alias("ip"), F.lit(True).alias("suspicious"),
                                        F.timestamp_micros((F.col("id") / 2).cast("long") * 100).alias("ts")))
    got = A.sliding_count(ev, time_col="ts", cap=10_000_000).agg(
        F.count(F.lit(1)), F.max("count"), F.count_if(F.col("count") != F.floor(F.col("event_id") / 2) * 2 + 2)).collect()[0]
    assert tuple(got) == (1_000_000, 1_000_000, 0)


def test_dense_hot_key_narrows_slices(spark):
    """A key far denser than the per-slice row limit: the sliced cooldown
    narrows its slices (down to the cooldown) and stays exact."""
    rnd = random.Random(11)
    pts = [("", 3 * 3600 * S + i * 700_000 + rnd.randrange(0, 500_000)) for i in range(4000)]  # ~47 min
    pts += [("b", 3 * 3600 * S + i * 9 * S) for i in range(300)]
    ev = to_events(spark, pts)
    assert A.fit_slice_sec(A.suspicious_points(ev, "ts"), "ip", 3600, 60, max_rows=500) < 3600
    counts = A.sliding_count(ev, time_col="ts")
    cands = A.alert_candidates(counts).select("ip", "t_us", "count")
    fires = A.cooldown(cands, fold_limit=0, slice_rows=50)
    got = sorted((r["ip"], r["t_us"], r["count"]) for r in fires.collect())
    assert got == brute_alerts(pts)


def brute_flush(points_all, batch, window=60 * S, cap=100, threshold=5, cooldown=300 * S):
    """points_all: (event_id, ip, t, suspicious) in arrival order."""
    rows = sorted(points_all, key=lambda r: (r[2], r[0]))
    flushes = [(f, rows[(f + 1) * batch - 1][2]) for f in range(len(rows) // batch)]
    cands = defaultdict(list)
    for f, ft in flushes:
        seen = rows[: (f + 1) * batch]
        per = defaultdict(int)
        for eid, ip, t, s in seen:
            if s and t >= ft - window:
                per[ip] += 1
        for ip, n in per.items():
            if n >= threshold:
                cands[ip].append((ft, min(cap, n)))
    fires = []
    for ip, lst in cands.items():
        last = None
        for ft, n in sorted(lst):
            if last is None or ft - last >= cooldown:
                fires.append((ip, ft, n))
                last = ft
    return sorted(fires)


def test_flush_aligned_against_brute_force(spark):
    rnd = random.Random(7)
    pts = []
    t = 20_000 * S
    for eid in range(1500):
        t += rnd.randrange(0, 3) * S
        pts.append((eid, rnd.choice(["", "a", "b", "c"]), t, rnd.random() < 0.45))
    df = spark.createDataFrame(pts, "event_id long, ip string, t long, suspicious boolean").withColumn(
        "ts", F.timestamp_micros("t"))
    got = A.alerts_flush_aligned(df, time_col="ts", batch=20).select(
        "ip", F.unix_micros("created_at").alias("t"), "count")
    assert sorted(tuple(r) for r in got.collect()) == brute_flush(pts, 20)
    sliced = A.alerts_flush_aligned(df, time_col="ts", batch=20, slice_sec=600)
    assert sliced.count() == len(brute_flush(pts, 20))
    # long active intervals expanded in small chunks give the same candidates
    whole = A.flush_candidates(df, time_col="ts", batch=20)
    chunked = A.flush_candidates(df, time_col="ts", batch=20, flush_chunk=3)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, chunked.collect()))
    assert whole.count() > 20


def test_null_key_is_a_key(spark):
    rows = [(i, ip, i * S) for i, ip in enumerate([None, "a"] * 6)]
    events = spark.createDataFrame(rows, "event_id long, ip string, t long").select(
        "event_id", "ip", F.timestamp_micros("t").alias("indexed_at"), F.lit(True).alias("suspicious"))
    counts = A.sliding_count(events)
    assert counts.columns == ["event_id", "ip", "t_us", "count"]
    assert sorted((r.event_id, r["count"]) for r in counts.collect()) == [(i, i // 2 + 1) for i in range(12)]
    assert {(r.ip, r.t_us) for r in A.cooldown(A.alert_candidates(counts)).collect()} == {(None, 8 * S), ("a", 9 * S)}
