"""Burst alerts: sliding count per address, threshold, greedy cooldown.

Rule (per address, over suspicious events): at time ``now`` the count is the
number of suspicious events with ``now - ts <= window`` (at most ``cap``, the
length of the per-address ring); ``count >= threshold`` makes ``now`` a
candidate; a candidate fires unless the address fired less than ``cooldown``
earlier.  Two evaluation schedules exist:

* event time -- ``now`` runs over the suspicious events themselves
  (:func:`alerts_event_time`);
* flush aligned -- ``now`` is the time of every full flush of ``batch``
  events and all addresses are evaluated there (:func:`alerts_flush_aligned`),
  as the batching indexer does.

Hot keys.  One address (e.g. the empty address of error lines without a
client) may hold a large share of all rows, so nothing here partitions by
address alone:

* the sliding count is a running sum of +1 / -1 steps over (address, time),
  range-partitioned, so a dense address is split over many tasks;
* the cooldown is sequential by nature (each firing depends on the previous
  one).  It is computed exactly in three distributed phases, see
  :func:`cooldown`.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from logsift.functions.rows import keep_where
from logsift.operators.sequence import number_rows
from logsift.schemas import ALERT_TYPE

# --- fixed values: the rule constants of the reference ----------------------
WINDOW_SEC = 60
THRESHOLD = 5
CAP = 100
COOLDOWN_SEC = 300
BATCH = 100
# ---------------------------------------------------------------------------
SLICE_SEC = 3600  # partitioning unit for hot keys; any value >= window and cooldown
FLUSH_CHUNK = 10_000  # flushes generated per task-sized piece of an active interval
SLICE_ROWS = 4_000_000  # rows of one (key, slice) group one task should hold (~100 MB)
_US = 1_000_000


def _slice_of(t_us: Column, slice_us: int) -> Column:
    return ((t_us - F.pmod(t_us, F.lit(slice_us))) / F.lit(slice_us)).cast("bigint")


def fit_slice_sec(points: DataFrame, key: str, slice_sec: int, min_sec: int, max_rows: int = SLICE_ROWS) -> int:
    """Slice width for (key, slice) partitioning: ``slice_sec`` unless its
    densest (key, slice) group holds more than ``max_rows`` rows, then
    narrowed in proportion, but never below ``min_sec`` (the window or the
    cooldown, which a slice must cover).  One partial aggregate, one number
    back to the driver."""
    densest = (
        points.groupBy(key, _slice_of(F.col("t_us"), slice_sec * _US).alias("_s"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.max("_n"))
        .collect()[0][0]
        or 0
    )
    if densest <= max_rows:
        return slice_sec
    return max(min_sec, slice_sec * max_rows // densest)


def suspicious_points(events: DataFrame, time_col: str = "indexed_at", key: str = "ip", stored: bool = False) -> DataFrame:
    """Narrow projection of suspicious events: (event_id, key, t_us).  With
    ``stored`` the flag is a column of a table and the filter reaches its scan;
    otherwise it is computed, and evaluated once."""
    kept = events.filter("suspicious") if stored else keep_where(events, F.col("suspicious"))
    return kept.select("event_id", key, F.unix_micros(F.col(time_col)).alias("t_us"))


def sliding_count(
    events: DataFrame,
    time_col: str = "indexed_at",
    window_sec: int = WINDOW_SEC,
    cap: int = CAP,
    key: str = "ip",
    stored: bool = False,
) -> DataFrame:
    """Per suspicious event: ``count`` = suspicious events of the same key in
    ``[t - window, t]`` (inclusive, ties included), at most ``cap``.

    Each time adds its events at ``t`` and takes them off just after
    ``t + window``; the count is the running sum of these steps.  That is
    linear in the events, and :func:`number_rows` splits one dense key over
    many tasks.

    Output: (event_id, key, t_us, count).
    """
    # narrow suspicious points, materialised once: read twice below
    pts = _checkpoint(suspicious_points(events, time_col, key, stored))
    per = pts.groupBy(key, "t_us").agg(F.count(F.lit(1)).alias("n"))
    step = F.explode(F.array(
        F.struct(F.col("t_us"), F.col("n").alias("d"), F.lit(True).alias("own")),
        F.struct((F.col("t_us") + window_sec * _US + 1).alias("t_us"), (-F.col("n")).alias("d"), F.lit(False).alias("own")),
    ))
    steps = per.select(key, step.alias("s")).select(key, "s.*").groupBy(key, "t_us").agg(F.sum("d").alias("d"), F.max("own").alias("own"))
    running = number_rows(steps, order=["t_us"], group=[key], sums={"count": F.col("d")})
    counts = running.filter("own").select(
        F.col(key).alias("_key"), F.col("t_us").alias("_t"), F.least(F.col("count"), F.lit(cap)).cast("bigint").alias("count"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("t_us") == F.col("_t"))  # a null key is a key
    return pts.join(counts, same).select("event_id", key, "t_us", "count")


def alert_candidates(counts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    return counts.filter(F.col("count") >= threshold)


# --- cooldown --------------------------------------------------------------

def _chain_heads(cooldown_us: int, slice_us: int, key: str):
    """Phase A body: per (key, slice), the exit of the chain from each head."""

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        t = np.unique(pdf["t_us"].to_numpy(dtype=np.int64))
        n = len(t)
        sl = int(pdf["slice"].iloc[0])
        nxt = np.searchsorted(t, t + cooldown_us, side="left")
        ptr = np.where(nxt < n, nxt, np.arange(n))
        while True:  # pointer doubling: ptr -> last firing inside the slice
            nxt_ptr = ptr[ptr]
            if np.array_equal(nxt_ptr, ptr):
                break
            ptr = nxt_ptr
        k = int(np.searchsorted(t, sl * slice_us + cooldown_us, side="left"))
        m = min(k + 1, n)  # heads: candidates before start+cooldown, plus the next one
        return pd.DataFrame(
            {key: pdf[key].iloc[0], "slice": sl, "t_us": t[:m], "exit_us": t[ptr[:m]]}
        )

    return fn


def _fires_from_entry(cooldown_us: int, key: str):
    """Phase C body: firings of one (key, slice) given the resolved entry."""

    def fn(cand: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        if cand.empty or entry.empty:
            return pd.DataFrame({key: pd.Series([], dtype=object), "t_us": pd.Series([], dtype="int64"),
                                 "count": pd.Series([], dtype="int64")})
        d = cand.groupby("t_us", as_index=False)["count"].max().sort_values("t_us")
        t = d["t_us"].to_numpy(dtype=np.int64)
        cnt = d["count"].to_numpy(dtype=np.int64)
        i = int(np.searchsorted(t, int(entry["t_us"].iloc[0]), side="left"))
        picks = []
        while i < len(t):
            picks.append(i)
            i = int(np.searchsorted(t, t[i] + cooldown_us, side="left"))
        return pd.DataFrame({key: cand[key].iloc[0], "t_us": t[picks], "count": cnt[picks]})

    return fn


def _checkpoint(df: DataFrame) -> DataFrame:
    from logsift.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


FOLD_LIMIT = 1_000_000  # candidates per key handled by one in-memory fold (~16 MB)


def _fold_key(cooldown_us: int, key: str):
    """Whole-key greedy fold (used only for keys below the size limit)."""

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        d = pdf.groupby("t_us", as_index=False)["count"].max().sort_values("t_us")
        t = d["t_us"].to_numpy(dtype=np.int64)
        cnt = d["count"].to_numpy(dtype=np.int64)
        picks, i = [], 0
        while i < len(t):
            picks.append(i)
            i = int(np.searchsorted(t, t[i] + cooldown_us, side="left"))
        return pd.DataFrame({key: pdf[key].iloc[0], "t_us": t[picks], "count": cnt[picks]})

    return fn


def cooldown(
    candidates: DataFrame,
    cooldown_sec: int = COOLDOWN_SEC,
    slice_sec: int = SLICE_SEC,
    key: str = "ip",
    fold_limit: int = FOLD_LIMIT,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Greedy cooldown, exact: per key, walk candidates in time order; fire
    when nothing fired in the last ``cooldown``.  Input (key, t_us, count);
    output the firing rows (key, t_us, count).

    Keys are split by a size check: a key with at most ``fold_limit``
    candidates is folded in one pandas group (bounded memory); hot keys above
    the limit go through :func:`cooldown_sliced`, which never puts one key's
    candidates in one task.  The check is a per-key count (one row per key);
    when no key is hot, the sliced path is not planned at all.
    """
    spark = candidates.sparkSession
    key_type = candidates.schema[key].dataType
    cand = _checkpoint(candidates.select(key, "t_us", F.col("count").cast("bigint").alias("count")))
    sizes = cand.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    out_schema = StructType([StructField(key, key_type), StructField("t_us", LongType()),
                             StructField("count", LongType())])
    hot_keys = sizes.filter(F.col("_n") > fold_limit).select(key)
    if hot_keys.limit(1).count() == 0:
        return cand.groupBy(key).applyInPandas(_fold_key(cooldown_sec * _US, key), out_schema)
    cold = cand.join(hot_keys, key, "left_anti")
    hot = cand.join(hot_keys, key, "left_semi")
    return cold.groupBy(key).applyInPandas(_fold_key(cooldown_sec * _US, key), out_schema).unionByName(
        cooldown_sliced(hot, cooldown_sec, slice_sec, key, slice_rows)
    )


def cooldown_sliced(
    candidates: DataFrame,
    cooldown_sec: int = COOLDOWN_SEC,
    slice_sec: int = SLICE_SEC,
    key: str = "ip",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Greedy cooldown for hot keys, exact, without a per-key task.

    Firing times form a chain ``next(x) = first candidate >= x + cooldown``.
    Time is cut into slices (>= cooldown):

    A. per (key, slice), in pandas: the chain from each *head* (a candidate
       in the first ``cooldown`` of the slice, or the first one after) and
       where it leaves the slice.  A chain can only enter a slice at a head.
    B. heads are linked to the head where the chain continues (an as-of
       lookup within the next slice); the chain from each key's first
       candidate is then resolved by pointer doubling -- ceil(log2(slices))
       rounds of equi-joins, each checkpointed.
    C. per (key, slice), in pandas: the firings from the resolved entry.

    Every Python group is one (key, slice); no key's candidates meet in one
    task, and no state is collected on the driver.  ``slice_sec`` is
    narrowed (down to the cooldown) when a (key, slice) group would exceed
    ``slice_rows`` candidates.
    """
    if slice_sec < cooldown_sec:
        raise ValueError("slice must be at least as long as the cooldown")
    spark = candidates.sparkSession
    key_type = candidates.schema[key].dataType
    slice_sec = fit_slice_sec(candidates, key, slice_sec, cooldown_sec, slice_rows)
    c_us, s_us = cooldown_sec * _US, slice_sec * _US
    cand = _checkpoint(
        candidates.select(key, "t_us", F.col("count").cast("bigint").alias("count")).withColumn(
            "slice", _slice_of(F.col("t_us"), s_us)
        )
    )  # read by phases A and C: computed once

    head_schema = StructType([StructField(key, key_type), StructField("slice", LongType()),
                              StructField("t_us", LongType()), StructField("exit_us", LongType())])
    heads = _checkpoint(cand.groupBy(key, "slice").applyInPandas(_chain_heads(c_us, s_us, key), head_schema))

    # B.1 per-slice summary and the next non-empty slices (rows per key are
    # bounded by the time span / slice length, not by the data volume)
    ws = Window.partitionBy(key).orderBy("slice")
    slices = heads.groupBy(key, "slice").agg(F.min("t_us").alias("first_us")).select(
        key, "slice", "first_us",
        F.lead("slice").over(ws).alias("n1"),
        F.lead("first_us").over(ws).alias("n1_first"),
        F.lead("first_us", 2).over(ws).alias("n2_first"),
    )
    # B.2 successor of every head: first candidate >= exit + cooldown
    h = heads.join(slices.select(key, "slice", "n1", "n1_first", "n2_first"), [key, "slice"])
    probes = h.filter(F.col("n1") == F.col("slice") + 1).select(
        key, F.col("n1").alias("slice"), (F.col("exit_us") + c_us).alias("v"), F.lit(0).alias("kind"),
        F.col("t_us").alias("src"),
    )
    targets = heads.select(key, "slice", F.col("t_us").alias("v"), F.lit(1).alias("kind"),
                           F.lit(None).cast("bigint").alias("src"))
    after = Window.partitionBy(key, "slice").orderBy("v", "kind").rowsBetween(Window.currentRow,
                                                                               Window.unboundedFollowing)
    found = (
        probes.unionByName(targets)
        .withColumn("hit", F.first(F.when(F.col("kind") == 1, F.col("v")), ignorenulls=True).over(after))
        .filter(F.col("kind") == 0)
        .select(key, F.col("src").alias("t_us"), F.col("hit"))
    )
    succ = (
        h.join(found, [key, "t_us"], "left")
        .select(
            key, "t_us",
            F.when(F.col("n1").isNull(), F.lit(None).cast("bigint"))
            .when(F.col("n1") > F.col("slice") + 1, F.col("n1_first"))
            .otherwise(F.coalesce(F.col("hit"), F.col("n2_first")))
            .alias("succ"),
        )
        .filter(F.col("succ").isNotNull())
    )
    # B.3 pointer doubling from each key's first head
    longest = slices.groupBy(key).count().agg(F.max("count")).collect()[0][0] or 0
    rounds = math.ceil(math.log2(longest)) if longest > 1 else 0
    chain = slices.groupBy(key).agg(F.min("first_us").alias("t_us"))
    jump = _checkpoint(succ)
    for r in range(rounds):
        step = chain.join(jump, [key, "t_us"]).select(key, F.col("succ").alias("t_us"))
        chain = _checkpoint(chain.unionByName(step))
        if r + 1 < rounds:
            a, b = jump.alias("a"), jump.alias("b")
            jump = _checkpoint(
                a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a.succ") == F.col("b.t_us")))
                .select(F.col(f"a.{key}").alias(key), F.col("a.t_us").alias("t_us"), F.col("b.succ").alias("succ"))
            )
    entries = chain.withColumn("slice", _slice_of(F.col("t_us"), s_us))

    # C. firings inside each slice from its entry
    out_schema = StructType([StructField(key, key_type), StructField("t_us", LongType()),
                             StructField("count", LongType())])
    return (
        cand.groupBy(key, "slice")
        .cogroup(entries.groupBy(key, "slice"))
        .applyInPandas(_fires_from_entry(c_us, key), out_schema)
    )


def alert_records(fires: DataFrame, window_sec: int = WINDOW_SEC, key: str = "ip") -> DataFrame:
    """Alert rows: type, address, count, window [t - window, t], created at t."""
    t = F.timestamp_micros(F.col("t_us"))
    return fires.select(
        F.lit(ALERT_TYPE).alias("alert_type"),
        F.col(key).alias("ip"),
        F.col("count").cast("bigint").alias("count"),
        F.timestamp_micros(F.col("t_us") - F.lit(window_sec * _US)).alias("window_start"),
        t.alias("window_end"),
        t.alias("created_at"),
    )


def alerts_event_time(
    events: DataFrame,
    time_col: str = "indexed_at",
    window_sec: int = WINDOW_SEC,
    threshold: int = THRESHOLD,
    cap: int = CAP,
    cooldown_sec: int = COOLDOWN_SEC,
    slice_sec: int = SLICE_SEC,
    stored: bool = False,
) -> DataFrame:
    """Alerts evaluated at every suspicious event (the live rule without
    batching artefacts); ``time_col`` is the clock (``indexed_at`` for the
    reference's processing-time behaviour, ``timestamp`` for log time);
    ``stored`` as in :func:`suspicious_points`."""
    counts = sliding_count(events, time_col, window_sec, cap, stored=stored)
    cands = alert_candidates(counts, threshold).select("ip", "t_us", "count")
    return alert_records(cooldown(cands, cooldown_sec, slice_sec), window_sec)


def recent_alerts(alerts: DataFrame, k: int = 0) -> DataFrame:
    """Alerts newest first, ties by address; the first ``k`` if ``k > 0``."""
    newest = alerts.orderBy(F.desc("created_at"), "ip")
    return newest.limit(k) if k > 0 else newest


# --- flush-aligned evaluation ---------------------------------------------

def flush_candidates(
    events: DataFrame,
    time_col: str = "indexed_at",
    batch: int = BATCH,
    window_sec: int = WINDOW_SEC,
    threshold: int = THRESHOLD,
    cap: int = CAP,
    flush_chunk: int = FLUSH_CHUNK,
) -> DataFrame:
    """(ip, flush_id, t_us = flush time, count) for every full flush at which
    an address has at least ``threshold`` suspicious events in the window.

    Events are numbered in (time, event_id) order by range partitioning; a
    suspicious event counts at the contiguous run of flushes from its own one
    up to the last flush no later than ``t + window``.  Per address that is
    a +1/-1 pair on the flush axis, so the count at each flush is a running
    sum over the change points -- no event x flush range join.
    """
    w_us = window_sec * _US
    spark = events.sparkSession
    t_us = F.unix_micros(F.col(time_col))
    # one pass: every event is an event row (kind 0); a suspicious one also
    # emits a probe row at t + window (kind 1) for the "last flush" lookup
    rows = events.select(
        "event_id", "ip", "suspicious", t_us.alias("t0"),
        F.explode(F.when(F.col("suspicious"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("kind"),
    ).select(
        "event_id", "ip", "kind",
        (F.col("suspicious") & (F.col("kind") == 0)).alias("suspicious"),
        (F.col("t0") + F.when(F.col("kind") == 1, F.lit(w_us)).otherwise(F.lit(0))).alias("t_us"),
    )
    numbered = _checkpoint(number_rows(
        rows,
        order=["t_us", "kind", "event_id"],
        sums={"n_events": (F.col("kind") == 0).cast("bigint")},
    ))
    total = numbered.agg(F.max("n_events")).collect()[0][0] or 0
    last_flush = total // batch - 1
    if last_flush < 0:
        return spark.createDataFrame([], "ip string, flush_id bigint, t_us bigint, count bigint")
    first = numbered.filter((F.col("kind") == 0) & F.col("suspicious")).select(
        "event_id", "ip", F.floor((F.col("n_events") - 1) / batch).cast("bigint").alias("f_lo")
    )
    last = numbered.filter(F.col("kind") == 1).select(
        "event_id", F.least(F.floor(F.col("n_events") / batch).cast("bigint") - 1, F.lit(last_flush)).alias("f_hi")
    )
    spans = first.join(last, "event_id").filter(F.col("f_lo") <= F.col("f_hi"))
    deltas = (
        spans.select("ip", F.col("f_lo").alias("f"), F.lit(1).alias("d"))
        .unionByName(spans.select("ip", (F.col("f_hi") + 1).alias("f"), F.lit(-1).alias("d")))
        .groupBy("ip", "f").agg(F.sum("d").alias("d"))
    )
    steps = number_rows(deltas, order=["f"], group=["ip"], sums={"cnt": F.col("d")})
    nxt = steps.select("ip", (F.col("rn") - 1).alias("rn"), F.col("f").alias("f_next"))
    # an interval of flushes where the address stays at or above the
    # threshold can span a whole run: expand it in two levels (chunk starts,
    # spread by hash, then <= flush_chunk flushes per chunk) so no single
    # task generates a long interval alone
    spans = (
        steps.join(nxt, ["ip", "rn"], "left")
        .filter(F.col("cnt") >= threshold)
        .select(
            "ip", "f",
            (F.coalesce(F.col("f_next"), F.lit(last_flush + 1)) - 1).alias("f_end"),
            F.least(F.col("cnt"), F.lit(cap)).cast("bigint").alias("count"),
        )
    )
    chunks = spans.select(
        "ip", "f_end", "count", F.explode(F.sequence(F.col("f"), F.col("f_end"), F.lit(flush_chunk).cast("bigint"))).alias("c0")
    ).repartition("ip", "c0")
    active = chunks.select(
        "ip", "count",
        F.explode(F.sequence(F.col("c0"), F.least(F.col("c0") + (flush_chunk - 1), F.col("f_end")))).alias("flush_id"),
    )
    flushes = numbered.filter(
        (F.col("kind") == 0) & (F.pmod(F.col("n_events"), F.lit(batch)) == 0)
    ).select((F.col("n_events") / batch - 1).cast("bigint").alias("flush_id"), F.col("t_us"))
    return active.join(flushes, "flush_id").select("ip", "flush_id", "t_us", "count")


def alerts_flush_aligned(
    events: DataFrame,
    time_col: str = "indexed_at",
    batch: int = BATCH,
    window_sec: int = WINDOW_SEC,
    threshold: int = THRESHOLD,
    cap: int = CAP,
    cooldown_sec: int = COOLDOWN_SEC,
    slice_sec: int = SLICE_SEC,
    flush_chunk: int = FLUSH_CHUNK,
) -> DataFrame:
    """Alerts as the batching indexer raises them: evaluated for every
    address at each full flush of ``batch`` events (the final partial flush
    is not evaluated), with the same window, cap, threshold and cooldown."""
    cands = flush_candidates(events, time_col, batch, window_sec, threshold, cap, flush_chunk)
    fires = cooldown(cands.select("ip", "t_us", "count"), cooldown_sec, slice_sec)
    return alert_records(fires, window_sec)
