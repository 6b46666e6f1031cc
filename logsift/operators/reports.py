"""Reports over the events and alerts tables: top-k, summaries, latency.

Top-k uses ``orderBy(...).limit(k)`` with a small fixed k, which Spark plans
as TakeOrderedAndProject over a partial+final aggregate (only k rows per
partition cross the network).  Exact percentiles are computed from a global
rank (range-partitioned numbering) and a join on the handful of ranks that
are needed, never by collecting a column into one aggregation buffer.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.functions.rows import side_by_side
from logsift.operators.sequence import number_rows

PERCENTILES = {"p50": 0.50, "p90": 0.90, "p95": 0.95, "p99": 0.99}
ROUND = 6


def latency_ms(ingested: str = "ingested_at", indexed: str = "indexed_at") -> Column:
    """Milliseconds between arrival and indexing (microsecond exact)."""
    return (F.unix_micros(F.col(indexed)) - F.unix_micros(F.col(ingested))) / F.lit(1000.0)


def known_latency(events: DataFrame) -> DataFrame:
    """Events whose two timestamps are both known, with ``latency_ms``."""
    return events.filter(F.col("indexed_at").isNotNull() & F.col("ingested_at").isNotNull()).withColumn(
        "latency_ms", latency_ms()
    )


def top_counts(df: DataFrame, key: str, k: int, name: str = "cnt") -> DataFrame:
    """Count per key, largest first, ties by key, first ``k``."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.asc(key)).limit(k)


def _r(c: Column) -> Column:
    return F.round(c, ROUND)


def _quantile_spec(n: int, probs: dict[str, float]) -> list[tuple[str, int, int, float]]:
    """(name, lower rank, upper rank, fraction) of numpy's linear method (1-based ranks)."""
    need = []
    for name, p in probs.items():
        pos = p * (n - 1)
        lo = math.floor(pos)
        need.append((name, lo + 1, min(lo + 2, n), pos - lo))
    return need


def _interpolate(spark, need, picked: DataFrame, value: str, probs: dict[str, float]) -> DataFrame:
    """One row of quantiles from the values at the needed ranks (``rn``,
    value): at most two rows per quantile reach the driver."""
    at = {r["rn"]: r[value] for r in picked.collect()}
    row = tuple(at[lo] + frac * (at[hi] - at[lo]) for _, lo, hi, frac in need)
    return spark.createDataFrame([row], ", ".join(f"{k} double" for k in probs))


APPROX_ACCURACY = 10_000  # bracket width ~ a few n / accuracy rows per quantile
SORT_LIMIT = 10_000_000  # up to this many rows, ranking the whole (narrow) column is cheapest


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    tie: str,
    accuracy: int = APPROX_ACCURACY,
    sort_limit: int = SORT_LIMIT,
    materialise: bool = True,
) -> DataFrame:
    """One row: linearly interpolated quantiles of ``value`` (numpy's default
    method), exact.  The narrow (value, tie) projection is checkpointed
    first unless ``materialise`` is False (input already materialised).

    Up to ``sort_limit`` rows the column is ranked by a range-partitioned
    numbering.  Above it the whole column is never sorted:

    1. one aggregate pass: ``percentile_approx`` values just below and above
       every needed rank (mergeable sketches, bounded memory);
    2. one counting pass: rows strictly below / inside each bracket;
    3. only the rows inside the brackets are ranked (range-partitioned
       numbering per bracket); global rank = rows below + rank in bracket.

    The counts of step 2 prove that each needed rank lies inside its
    bracket; if one does not (the sketch guarantee makes that unexpected),
    the whole column is ranked instead.  ``tie`` makes the order unique.
    """
    spark = df.sparkSession
    vals = df.select(value, tie).filter(F.col(value).isNotNull())
    if materialise:  # every later pass reads 16 bytes per row, not the upstream plan
        vals = _checkpoint(vals)
    x = F.col(value)
    n = vals.count()
    if n == 0:
        return spark.createDataFrame([tuple([None] * len(probs))], ", ".join(f"{k} double" for k in probs))
    need = _quantile_spec(n, probs)
    ranks = sorted({r for _, a, b, _ in need for r in (a, b)})
    if n <= max(sort_limit, accuracy):
        picked = number_rows(vals, order=[value, tie])
        return _interpolate(spark, need, picked.filter(F.col("rn").isin(ranks)).select("rn", value), value, probs)
    eps = 3.0 / accuracy
    probe_p = sorted({min(1.0, max(0.0, p + d)) for p in probs.values() for d in (-eps, eps)})
    first = vals.agg(F.percentile_approx(x, probe_p, accuracy).alias("b")).collect()[0]
    at = dict(zip(probe_p, first["b"]))
    brackets = []  # (lower value, upper value, lowest rank, highest rank) per quantile
    for (_, r_lo, r_hi, _), p in zip(need, probs.values()):
        brackets.append((at[min(1.0, max(0.0, p - eps))], at[min(1.0, max(0.0, p + eps))], r_lo, r_hi))
    counts = vals.agg(
        *[F.count_if(x < F.lit(lo)).alias(f"b{i}") for i, (lo, _, _, _) in enumerate(brackets)],
        *[F.count_if(x.between(F.lit(lo), F.lit(hi))).alias(f"i{i}") for i, (lo, hi, _, _) in enumerate(brackets)],
    ).collect()[0]
    below = [counts[f"b{i}"] for i in range(len(brackets))]
    ok = all(below[i] < r_lo and r_hi <= below[i] + counts[f"i{i}"]
             for i, (_, _, r_lo, r_hi) in enumerate(brackets))
    if not ok:
        picked = number_rows(vals, order=[value, tie])
    else:
        tags = F.array(*[F.when(x.between(F.lit(lo), F.lit(hi)), F.lit(i)) for i, (lo, hi, _, _) in enumerate(brackets)])
        offsets = F.element_at(F.array(*[F.lit(below[i]) for i in range(len(brackets))]).cast("array<bigint>"),
                               F.col("_b") + 1)
        in_brackets = vals.select(value, tie, F.explode(F.array_compact(tags)).alias("_b"))
        picked = (
            number_rows(in_brackets, order=[value, tie], group=["_b"])
            .select((F.col("rn") + offsets).alias("rn"), value)
            .filter(F.col("rn").isin(ranks))
            .distinct()  # overlapping brackets give the same (rank, value) twice
        )
    return _interpolate(spark, need, picked.filter(F.col("rn").isin(ranks)).select("rn", value), value, probs)


def latency_stats(events: DataFrame) -> DataFrame:
    """count, mean, median, std (population), min, max, p50/p90/p95/p99."""
    spark = events.sparkSession
    lat = _checkpoint(known_latency(events).select("latency_ms", "event_id"))  # narrow, read by every pass
    b = lat.agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("latency_ms").alias("mean"),
        F.stddev_pop("latency_ms").alias("std"),
        F.min("latency_ms").alias("min"),
        F.max("latency_ms").alias("max"),
    ).collect()[0]
    probs = {"median": 0.5, **PERCENTILES}
    q = exact_quantiles(lat, "latency_ms", probs, "event_id", materialise=False).collect()[0]
    stats = ["mean", "std", "min", "max"]
    row = (b["count"], *[b[c] for c in stats], *[q[c] for c in probs])
    one = spark.createDataFrame([row], "count bigint, " + ", ".join(f"{c} double" for c in [*stats, *probs]))
    return one.select("count", *[_r(F.col(c)).alias(c) for c in ["mean", "median", "std", "min", "max", *PERCENTILES]])


#: Size of the quantile sketches (the k of the KLL sketch).
SKETCH_K = 800


def rank_error(k: int = SKETCH_K) -> float:
    """Rank error of a KLL sketch of size ``k``, as a share of the rows, that a
    quantile exceeds with probability of about one in a hundred: the normalised
    error that the sketch's authors give, 2.296 / k ** 0.9021; doubled here."""
    return 2 * 2.296 / k**0.9021


def latency_sketches(events: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One row per day of ``indexed_at``: counts, sums and a mergeable quantile
    sketch of the latency, to be stored beside the events.  A report over any
    days merges their rows and reads no event."""
    x = F.col("latency_ms")
    return known_latency(events).groupBy(F.to_date("indexed_at").alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("sum"), F.sum(x * x).alias("squares"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.kll_sketch_agg_double(x, k).alias("sketch"))


def sketch_stats(sketches: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """The latency statistics of the merged daily rows: count, mean, std, min
    and max exact, the quantiles within :func:`rank_error` of their ranks."""
    n = F.sum("n")
    one = sketches.agg(n.alias("count"), (F.sum("sum") / n).alias("mean"),
                       F.sqrt(F.greatest(F.sum("squares") / n - F.pow(F.sum("sum") / n, 2), F.lit(0.0))).alias("std"),
                       F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch", k).alias("_sketch"))
    quantile = lambda p: F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(p)))
    return one.select(F.coalesce("count", F.lit(0)).alias("count"), "mean", quantile(0.5).alias("median"), "std", "min", "max",
                      *[quantile(p).alias(c) for c, p in PERCENTILES.items()])


def latency_stats_approx(events: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """The statistics of :func:`latency_stats` by daily sketches: one pass,
    partial sketches of bounded size in every task, no sort."""
    return sketch_stats(latency_sketches(events, k), k)


def check_approx(events: DataFrame, stats: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Per quantile of ``stats``: whether its rank among the events' latencies
    is within :func:`rank_error` of the asked one (counted exactly)."""
    probs = {"median": 0.5, **PERCENTILES}
    one = _checkpoint(stats)
    x = F.col("latency_ms")
    value = {c: one.select(c).scalar() for c in probs}
    ranks = known_latency(events).agg(*[F.count_if(x < v).alias(f"b_{c}") for c, v in value.items()], *[F.count_if(x <= v).alias(f"u_{c}") for c, v in value.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(float(p)).alias("p"), F.col(f"b_{c}").alias("below"), F.col(f"u_{c}").alias("upto")) for c, p in probs.items()])
    e = rank_error(k)
    return side_by_side(ranks, one.select("count", *[_r(F.col(c)).alias(c) for c in ("mean", "min", "max")])).select(
        "count", "mean", "min", "max", F.explode(rows).alias("q")).select(
        "q.name", "q.p", "count",
        ((F.col("q.below") <= F.ceil((F.col("q.p") + e) * F.col("count"))) & (F.col("q.upto") >= F.floor((F.col("q.p") - e) * F.col("count")))).alias("within_bound"),
        "mean", "min", "max")


def latency_avg_min_max(events: DataFrame) -> DataFrame:
    lat = known_latency(events)
    return lat.agg(
        _r(F.avg("latency_ms")).alias("avg_latency_ms"),
        _r(F.min("latency_ms")).alias("min_latency_ms"),
        _r(F.max("latency_ms")).alias("max_latency_ms"),
    )


def report_columns(events: DataFrame) -> DataFrame:
    """The columns that alerts and summaries read, materialised: the events (a
    parse, perhaps) are evaluated once however many reports follow."""
    return _checkpoint(events.select("event_id", "ip", "suspicious", "ingested_at", "indexed_at"))


def run_summary(events: DataFrame, alerts: DataFrame) -> DataFrame:
    """Totals, suspicious share, alerts, runtime (first arrival to last index)
    and throughput.  Empty input gives NULL ratios instead of an error."""
    ev = events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("suspicious")).alias("suspicious_events"),
        ((F.unix_micros(F.max("indexed_at")) - F.unix_micros(F.min("ingested_at"))) / F.lit(1e6)).alias("runtime_sec"),
    )
    al = alerts.agg(F.count(F.lit(1)).alias("total_alerts"))
    return side_by_side(ev, al).select(
        "total_events",
        "suspicious_events",
        _r(F.try_divide(F.col("suspicious_events") * 100.0, F.col("total_events"))).alias("suspicious_pct"),
        "total_alerts",
        _r(F.col("runtime_sec")).alias("runtime_sec"),
        _r(F.try_divide(F.col("total_events").cast("double"), F.col("runtime_sec"))).alias("throughput_eps"),
    )


def export_summary(events: DataFrame) -> DataFrame:
    """Total, top-10 status, top-50 address as (section, key, value) rows."""
    total = events.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("Total Events").alias("section"), F.lit("").alias("key"), "value"
    )
    status = top_counts(events, "status", 10, "value").select(
        F.lit("Status").alias("section"), F.col("status").cast("string").alias("key"), "value"
    )
    ips = top_counts(events, "ip", 50, "value").select(F.lit("Top IP").alias("section"), F.col("ip").alias("key"), "value")
    return total.unionByName(status).unionByName(ips)


BROADCAST_GROUPS = 100_000  # bracket rows per group are tiny; broadcast up to this many groups


def grouped_quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    tie: str,
    group: list[str],
    accuracy: int = APPROX_ACCURACY,
    sort_limit: int = SORT_LIMIT,
) -> DataFrame:
    """Exact linearly interpolated quantiles per group.  Output: group
    columns + one column per quantile.

    Up to ``sort_limit`` rows in total every group is ranked (range
    partitioned, so a huge group is spread over many tasks).  Above it, the
    per-group analogue of :func:`exact_quantiles`: ``percentile_approx``
    brackets per group, one counting pass that proves every needed rank lies
    in its bracket, and only the bracket rows are ranked.  The bracket table
    (groups x quantiles) is broadcast when the number of groups is below
    ``BROADCAST_GROUPS``, else joined by a shuffle.
    """
    vals = _checkpoint(df.select(*group, value, tie).filter(F.col(value).isNotNull()))  # read by every pass
    names = list(probs)
    eps = 3.0 / accuracy
    probe_p = sorted({min(1.0, max(0.0, p + d)) for p in probs.values() for d in (-eps, eps)})
    idx = {p: i for i, p in enumerate(probe_p)}
    sizes = _checkpoint(vals.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")))  # one row per group
    total, n_groups = sizes.agg(F.sum("_n"), F.count(F.lit(1))).collect()[0]
    if not total or total <= sort_limit:
        return _grouped_by_sort(vals, value, probs, tie, group, sizes)
    first = _checkpoint(vals.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx(value, probe_p, accuracy).alias("_pb"),
        F.min(value).alias("_min"), F.max(value).alias("_max"),
    ))
    small = F.col("_n") <= accuracy  # a small group's bracket is all of it (<= accuracy rows)

    def br_lo(p: float) -> Column:
        return F.when(small, F.col("_min")).otherwise(F.col("_pb")[idx[min(1.0, max(0.0, p - eps))]])

    def br_hi(p: float) -> Column:
        return F.when(small, F.col("_max")).otherwise(F.col("_pb")[idx[min(1.0, max(0.0, p + eps))]])
    # per (group, quantile): needed ranks, fraction, bracket values
    spec = F.array(*[
        F.struct(
            F.lit(i).alias("k"), F.lit(float(p)).alias("p"), br_lo(p).alias("lo"), br_hi(p).alias("hi"),
        )
        for i, p in enumerate(probs.values())
    ])
    pos = F.col("_q.p") * (F.col("_n") - 1)
    specs = first.select(*group, "_n", F.explode(spec).alias("_q")).select(
        *group, F.col("_q.k").alias("_k"), F.col("_q.lo").alias("_lo"), F.col("_q.hi").alias("_hi"),
        (F.floor(pos) + 1).cast("bigint").alias("lo_rn"),
        F.least(F.floor(pos) + 2, F.col("_n")).cast("bigint").alias("hi_rn"),
        (pos - F.floor(pos)).alias("frac"),
    )
    brackets = first.select(*group, F.array(*[
        F.struct(br_lo(p).alias("lo"), br_hi(p).alias("hi")) for p in probs.values()
    ]).alias("_br"))
    if n_groups <= BROADCAST_GROUPS:
        brackets = F.broadcast(brackets)
    tagged = vals.join(brackets, group).select(*group, value, tie, F.posexplode("_br").alias("_k", "_b"))
    x = F.col(value)
    counts = tagged.groupBy(*group, "_k").agg(
        F.count_if(x < F.col("_b.lo")).alias("_below"),
        F.count_if(x.between(F.col("_b.lo"), F.col("_b.hi"))).alias("_inside"),
    )
    checked = specs.join(counts, [*group, "_k"], "left").fillna(0, ["_below", "_inside"])
    checked = _checkpoint(checked)
    bad = checked.filter(
        ~((F.col("_below") < F.col("lo_rn")) & (F.col("hi_rn") <= F.col("_below") + F.col("_inside")))
    ).limit(1).count()
    if bad:
        return _grouped_by_sort(vals, value, probs, tie, group, first.select(*group, "_n"))
    inside = tagged.filter(x.between(F.col("_b.lo"), F.col("_b.hi"))).select(*group, "_k", value, tie)
    ranked = number_rows(inside, order=[value, tie], group=[*group, "_k"]).join(
        checked.select(*group, "_k", "_below", "lo_rn", "hi_rn", "frac"), [*group, "_k"]
    ).withColumn("rn", F.col("rn") + F.col("_below"))
    lo = ranked.filter(F.col("rn") == F.col("lo_rn")).select(*group, "_k", "frac", F.col(value).alias("lo_v"))
    hi = ranked.filter(F.col("rn") == F.col("hi_rn")).select(*group, "_k", F.col(value).alias("hi_v"))
    q = lo.join(hi, [*group, "_k"]).select(
        *group, "_k", (F.col("lo_v") + F.col("frac") * (F.col("hi_v") - F.col("lo_v"))).alias("q")
    )
    name_of = F.element_at(F.array(*[F.lit(nm) for nm in names]), F.col("_k") + 1)
    return q.withColumn("name", name_of).groupBy(*group).pivot("name", names).agg(F.first("q"))


def _checkpoint(df: DataFrame) -> DataFrame:
    from logsift.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _grouped_by_sort(vals: DataFrame, value: str, probs: dict[str, float], tie: str, group: list[str],
                     sizes: DataFrame) -> DataFrame:
    """Rank within every group (range partitioned) and pick the needed ranks."""
    ranked = number_rows(vals, order=[value, tie], group=group)
    spec = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(float(p)).alias("p")) for k, p in probs.items()])
    pos = F.col("_q.p") * (F.col("_n") - 1)
    specs = sizes.select(*group, "_n", F.explode(spec).alias("_q")).select(
        *group,
        F.col("_q.name").alias("name"),
        (F.floor(pos) + 1).cast("bigint").alias("lo_rn"),
        F.least(F.floor(pos) + 2, F.col("_n")).cast("bigint").alias("hi_rn"),
        (pos - F.floor(pos)).alias("frac"),
    )
    lo = ranked.select(*group, F.col("rn").alias("lo_rn"), F.col(value).alias("lo_v"))
    hi = ranked.select(*group, F.col("rn").alias("hi_rn"), F.col(value).alias("hi_v"))
    q = specs.join(lo, [*group, "lo_rn"]).join(hi, [*group, "hi_rn"]).select(
        *group, "name", (F.col("lo_v") + F.col("frac") * (F.col("hi_v") - F.col("lo_v"))).alias("q")
    )
    return q.groupBy(*group).pivot("name", list(probs)).agg(F.first("q"))
