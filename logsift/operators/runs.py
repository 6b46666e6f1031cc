"""Run-comparison analytics over metric samples and run records.

A run is identified by ``w<workers>_r<rate>_b<batch>``.  Per-run statistics
are grouped aggregates over all runs in one job (not one process per run);
"last half of the samples" and "last sample" use a per-run rank from the
range-partitioned numbering, so a long run is not funnelled into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsift.functions.rows import side_by_side
from logsift.operators.sequence import number_rows

# --- fixed values ------------------------------------------------------------
RUN_ID_PATTERN = r"w(\d+)_r(\d+)_b(\d+)"
# p95 latency tiers (ms): below 50 Excellent, below 100 Good, above 200
# Investigate; the gap 100..200 has no name in the reference and is "Fair".
TIER_EXCELLENT_MS = 50
TIER_GOOD_MS = 100
TIER_INVESTIGATE_MS = 200
# ---------------------------------------------------------------------------


def parse_run_id(col: Column) -> dict[str, Column]:
    """workers, rate, batch parsed from a run id or a file name containing it."""
    return {
        name: F.regexp_extract(col, RUN_ID_PATTERN, i + 1).try_cast("int")
        for i, name in enumerate(["workers", "rate", "batch"])
    }


SORT_LIMIT = 10_000_000  # up to this many samples, ranking all of them is cheapest
APPROX_ACCURACY = 10_000
BROADCAST_RUNS = 100_000  # per-run thresholds are one row per run; broadcast up to this many


def steady_throughput(
    samples: DataFrame, run: str = "exp_id", sort_limit: int = SORT_LIMIT, accuracy: int = APPROX_ACCURACY
) -> DataFrame:
    """Per run: mean throughput over the last half of its samples (rows from
    index n // 2 in (runtime, sample) order) and the maximum throughput.

    Up to ``sort_limit`` samples every run is ranked (range partitioned).
    Above it, only the row at rank n // 2 of each run is located -- it lies
    next to the run's median runtime, so a checked ``percentile_approx``
    bracket around 0.5 contains it and only the bracket rows are ranked --
    and the mean is taken over the rows after it.
    """
    sizes = samples.groupBy(run).agg(F.count(F.lit(1)).alias("_n"), F.max("throughput_eps").alias("max_throughput"))
    sizes = _checkpoint(sizes)  # one row per run
    total, runs = sizes.agg(F.sum("_n"), F.count(F.lit(1))).collect()[0]
    if total and total > sort_limit:
        thresholds = _half_thresholds(samples, run, sizes, accuracy)
        if thresholds is not None:
            th = F.broadcast(thresholds) if runs <= BROADCAST_RUNS else thresholds
            key = F.struct("runtime_sec", "sample_id")
            after = samples.join(th, run, "left").filter(
                F.col("_k_rt").isNull() | (key > F.struct(F.col("_k_rt").alias("runtime_sec"),
                                                          F.col("_k_sid").alias("sample_id")))
            )
            avg = after.groupBy(run).agg(F.avg("throughput_eps").alias("avg_throughput"))
            return sizes.join(avg, run, "left").select(run, "avg_throughput", "max_throughput")
    ranked = number_rows(samples, order=["runtime_sec", "sample_id"], group=[run], name="_rn")
    return (
        ranked.join(sizes.select(run, "_n"), run)
        .groupBy(run)
        .agg(
            F.avg(F.when(F.col("_rn") > F.floor(F.col("_n") / 2), F.col("throughput_eps"))).alias("avg_throughput"),
            F.max("throughput_eps").alias("max_throughput"),
        )
    )


def _checkpoint(df: DataFrame) -> DataFrame:
    from logsift.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _half_thresholds(samples: DataFrame, run: str, sizes: DataFrame, accuracy: int) -> DataFrame | None:
    """Per run with n >= 2: the (runtime_sec, sample_id) of the row at rank
    n // 2, or None when a bracket check fails (caller ranks everything)."""
    eps = 3.0 / accuracy
    rt = F.col("runtime_sec")
    br = samples.groupBy(run).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx(rt, [max(0.0, 0.5 - eps), min(1.0, 0.5 + eps)], accuracy).alias("_b"),
        F.min(rt).alias("_min"), F.max(rt).alias("_max"),
    )
    small = F.col("_n") <= accuracy  # a small run's bracket is all of it
    br = br.select(
        run, (F.floor(F.col("_n") / 2)).cast("bigint").alias("_k"),
        F.when(small, F.col("_min")).otherwise(F.col("_b")[0]).alias("_lo"),
        F.when(small, F.col("_max")).otherwise(F.col("_b")[1]).alias("_hi"),
    ).filter(F.col("_k") >= 1)
    br = _checkpoint(br)
    tagged = samples.join(F.broadcast(br) if br.count() <= BROADCAST_RUNS else br, run)
    counts = tagged.groupBy(run).agg(
        F.count_if(rt < F.col("_lo")).alias("_below"),
        F.count_if(rt.between(F.col("_lo"), F.col("_hi"))).alias("_inside"),
    )
    checked = _checkpoint(br.join(counts, run))
    bad = checked.filter(~((F.col("_below") < F.col("_k")) & (F.col("_k") <= F.col("_below") + F.col("_inside"))))
    if bad.limit(1).count():
        return None
    inside = tagged.filter(rt.between(F.col("_lo"), F.col("_hi"))).select(run, "runtime_sec", "sample_id")
    ranked = number_rows(inside, order=["runtime_sec", "sample_id"], group=[run], name="_rn")
    return ranked.join(checked.select(run, "_k", "_below"), run).filter(
        F.col("_rn") == F.col("_k") - F.col("_below")
    ).select(run, F.col("runtime_sec").alias("_k_rt"), F.col("sample_id").alias("_k_sid"))


def run_report(samples: DataFrame, run: str = "exp_id") -> DataFrame:
    """Per run: steady and max throughput, mean CPU, max memory, and the
    alerts and events counters of the last sample."""
    per = samples.groupBy(run).agg(
        F.avg("cpu_percent").alias("avg_cpu"),
        F.max("memory_mb").alias("max_memory_mb"),
        F.max_by("alerts_count", F.struct("runtime_sec", "sample_id")).alias("total_alerts"),
        F.max_by("events_processed", F.struct("runtime_sec", "sample_id")).alias("total_events"),
    )
    return steady_throughput(samples, run).join(per, run)


def with_run_config(df: DataFrame, run: str = "exp_id") -> DataFrame:
    return df.withColumns(parse_run_id(F.col(run)))


def latency_tier(p95: Column) -> Column:
    return (
        F.when(p95 < TIER_EXCELLENT_MS, F.lit("Excellent"))
        .when(p95 < TIER_GOOD_MS, F.lit("Good"))
        .when(p95 > TIER_INVESTIGATE_MS, F.lit("Investigate"))
        .otherwise(F.lit("Fair"))
    )


def speedup_efficiency(steady: DataFrame) -> DataFrame:
    """Speedup against the run with the fewest workers at the same rate and
    batch, and efficiency = speedup / workers.  One row per run, so the
    window is over the run table (bounded by the number of runs)."""
    w = Window.partitionBy("rate", "batch").orderBy("workers", "exp_id")
    base = F.first("avg_throughput").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = steady.withColumn("baseline", base)
    sp = F.try_divide(F.col("avg_throughput"), F.col("baseline"))
    return out.withColumn("speedup", sp).withColumn("efficiency", F.try_divide(sp, F.col("workers")))


def unpivot_series(samples: DataFrame, columns: list[str], name: str, run: str = "exp_id") -> DataFrame:
    """(run, runtime_sec, <name>, value) rows for the given metric columns."""
    return samples.select(run, "runtime_sec", *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [run, "runtime_sec"], columns, name, "value"
    )


def success_counts(runs: DataFrame) -> DataFrame:
    """How many runs there were, succeeded and failed."""
    return runs.agg(F.count(F.lit(1)).alias("total_runs"), F.count_if("success").alias("successful"), F.count_if(~F.col("success")).alias("failed"))


def peak_summary(steady: DataFrame, samples: DataFrame, latency: DataFrame) -> DataFrame:
    """One row over all runs: their number, the peak throughput and its run,
    and the means of CPU, memory and latency."""
    r = lambda c: F.round(c, 6)
    best = steady.agg(F.count(F.lit(1)).alias("experiment_count"), r(F.max("avg_throughput")).alias("peak_throughput"),
                      F.min_by("exp_id", F.struct(-F.col("avg_throughput"), F.col("exp_id"))).alias("best_config"))
    load = samples.agg(r(F.avg("cpu_percent")).alias("avg_cpu"), r(F.avg("memory_mb")).alias("avg_memory_mb"))
    late = latency.agg(r(F.avg("mean")).alias("avg_latency_ms"), r(F.avg("p95")).alias("p95_latency_ms"))
    return side_by_side(best, load, late)
