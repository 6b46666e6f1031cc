"""Log-file preparation: flag lines, keep every suspicious line, sample the
normal ones exactly, shuffle, write.

Randomness is a hash of (seed, key), so a run is reproducible and the same
in any engine: "random sample of N" = the N smallest hashes, "shuffle" =
order by hash.  Hashes are even, so ranges of them are known beforehand, and
neither the sample nor the shuffled file passes through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsift.functions.enrich import suspicious_line
from logsift.operators.sequence import smallest_rows

SEED = "42"


def rand_key(key: str, seed: str = SEED) -> Column:
    """md5 of seed || key (hex) -- uniform, reproducible sort key.  A null key
    counts as empty text."""
    return F.md5(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def flag_lines(lines: DataFrame) -> DataFrame:
    """Adds ``suspicious`` (raw-line rule) to cleaned lines."""
    return lines.withColumn("suspicious", suspicious_line(F.col("line")))


def line_class_stats(flagged: DataFrame) -> DataFrame:
    """Total, normal and suspicious line counts and the suspicious share."""
    agg = flagged.agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(~F.col("suspicious")).alias("normal_lines"),
        F.count_if(F.col("suspicious")).alias("suspicious_lines"),
    )
    return agg.withColumn(
        "suspicious_pct",
        F.round(F.try_divide(F.col("suspicious_lines") * 100.0, F.col("total_lines")), 6),
    )


_PREFIX_TOP = 1 << 60  # 15 hex digits


def _hash_prefix(h: Column) -> Column:
    """First 15 hex digits of an md5 as a number: never decreases along the hex order."""
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def sample_normal_keep_suspicious(flagged: DataFrame, n: int, key: str = "line_id", seed: str = SEED) -> DataFrame:
    """All suspicious lines plus exactly ``n`` normal lines drawn uniformly
    without replacement -- only when ``0 < n < #normal``; otherwise all.

    The sample is the ``n`` smallest ``md5(seed || key)``, selected by hash
    ranges (:func:`logsift.operators.sequence.smallest_rows`): one pass over
    the lines' hashes and one that writes the kept lines, at any ``n``; the
    lines are neither sorted nor gathered.  ``key`` must be unique.
    """
    if n <= 0:
        return flagged
    hashed = flagged.withColumn("_h", rand_key(key, seed))
    picked = smallest_rows(hashed, _hash_prefix(F.col("_h")), _PREFIX_TOP, ["_h", key], n, also=F.col("suspicious"))
    return picked.drop("_h")


def random_order(lines: DataFrame, key: str = "line_id", seed: str = SEED) -> DataFrame:
    """Lines sorted in a reproducible random order (one range shuffle).  The
    order has a seed of its own: with the sampler's it would put the sampled
    lines, which have the smallest hashes, first."""
    return lines.orderBy(rand_key(key, f"{seed}-order"), key)


def shuffle_lines(lines: DataFrame, key: str = "line_id", seed: str = SEED, buckets: int | None = None) -> DataFrame:
    """Lines in a reproducible random order, with their 1-based ``position``.

    The hashes are even, so ranges of them (buckets) are known beforehand: one
    pass counts each bucket's lines, which gives every bucket its first
    position; the lines are dealt by bucket, once, and numbered inside.
    ``lines`` must give the same rows each time it is read.
    """
    spark = lines.sparkSession
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    h = rand_key(key, seed)
    bucket = F.floor(_hash_prefix(h) / F.lit(-(-_PREFIX_TOP // buckets))).cast("int")
    counts = lines.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("n")).orderBy("_b").collect()  # <= buckets rows
    starts, at = [], 0
    for r in counts:
        starts.append((r["_b"], at))
        at += r["n"]
    first = spark.createDataFrame(starts or [(0, 0)], "_at int, _first bigint")
    w = Window.partitionBy("_b").orderBy("_h", key)
    dealt = lines.withColumns({"_h": h, "_b": bucket}).repartitionByRange(buckets, "_b").withColumn("_rn", F.row_number().over(w))
    placed = dealt.join(F.broadcast(first), F.col("_b") == F.col("_at"))  # one row per bucket
    return placed.withColumn("position", F.col("_first") + F.col("_rn")).drop("_h", "_b", "_rn", "_at", "_first")
