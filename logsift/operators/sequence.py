"""Row numbers and running sums in a global (or per-group) order, without
funnelling a group through one task.

A window with no ``PARTITION BY`` (or with a partition key that has only a
few values, e.g. one run) puts all of its rows in one task.  Instead:

1. ``repartitionByRange`` on (group, order) spreads the rows over many
   balanced partitions, each holding a contiguous slice of the order, sorted;
2. each task numbers and sums its rows in that order as Arrow batches pass by
   (a window would shuffle them again); the result is checkpointed so every
   later use sees the same partitioning;
3. per-(partition, group) totals -- at most partitions + groups rows -- are
   turned into offsets with a tiny window and joined back (AQE broadcasts
   them at run time because they are small).

The order columns must be unique within a group for the result to be
deterministic.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from logsift.functions.rows import keep_where


#: Offset rows that may be broadcast (about 10 MB).
BROADCAST_OFFSETS = 200_000


def _checkpoint(df: DataFrame) -> DataFrame:
    from logsift.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _starts(batch: pa.RecordBatch, group: list[str], last: tuple | None) -> np.ndarray:
    """Whether each row of a sorted batch begins a group."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = last is None or last != tuple(batch.column(g)[0].as_py() for g in group)
    for g in group:
        codes = batch.column(g).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return new


def _numbered(rows: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    """Adds ``_pid``, ``_lrn`` and turns each of ``values`` (long) into its
    running sum, per partition and group, for partitions sorted by group."""
    fields = [f for f in rows.schema.fields if f.name not in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, last, count, sums = TaskContext.get().partitionId(), None, 0, dict.fromkeys(values, 0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = _starts(batch, group, last)
            head = np.maximum.accumulate(np.where(new, np.arange(n), -1))  # -1: the group of the batch before
            number = np.arange(n) - np.maximum(head, 0) + 1 + np.where(head < 0, count, 0)
            out = [batch.column(f.name) for f in fields] + [pa.array(np.full(n, pid, np.int32)), pa.array(number)]
            for v in values:
                x = pc.fill_null(batch.column(v), 0).to_numpy(zero_copy_only=False)
                total = np.cumsum(x)
                before = total - x
                run_sum = total - np.where(head < 0, -sums[v], before[np.maximum(head, 0)])
                out.append(pa.array(run_sum))
                sums[v] = int(run_sum[-1])
            count, last = int(number[-1]), tuple(batch.column(g)[n - 1].as_py() for g in group)
            yield pa.RecordBatch.from_arrays(out, names=[f.name for f in fields] + ["_pid", "_lrn", *values])

    schema = StructType(list(fields)).add("_pid", IntegerType()).add("_lrn", LongType())
    for v in values:
        schema = schema.add(v, LongType())
    return rows.mapInArrow(run, schema)


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    group: Sequence[str] = (),
    sums: dict[str, Column] | None = None,
    name: str = "rn",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` (1-based row number within ``group`` by ``order``) and,
    for each ``sums`` entry, a running sum of longs (inclusive of the current
    row; a null adds nothing)."""
    sums = sums or {}
    group = list(group)
    order = list(order)
    n = _partitions(df, partitions)
    keys = [F.col(c) for c in group + order]
    ranged = (df.withColumns({f"_ls_{k}": v.cast("bigint") for k, v in sums.items()} | {f"_v_{k}": v.cast("bigint") for k, v in sums.items()})
              .repartitionByRange(n, *keys).sortWithinPartitions(*keys))
    local = _numbered(ranged, group, [f"_ls_{k}" for k in sums])
    # The partition id must be the same for the totals and for the rows they
    # are joined back to; two independent range exchanges may sample
    # different bounds, so materialise once (reliable checkpoint, also the
    # recovery point if executors are lost).
    local = _checkpoint(local)

    totals = local.groupBy("_pid", *group).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums]
    )
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid",
        *group,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums],
    )
    # at most partitions + groups rows; broadcast behind a count of them
    small = totals.limit(BROADCAST_OFFSETS + 1).count() <= BROADCAST_OFFSETS
    offsets = offsets.select(F.col("_pid").alias("_p"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], "_off", *[f"_o_{k}" for k in sums])
    same = F.col("_pid") == F.col("_p")
    for i, c in enumerate(group):
        same &= F.col(c).eqNullSafe(F.col(f"_g{i}"))  # a null group is a group
    out = local.join(F.broadcast(offsets) if small else offsets, same)
    out = out.select(*group, *[c for c in local.columns if c not in group], "_off", *[f"_o_{k}" for k in sums]).withColumn(name, F.col("_off") + F.col("_lrn"))
    out = out.withColumns({k: F.col(f"_o_{k}") + F.col(f"_ls_{k}") for k in sums})
    drop = ["_pid", "_lrn", "_off"] + [f"_{x}_{k}" for k in sums for x in ("ls", "o", "v")]
    return out.drop(*drop)


#: Buckets of :func:`smallest_rows`.
HASH_BUCKETS = 1 << 16


def smallest_rows(rows: DataFrame, num: Column, top: int, order: Sequence[str], n: int, also: Column | None = None) -> DataFrame:
    """The first ``n`` rows of ``rows`` in ``order`` (unique), exactly, without
    sorting all of them; and all rows that satisfy ``also``, which are not
    counted.

    ``num`` is an evenly spread number in ``[0, top)`` that never decreases
    along ``order`` (e.g. a hash prefix).  One pass counts the rows of each of
    ``HASH_BUCKETS`` ranges of it; the bucket that holds the ``n``-th row is
    ranked by range partitioning and gives the last row's place; one more pass
    keeps what lies up to there.  The same way at every size.
    """
    x = rows.withColumns({"_x": num, "_also": F.coalesce(also, F.lit(False)) if also is not None else F.lit(False)})
    bucket = F.floor(F.col("_x") / F.lit(-(-top // HASH_BUCKETS))).cast("int")
    keys = _checkpoint(keep_where(x.withColumn("_bucket", bucket), ~F.col("_also")).select("_bucket", *order))  # narrow
    counts = keys.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).orderBy("_bucket").collect()  # <= HASH_BUCKETS rows
    left, last = n, None
    for r in counts:
        last = r["_bucket"]
        if left <= r["n"]:
            break
        left -= r["n"]
    else:
        return rows  # all of them
    if n <= 0:
        return keep_where(x, F.col("_also")).drop("_x", "_also")
    ranked = number_rows(keys.filter(F.col("_bucket") == last).select(*order), order=order, name="_rn")
    edge = ranked.filter(F.col("_rn") == left).first()
    upto = F.struct(*[F.col(c) for c in order]) <= F.struct(*[F.lit(edge[c]).cast(keys.schema[c].dataType).alias(c) for c in order])
    return keep_where(x, F.col("_also") | (bucket < last) | ((bucket == last) & upto)).drop("_x", "_also")
