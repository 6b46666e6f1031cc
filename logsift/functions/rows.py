"""Row helpers: selection that keeps expensive columns single-evaluated, and
spreading a small input over all cores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_where(df: DataFrame, cond: Column) -> DataFrame:
    """``df.filter(cond)`` evaluated *after* the projections that define the
    columns in ``cond``.

    A plain filter on a computed column (e.g. the line kind, which runs two
    regexes) is pushed by the optimizer below the projection and the
    expression is then evaluated twice per row: once in the filter and once
    in the projection.  Exploding a one-element (kept) or empty (dropped)
    array is a generator, which predicates are not pushed through, so every
    expression runs once.
    """
    gate = F.when(cond, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    return df.withColumn("_keep", F.explode(gate)).drop("_keep")


def spread(df: DataFrame) -> DataFrame:
    """Use every core even when the input is a single split.

    A scan yields one task per file split / row group; a small table stored
    as one row group would run the whole per-row pipeline (parse, enrich) in
    one task.  Only then, the narrow projected rows are dealt round-robin to
    ``defaultParallelism`` partitions; a large input (many splits) is left
    alone, so at scale this adds no shuffle.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def side_by_side(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The columns of several one-row aggregates as one row.

    Every other frame becomes one scalar subquery (a struct of its columns),
    which Spark computes once and puts into the first frame's row: no join of
    single-row sides, and nothing passes through the driver program.
    """
    out = first
    for i, f in enumerate(others):
        out = out.withColumn(f"_s{i}", f.select(F.struct(*f.columns).alias("s")).scalar())
    return out.select(*first.columns, *[F.col(f"_s{i}")[c].alias(c) for i, f in enumerate(others) for c in f.columns])
