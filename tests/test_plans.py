"""Physical-plan properties that matter at scale: the parse is fused into
the scan stage, top-k is TakeOrderedAndProject, the sliding count
has no moving RANGE frame, and a stored events table gets partition
pruning and pushed filters with a pruned read schema."""

from pyspark.sql import functions as F

from conftest import SMALL
from logsift.operators.alerts import sliding_count
from logsift.plans.catalog import load_all
from logsift.plans.q_parse import events
from logsift.session import scratch_path
from logsift.sources import io

REG = load_all()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parse_has_no_shuffle_beyond_spreading_small_input(spark):
    p = plan(REG["enrich_events"].build(spark, SMALL))
    exchanges = [line for line in p.splitlines() if "Exchange" in line]
    assert all("RoundRobinPartitioning" in line for line in exchanges), exchanges
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(REG["top_ips"].build(spark, SMALL))


def test_sliding_count_has_no_range_frame(spark):
    """A running sum over steps: no frame with a moving start, which would
    recompute the whole window for every row."""
    assert "RangeFrame" not in plan(sliding_count(events(spark, SMALL)))


def test_stored_events_prune_partitions_and_push_filters(spark):
    path = scratch_path(spark, "events-table")
    io.write_events(events(spark, SMALL), path)
    lo = spark.read.parquet(path).agg(F.min("indexed_at")).collect()[0][0]
    start = lo.strftime("%Y-%m-%d %H:%M:%S")
    df = io.read_events(spark, path, start=start).filter(F.col("suspicious")).select("ip", "indexed_at")
    p = plan(df)
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "PartitionFilters: [isnotnull(date" in scan
    assert "suspicious" in scan.split("PushedFilters:")[1] and "indexed_at" in scan.split("PushedFilters:")[1]
    assert "ReadSchema: struct<ip:string,suspicious:boolean,indexed_at:timestamp>" in scan
    assert df.count() == events(spark, SMALL).filter(F.col("suspicious") & (F.col("indexed_at") >= lo)).count()
