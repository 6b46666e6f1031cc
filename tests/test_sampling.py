"""Exact stratified sampling and shuffling: the selection by hash ranges gives
exactly the ``n`` smallest hashes, at every ``n`` and with any number of
ranges, and every suspicious line is kept; the shuffle's positions are the
ranks of the hashes."""

import hashlib

import pytest
from pyspark.sql import functions as F

from logsift.operators import prep as P
from logsift.operators import sequence


@pytest.fixture(scope="module")
def flagged(spark):
    return spark.range(0, 30_000).select(
        F.col("id").alias("line_id"),
        F.concat(F.lit("line "), F.col("id").cast("string")).alias("line"),
        (F.pmod(F.col("id"), 7) == 0).alias("suspicious"),
    )


def _ids(df):
    return sorted(r["line_id"] for r in df.select("line_id").collect())


def _hash(key):
    return hashlib.md5(f"42{'' if key is None else key}".encode()).hexdigest()


def _smallest(keys, n):
    return sorted(keys, key=lambda k: (_hash(k), k is not None, k))[:n]


@pytest.mark.parametrize("n,buckets", [(1, 1 << 16), (777, 16), (2000, 1 << 16), (12_000, 1 << 16), (25_000, 7), (25_714, 1), (40_000, 1 << 16)])
def test_sample_is_the_smallest_hashes(spark, flagged, monkeypatch, n, buckets):
    monkeypatch.setattr(sequence, "HASH_BUCKETS", buckets)
    got = _ids(P.sample_normal_keep_suspicious(flagged, n))
    normals = [k for k in range(30_000) if k % 7]
    assert got == sorted([k for k in range(30_000) if k % 7 == 0] + _smallest(normals, n))


def test_zero_sample_keeps_everything(spark, flagged):
    assert len(_ids(P.sample_normal_keep_suspicious(flagged, 0))) == 30_000
    assert P.sample_normal_keep_suspicious(flagged.limit(0), 10).count() == 0


def test_null_id_is_ranked_like_an_empty_one(spark, flagged):
    lines = flagged.union(spark.createDataFrame([(None, "no id", False)], "line_id long, line string, suspicious boolean"))
    rank = _smallest([None] + [k for k in range(30_000) if k % 7], 30_000).index(None) + 1
    for n in (rank - 1, rank, rank + 1, 40_000):
        out = [r["line_id"] for r in P.sample_normal_keep_suspicious(lines, n).select("line_id").collect()]
        assert len(out) == 4286 + min(n, 25_715) and (None in out) == (n >= rank)


@pytest.mark.parametrize("buckets", [None, 1, 3, 50])
def test_shuffle_positions_are_ranks_of_the_hashes(spark, flagged, buckets):
    out = P.shuffle_lines(flagged, buckets=buckets)
    assert out.columns == ["line_id", "line", "suspicious", "position"]
    got = [r["line_id"] for r in out.orderBy("position").collect()]
    assert got == _smallest(range(30_000), 30_000)
    assert [r["position"] for r in out.select("position").orderBy("position").collect()] == list(range(1, 30_001))
    assert P.shuffle_lines(flagged.limit(0)).count() == 0


def test_shuffle_deals_the_lines_once(spark, flagged):
    plan = P.shuffle_lines(flagged)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
