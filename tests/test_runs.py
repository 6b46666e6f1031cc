"""Steady throughput (mean of the last half of each run's samples): the
bracketed path used above the size limit equals the full ranking, with a
hot run, tiny runs (1 and 2 samples) and tied runtimes."""

import random

import pytest

from conftest import SMALL
from logsift.operators import runs
from logsift.operators.runs import steady_throughput
from logsift.sources.fixtures import metric_samples


def _rows(df):
    return sorted((r["exp_id"], round(r["avg_throughput"], 9), r["max_throughput"]) for r in df.collect())


def test_bracketed_last_half_equals_ranking(spark, monkeypatch):
    found = []
    real = runs._half_thresholds

    def spy(*a, **kw):
        out = real(*a, **kw)
        found.append(out is not None)
        return out

    monkeypatch.setattr(runs, "_half_thresholds", spy)
    rnd = random.Random(5)
    rows = []
    for run, n in (("w2_r300_b50", 3000), ("w4_r500_b100", 40), ("w6_r300_b50", 2), ("w8_r1000_b50", 1)):
        for i in range(n):
            rows.append((run, float(rnd.randrange(0, n // 3 + 1) * 5), len(rows), rnd.random() * 1000))
    df = spark.createDataFrame(rows, "exp_id string, runtime_sec double, sample_id long, throughput_eps double")
    expect = _rows(steady_throughput(df))
    for acc in (10, 100, 10_000):
        assert _rows(steady_throughput(df, sort_limit=0, accuracy=acc)) == expect, acc
    assert found == [True, True, True]  # thresholds came from the brackets, no fallback


@pytest.mark.parametrize("acc", [5, 10_000])
def test_bracketed_on_fixture_samples(spark, acc):
    samples = metric_samples(spark, SMALL)
    assert _rows(steady_throughput(samples, sort_limit=0, accuracy=acc)) == _rows(steady_throughput(samples))

