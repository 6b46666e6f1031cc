"""Exact quantiles (bracketed selection) against numpy's linear method on
data with heavy ties, tiny inputs and skew; every accuracy gives exact
results because the brackets are checked by counting."""

import numpy as np
import pytest

from logsift.operators import reports
from logsift.operators.reports import exact_quantiles, grouped_quantiles

PROBS = {"median": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def _frame(spark, xs):
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "id long, v double")


@pytest.mark.parametrize("n,acc,seed", [(1, 100, 0), (2, 100, 1), (7, 10, 2), (500, 10, 3),
                                        (3000, 100, 4), (3000, 10_000, 5), (20_000, 1000, 6)])
def test_exact_quantiles_match_numpy(spark, monkeypatch, n, acc, seed):
    groups = []
    real = reports.number_rows

    def spy(df, order, group=(), **kw):
        groups.append(list(group))
        return real(df, order, group, **kw)

    monkeypatch.setattr(reports, "number_rows", spy)
    rng = np.random.default_rng(seed)
    xs = np.concatenate([rng.integers(0, 5, n // 2), rng.exponential(50.0, n - n // 2).round(3)])
    got = exact_quantiles(_frame(spark, xs), "v", PROBS, "id", accuracy=acc, sort_limit=0).collect()[0]
    for name, p in PROBS.items():
        assert got[name] == pytest.approx(float(np.quantile(xs, p)), rel=1e-12, abs=1e-12), name
    # above the accuracy only the bracket rows are ranked, not the whole column
    assert groups == ([["_b"]] if n > acc else [[]])


def test_exact_quantiles_all_equal_and_empty(spark):
    got = exact_quantiles(_frame(spark, [3.0] * 50), "v", PROBS, "id", accuracy=10, sort_limit=0).collect()[0]
    assert all(got[k] == 3.0 for k in PROBS)
    empty = spark.createDataFrame([], "id long, v double")
    got = exact_quantiles(empty, "v", PROBS, "id").collect()[0]
    assert all(got[k] is None for k in PROBS)


def test_grouped_quantiles_match_numpy(spark, monkeypatch):
    sorts = []
    real = reports._grouped_by_sort

    def spy(*a, **kw):
        sorts.append(1)
        return real(*a, **kw)

    monkeypatch.setattr(reports, "_grouped_by_sort", spy)
    rng = np.random.default_rng(7)
    rows = []
    for g, size in (("hot", 2000), ("a", 5), ("b", 1)):
        for x in rng.exponential(10.0, size).round(2):
            rows.append((len(rows), g, float(x)))
    df = spark.createDataFrame(rows, "id long, g string, v double")
    for kw in ({}, {"sort_limit": 0, "accuracy": 50}, {"sort_limit": 0, "accuracy": 10_000}):
        got = {r["g"]: r for r in grouped_quantiles(df, "v", PROBS, "id", ["g"], **kw).collect()}
        for g in ("hot", "a", "b"):
            xs = np.array([x for _, gg, x in rows if gg == g])
            for name, p in PROBS.items():
                assert got[g][name] == pytest.approx(float(np.quantile(xs, p)), rel=1e-12, abs=1e-12), (kw, g, name)
    assert len(sorts) == 1  # only the default (small input) call ranked everything
