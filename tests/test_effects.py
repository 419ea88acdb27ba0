"""Effects of large groups, from counts, against those of small ones, from rows."""

import random

import pytest

from harrow.operators import runs as R


def _trials(spark):
    rng = random.Random(5)
    rows = [(s, k, float(rng.randrange(9)), rng.choice([rng.random(), 0.5, None, float("nan")])) for s in ("a", None) for k in ("p", "q") for _ in range(200)]
    rows += [("one", "p", 1.0, 2.0), ("a", "p", None, 1.0)]
    return spark.createDataFrame(rows, "script string, key string, x double, objective double")


def _rows(df):
    return {r[:2]: r[2:] for r in map(tuple, df.collect())}


def test_large_groups_give_the_same(spark):
    small, large = (_rows(R.param_effect(_trials(spark), hot_rows=n)) for n in (10_000, 3))
    assert small.keys() == large.keys()
    for key, (pearson, spearman, n) in small.items():
        assert large[key] == (pytest.approx(pearson) if pearson is not None else None, pytest.approx(spearman) if spearman is not None else None, n), key


def test_large_groups_join_no_rows_by_objective(spark):
    plan = R.param_effect(_trials(spark), hot_rows=3)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "objective" in line]
