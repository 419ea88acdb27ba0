"""Resumed searches, folds scored from counts, effects with open values."""

import math
import threading

import pytest
from pyspark.sql import functions as F

from harrow.operators import folds as K
from harrow.operators import runs as R
from harrow.operators import search as H
from harrow.session import scratch_path
from harrow.sources import runtree as T

SPACE = {"by": ("choice", ["a", "b"])}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, i % 5 + 1, i % 3 if i % 7 else 1, i % 2 if i % 11 else None, "xyz"[i % 3]) for i in range(300)]
    return spark.createDataFrame(data, "id long, fold int, label int, a int, b string").cache()


class _Fit:
    """A majority rule that counts its calls and fails on one of them."""

    def __init__(self, fails_at=None):
        self.calls, self.fails_at, self.lock = 0, fails_at, threading.Lock()

    def __call__(self, train, params):
        with self.lock:
            self.calls += 1
            if self.calls == self.fails_at:
                raise RuntimeError("lost")
        return K.majority_rule([params["by"]])(train)


def _log(spark, root):
    out = {}
    for kind, cols in (("metrics", ["run", "key", "value", "step"]), ("params", ["run", "key", "value"]), ("tags", ["run", "key", "value"])):
        out[kind] = sorted(map(tuple, T.read_runs(spark, f"{root}/{kind}").select(*cols).collect()))
    return out


def test_a_stopped_search_writes_the_same_log(spark, rows):
    whole, parts, plain = (scratch_path(spark, "search") for _ in range(3))
    once = _Fit()
    assert H.resume_search(rows, SPACE, 3, 5, once, whole, "e", 4, parallelism=3) == 0 and once.calls == 15
    stopped = _Fit(fails_at=6)
    with pytest.raises(RuntimeError, match="lost"):
        H.resume_search(rows, SPACE, 3, 5, stopped, parts, "e", 4, parallelism=1)
    done = H.search_units(spark, parts).select("trial", "fold").distinct().count()
    assert done in (5, 6, 7)  # units that were running when it failed are kept
    assert H.resume_search(rows, SPACE, 3, 5, stopped, parts, "e", 4, parallelism=2, most_units=4) == 11 - done
    assert H.resume_search(rows, SPACE, 3, 5, stopped, parts, "e", 4, parallelism=2) == 0
    assert stopped.calls == 16  # one unit was tried twice
    H.log_search(rows, SPACE, 3, 5, _Fit(), plain, "e", 4)
    assert _log(spark, parts) == _log(spark, whole) == _log(spark, plain)
    # A search that is done fits nothing, and its log is not doubled.
    assert H.resume_search(rows, SPACE, 3, 5, stopped, parts, "e", 4) == 0 and stopped.calls == 16
    assert _log(spark, parts) == _log(spark, whole)


def test_units_of_another_configuration_are_fitted_anew(spark, rows):
    root, fit = scratch_path(spark, "search"), _Fit()
    H.resume_search(rows, {"by": ("choice", ["a"])}, 1, 2, fit, root, "e", 4)
    assert H.resume_search(rows, {"by": ("choice", ["b"])}, 1, 2, fit, root, "e", 4) == 0
    assert fit.calls == 4
    assert {r["params"] for r in H.search_units(spark, root).collect()} == {'{"by": "b"}'}


@pytest.mark.parametrize("by", ([], ["a"], ["b"], ["a", "b"], ["id"]))
def test_counted_folds_equal_fitted_ones(rows, by):
    fit = K.majority_rule(by)
    counted = K.cross_validate(rows, fit, 5, train_scores=True)
    fitted = K.cross_validate(rows, lambda train: fit(train), 5, train_scores=True)
    key = lambda r: (r["split"], r["fold"])
    a, b = sorted(counted.collect(), key=key), sorted(fitted.collect(), key=key)
    assert counted.columns == fitted.columns and [key(r) for r in a] == [key(r) for r in b]
    for x, y in zip(a, b):
        assert tuple(x[c] for c in ("accuracy", "f1", "kappa")) == pytest.approx(tuple(y[c] for c in ("accuracy", "f1", "kappa")), nan_ok=True)


def test_counted_folds_read_their_rows_once(spark, rows):
    path = scratch_path(spark, "rows")
    rows.write.parquet(path)
    plan = K.cross_validate(spark.read.parquet(path), K.majority_rule(["a"]), 5)._jdf.queryExecution().toString()
    assert path not in plan  # what is left reads the written counts


def test_effects_leave_out_open_objectives(spark):
    data = [("s", "k", "v", float(i % 4), float(i * i % 7)) for i in range(30)]
    data += [("s", "k", "v", 1.0, math.nan), ("s", "k", "v", 2.0, None), ("s", "k", "w", math.nan, 3.0), ("s", "k", "w", None, 9.0), ("s", "k", "z", 1.0, math.nan)]
    df = spark.createDataFrame(data, "script string, key string, value string, x double, objective double")
    got = {r["value"]: tuple(r)[3:] for r in R.enum_effect(df).collect()}
    assert got["v"] == (pytest.approx(sum(d[4] for d in data[:30]) / 30), max(d[4] for d in data[:30]), 32)
    assert got["w"] == (6.0, 9.0, 2) and got["z"] == (None, None, 1)
    windows, counted = (R.param_effect(df, hot_rows=n).first() for n in (None, 3))
    assert windows["n"] == counted["n"] == 30
    assert tuple(windows)[2:4] == pytest.approx(tuple(counted)[2:4])
    assert not any(math.isnan(v) for v in tuple(windows)[2:4])
