"""Every registered query beside its SQL, with ordinary groups and with every group split."""

import pytest

import __spark_entry__ as entry
from harrow.session import HOT_ROWS_CONF
from tests.oracle import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()

# Operators that go through the split-group order (file and model queries do not).
ORDERED = """asof_join overlaps concurrency concurrency_per_script composite_median param_profile param_effect durations trial_no
best_so_far rank_trials fold_seconds fold_order threshold_curve threshold_curve_per_fold best_threshold stratified_folds
gap_fill_locf gap_fill_linear smooth series_features flagship""".split()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_names_agree():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, name):
    assert compare(QUERIES[name](spark, sf), con, SQL[name]) == []


@pytest.mark.parametrize("name", ORDERED)
def test_matches_sql_with_split_groups(spark, sf, con, name):
    spark.conf.set(HOT_ROWS_CONF, "3")
    try:
        assert compare(QUERIES[name](spark, sf), con, SQL[name]) == []
    finally:
        spark.conf.unset(HOT_ROWS_CONF)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 20
    assert df.columns == ["run", "split", "metric", "mean", "folds", "rank"]
