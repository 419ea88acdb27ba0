"""Parameter drift: sides combined where they are read, dealt by their number of rows."""

import random

import pytest
from pyspark.sql import functions as F

from harrow.operators import joins as J
from harrow.plans import join_queries as Q

SCHEMA = "search long, key string, value string"


def _rows(seed):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice(["k", "é", "", None]), rng.choice(["a", "b", "B", "é", "", None])) for _ in range(60)]
    return rows + [(7, "hot", rng.choice("xyz")) for _ in range(30_000)] + [(seed, "own", "v"), (9, "null", None)]


def _fold(rows, how):
    out = {}
    for s, k, v in rows:
        old = out.setdefault((s, k), None)
        if v is not None:
            out[s, k] = v if old is None else how(old, v, key=lambda x: x.encode())
    return out


@pytest.mark.parametrize("rows_a_task", [500_000, 5_000])
def test_drift_equals_brute_force(spark, monkeypatch, rows_a_task):
    monkeypatch.setattr(J, "ROWS_A_TASK", rows_a_task)
    left, right = _rows(11), _rows(12)
    a, b = (spark.createDataFrame(r, SCHEMA) for r in (left, right))
    tasks = J.tasks_for(a, b)
    assert tasks == -(-len(left + right) // rows_a_task)
    got = J.param_drift(J.key_values(a, "max", tasks), J.key_values(b, "min", tasks)).collect()
    x, y = _fold(left, max), _fold(right, min)
    want = {(*k, x.get(k), y.get(k)) for k in x.keys() | y.keys() if x.get(k) != y.get(k)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_a_hot_key_is_combined_before_it_is_dealt(spark):
    rows = spark.createDataFrame(_rows(11), SCHEMA).coalesce(1)
    text = J.key_values(rows, "max", 3)._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange hashpartitioning") < text.index("MapInArrow")


def test_tasks_of_the_query_grow_with_the_rows(spark, sf, monkeypatch):
    whole = sorted(map(tuple, Q.param_drift(spark, sf).collect()))
    monkeypatch.setattr(J, "ROWS_A_TASK", 300)
    df = Q.param_drift(spark, sf)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    assert sorted(map(tuple, df.collect())) == whole
    # Partitions stay as dealt: none is merged with others by its compressed size.
    assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 20
