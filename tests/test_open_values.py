"""Trials without an objective, runs without an end, fingerprints of awkward pairs."""

from harrow.operators import joins as J
from harrow.operators import runs as R

NAN = float("nan")


def _trials(spark):
    rows = [("s", 1, 10, NAN), ("s", 2, 11, 0.5), ("s", 3, 12, None), ("s", 4, 13, 0.75), ("s", 5, 14, NAN)]
    return spark.createDataFrame(rows, "search string, run long, ts long, objective double")


def test_nan_and_null_objectives_never_win(spark):
    t = _trials(spark)
    assert [r["run"] for r in R.top_trials(t, 2).collect()] == [4, 2]
    assert {(r["run"], r["place"]) for r in R.top_per(t, ["search"], 3).collect()} == {(4, 1), (2, 2)}
    assert {(r["run"], r["rank"]) for r in R.rank_trials(t, ["search"]).collect()} == {(4, 1), (2, 2)}
    best = {r["run"]: (r["best"], r["improved"]) for r in R.best_so_far(t).collect()}
    assert best == {1: (None, False), 2: (0.5, True), 3: (0.5, False), 4: (0.75, True), 5: (0.75, False)}
    assert {(r["best"], r["trials"]) for r in R.leaderboard(t, ["search"]).collect()} == {(0.75, 2)}


def test_open_runs_are_still_running(spark):
    r = spark.createDataFrame([("s", 1, 0, 10), ("s", 2, 5, None), ("s", 3, 20, 30)], "search string, run long, start_time long, end_time long")
    assert {(x["run"], x["others"]) for x in J.overlaps(r).collect()} == {(1, 1), (2, 2), (3, 1)}
    assert {(x["t"], x["depth"]) for x in J.concurrency(r).collect()} == {(0, 1), (5, 2), (10, 1), (20, 2), (30, 1)}


def test_fingerprints_keep_key_and_value_apart(spark):
    rows = [(1, "a=b", "c"), (2, "a", "b=c"), (3, "a", None), (4, "a", "None")]
    fp = R.param_fingerprint(spark.createDataFrame(rows, "run long, key string, value string"))
    assert len({r["fp"] for r in fp.collect()}) == 4


def test_split_quantiles_keep_infinities(spark):
    from harrow.operators.ordered import exact_quantiles

    inf = float("inf")
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, inf, inf, inf)] + [("b", -inf)] * 4, "g string, v double")
    qs = {"q1": 0.1, "q6": 0.6, "q9": 0.9}
    got = [{tuple(r) for r in exact_quantiles(df, ["g"], "v", qs, rows).collect()} for rows in (None, 2)]
    assert got[0] == got[1] and ("b", -inf, -inf, -inf) in got[0]
