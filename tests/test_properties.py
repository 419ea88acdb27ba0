"""Properties and brute-force checks on small tables."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from harrow.functions.dtw import dtw_batch, dtw_expr, dtw_udf
from harrow.operators import clustering as C
from harrow.operators import folds as K
from harrow.operators import joins as J
from harrow.operators import metrics as M
from harrow.operators import ordered as O
from harrow.operators import pixels as P
from harrow.operators import regions as G
from harrow.operators import series as S


def skewed(spark, n=400, seed=1):
    """A third of the rows in one group, many nulls, a null group."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        rows.append((g, rng.randrange(60), i, rng.choice([None, round(rng.random(), 3)])))
    return spark.createDataFrame(rows, "g string, t int, id int, v double")


@pytest.mark.parametrize("order", [["t", "id"], ["-t", "id"]])
def test_split_order_equals_plain_window(spark, order):
    df = skewed(spark)
    cols = {
        "n": O.row_number(), "c": O.running("count", "v"), "s": O.running("sum", "v"), "hi": O.running("max", "v"),
        "lo": O.running("min", "v"), "last": O.last_known("v"), "prev": O.previous("v"), "before": O.best_before("v"),
    }
    show = lambda d: sorted(
        tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in d.drop("g", "t", "v").collect()
    )
    key = lambda rows: sorted(rows, key=lambda r: r[0])
    plain = O.over_order(df, ["g"], order, cols, hot_rows=10_000)
    split = O.over_order(df, ["g"], order, cols, hot_rows=1)
    a = {r["id"]: r.asDict() for r in plain.collect()}
    b = {r["id"]: r.asDict() for r in split.collect()}
    assert a.keys() == b.keys()
    for i in a:
        for c in cols:
            x, y = a[i][c], b[i][c]
            assert x == y or x == pytest.approx(y), (i, c)


def test_order_over_everything(spark):
    df = skewed(spark)
    rows = O.over_order(df, [], ["t", "id"], {"n": O.row_number()}).orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(1, 401))
    assert [(r["t"], r["id"]) for r in rows] == sorted((r["t"], r["id"]) for r in rows)


def test_frames_of_split_groups(spark):
    df = skewed(spark).where("g is not null")
    build = lambda frame, order: {"m": F.avg("t").over(frame), "d": F.col("t") - F.lag("t").over(order)}
    a = O.over_frame(df, ["g"], ["t", "id"], 3, build, hot_rows=10_000)
    b = O.over_frame(df, ["g"], ["t", "id"], 3, build, hot_rows=7)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("hot", [1, 10_000])
def test_quantiles(spark, hot):
    df = skewed(spark)
    got = {r["g"]: (r["a"], r["b"]) for r in O.exact_quantiles(df, ["g"], "v", {"a": 0.5, "b": 0.9}, hot).collect()}
    for g, (a, b) in got.items():
        v = [r["v"] for r in df.where(F.col("g").eqNullSafe(g)).collect() if r["v"] is not None]
        assert a == pytest.approx(np.quantile(v, 0.5)) and b == pytest.approx(np.quantile(v, 0.9))
    everything = [r["v"] for r in df.collect() if r["v"] is not None]
    whole = O.exact_quantiles(df, [], "v", {"m": 0.25}).first()["m"]
    assert whole == pytest.approx(np.quantile(everything, 0.25))


def test_size_check(spark):
    assert O.size_checked(spark.range(50), 100).count() == 50
    big = spark.range(50)
    assert O.size_checked(big, 10) is big


def brute_dtw(a, b):
    d = np.full((len(a) + 1, len(b) + 1), np.inf)
    d[0, 0] = 0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            d[i, j] = (x - y) ** 2 + min(d[i - 1, j], d[i, j - 1], d[i - 1, j - 1])
    return math.sqrt(d[-1, -1])


numbers = st.lists(st.floats(-10, 10, width=32), min_size=1, max_size=7)


@settings(max_examples=40, deadline=None)
@given(numbers, numbers, numbers)
def test_dtw_batch(a, b, c):
    got = dtw_batch([a, b, c], [b, c, c])
    assert got == pytest.approx([brute_dtw(a, b), brute_dtw(b, c), 0.0], abs=1e-9)
    assert dtw_batch([a], [b])[0] == pytest.approx(dtw_batch([b], [a])[0], abs=1e-9)


def test_dtw_in_spark(spark):
    rows = [([1.0, 2.0, 3.0], [1.0, 2.0, 2.0, 3.0], 0.0), ([0.0, 0.0], [1.0, 1.0], math.sqrt(2))]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>, want double")
    for r in df.select("want", dtw_expr(F.col("a"), F.col("b")).alias("x"), dtw_udf()("a", "b").alias("y")).collect():
        assert r["x"] == pytest.approx(r["want"]) and r["y"] == pytest.approx(r["want"])


def test_dtw_window_limits_warping():
    a, b = [0.0, 0.0, 0.0, 5.0], [5.0, 0.0, 0.0, 0.0]
    assert dtw_batch([a], [b], window=0)[0] == pytest.approx(math.sqrt(50))
    assert dtw_batch([a], [b], window=4)[0] == pytest.approx(brute_dtw(a, b))


def test_kmeans_finds_separate_shapes(spark):
    rng = np.random.default_rng(0)
    shapes = [[0, 0, 0, 0, 0, 0], [10, 20, 30, 20, 10, 0], [50, 40, 30, 40, 50, 60]]
    rows = [(i, [float(x) for x in np.array(shapes[i % 3]) + rng.normal(0, 0.2, 6)]) for i in range(30)]
    df = spark.createDataFrame(rows, "series int, values array<double>")
    out, centres = C.kmeans_dtw(df, k=3, seed=10, max_iter=5)
    groups = {}
    for r in out.collect():
        groups.setdefault(r["cluster"], set()).add(r["series"] % 3)
    assert sorted(map(tuple, groups.values())) == [(0,), (1,), (2,)]
    assert len(centres) == 3
    again, _ = C.kmeans_dtw(df.repartition(5), k=3, seed=10, max_iter=5)
    assert sorted(map(tuple, again.select("series", "cluster").collect())) == sorted(map(tuple, out.select("series", "cluster").collect()))


def test_rounds_do_not_raise_the_cost(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 5).cumsum()]) for i in range(24)]
    df = spark.createDataFrame(rows, "series int, values array<double>")
    costs = [C.kmeans_dtw(df, k=3, seed=4, max_iter=n)[0].agg(F.sum(F.col("distance") ** 2)).first()[0] for n in (0, 1, 4)]
    assert costs[0] >= costs[1] - 1e-9 >= costs[2] - 2e-9


def test_series_too_long_is_an_error(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 5000, 2.0)], "series int, t long, value double")
    with pytest.raises(ValueError, match="larger step"):
        S.series_arrays(df, 1, max_points=4096)
    assert len(S.series_arrays(df, 1).first()["values"]) == 5001
    assert len(S.series_arrays(df, 10).first()["values"]) == 501


def test_long_gaps_are_filled_whole(spark):
    df = spark.createDataFrame([(1, 0, 0.0), (1, 10000, 100.0)], "series int, t long, value double")
    rows = S.gap_fill(df, 1, "linear").orderBy("t").collect()
    assert [r["t"] for r in rows] == list(range(10001))
    assert rows[2500]["value"] == pytest.approx(25.0) and rows[10000]["filled"] is False


def test_overlap_counts_match_pairs(spark):
    rng = random.Random(5)
    rows = [(i % 2, i, s := rng.randrange(50), s + rng.randrange(1, 20)) for i in range(60)]
    df = spark.createDataFrame(rows, "search int, run int, start_time long, end_time long")
    want = {}
    for a in rows:
        n = sum(a[0] == b[0] and a[1] != b[1] and a[2] < b[3] and b[2] < a[3] for b in rows)
        if n:
            want[a[1]] = n
    for hot in (3, 1000):
        assert {r["run"]: r["others"] for r in J.overlaps(df, hot_rows=hot).collect()} == want


def test_disjoint_trials_do_not_overlap(spark):
    df = spark.createDataFrame([(1, 1, 0, 10), (1, 2, 10, 20), (1, 3, 20, 21)], "search int, run int, start_time long, end_time long")
    assert J.overlaps(df).count() == 0
    assert J.concurrency(df).agg(F.max("depth")).first()[0] == 1


def test_asof_ties_and_gaps(spark):
    left = spark.createDataFrame([("m", 5), ("m", 9), ("m", 1), ("z", 4)], "k string, t long")
    right = spark.createDataFrame([("m", 5, 0.5), ("m", 7, 0.7), ("m", 2, 0.2)], "k string, t long, v double")
    for hot in (1, 1000):
        got = {(r["k"], r["t"]): r["right_v"] for r in J.asof_join(left, right, "t", ["k"], ["v"], hot).collect()}
        assert got == {("m", 5): 0.5, ("m", 9): 0.7, ("m", 1): None, ("z", 4): None}


def test_same_regions_have_iou_one(spark):
    cells = spark.range(20).select(F.lit("a").alias("v"), (F.col("id") % 5).alias("x"), F.col("id").alias("y"))
    r = G.region_iou(cells, cells, ["v"]).first()
    assert (r["iou"], r["precision"], r["recall"]) == (1.0, 1.0, 1.0)
    none = G.region_iou(cells, cells.limit(0), ["v"]).first()
    assert (none["iou"], none["recall"]) == (0.0, 0.0)


def test_boxes_of_mixed_size(spark):
    rng = random.Random(2)
    points = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(300)] + [(300, 10.0, 10.0)]
    boxes = [(0, -180.0, 180.0, -90.0, 90.0), (1, 10.0, 10.0, 10.0, 10.0)]
    for b in range(2, 30):
        w, x, y = 10 ** rng.uniform(-2, 2), rng.uniform(-180, 80), rng.uniform(-90, 0)
        boxes.append((b, x, x + w, y, y + w / 2))
    want = {(p[0], b[0]) for p in points for b in boxes if b[1] <= p[1] <= b[2] and b[3] <= p[2] <= b[4]}
    got = G.clip_bbox(
        spark.createDataFrame(points, "id int, lon double, lat double"),
        spark.createDataFrame(boxes, "box int, min_lon double, max_lon double, min_lat double, max_lat double"),
    )
    rows = [(r["id"], r["box"]) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


@pytest.mark.parametrize("hot", [1, 1000])
def test_all_masked_composite_is_null(spark, hot):
    df = spark.createDataFrame([(0, 0, 1, 0.5, 0), (0, 0, 1, 0.7, 0), (1, 0, 1, 0.2, 1)], "x int, y int, period int, B04 double, dataMask int")
    got = {r["x"]: (r["B04"], r["clear"]) for r in P.composite(df, ["B04"], "median", hot_rows=hot).collect()}
    assert got == {0: (None, 0), 1: (0.2, 1)}


def test_one_member_vote_is_that_member(spark):
    rows = [(s, "m", c, ((s * 7 + c * 3) % 5) / 5.0) for s in range(20) for c in range(3)]
    df = spark.createDataFrame(rows, "sample int, member string, cls int, score double")
    want = {s: min(range(3), key=lambda c: (-((s * 7 + c * 3) % 5), c)) for s in range(20)}
    for how in ("soft", "hard"):
        assert {r["sample"]: r["pred"] for r in M.vote(df, how).collect()} == want


def test_threshold_of_separable_scores(spark):
    df = spark.createDataFrame([(0, 0.9), (0, 0.8), (1, 0.3), (2, 0.1)], "label int, score double")
    best = M.best_threshold(df).first()
    assert (best["threshold"], best["f1"]) == (0.8, 1.0)


def test_top_per_beyond_the_group_limit(spark):
    from harrow.operators import runs as R

    df = spark.range(3000).select(F.lit("s").alias("script"), F.col("id").alias("run"), F.col("id").alias("ts"), (F.col("id") % 7).cast("double").alias("objective"))
    rows = R.top_per(df, ["script"], 1500).collect()
    w = Window.orderBy(F.desc("objective"), "ts", "run")
    want = {r["run"] for r in df.withColumn("n", F.row_number().over(w)).where("n <= 1500").collect()}
    assert {r["run"] for r in rows} == want


@pytest.mark.parametrize("hot", [1, 10_000])
def test_null_groups_are_kept(spark, hot):
    from harrow.operators import folds as K
    from harrow.operators import runs as R

    df = skewed(spark).where("v is not null").withColumnRenamed("g", "script").withColumn("objective", F.col("v"))
    n = df.count()
    assert R.rank_trials(df, ["script"], hot_rows=hot).count() == n
    assert K.standard_scale(df, ["v"], ["script"]).count() == n
    assert K.with_class_weight(df, "script").count() == n
    series = df.withColumnRenamed("script", "series").withColumn("t", F.col("id").cast("long")).withColumnRenamed("v", "value")
    assert S.series_features(series, hot_rows=hot).count() == series.select("series").distinct().count()
    assert G.zonal_shares(df.withColumn("cls", F.col("t") % 3), ["script"]).agg(F.sum("n")).first()[0] == n


def test_bootstraps_are_keyed_and_balanced(spark):
    rows = [(i, "a" if i % 4 else "b") for i in range(400)] + [(None, None)]
    df = spark.createDataFrame(rows, "k int, label string")
    got = sorted(map(str, K.bootstrap_weights(df, 6, "k").collect()))
    assert got == sorted(map(str, K.bootstrap_weights(df.repartition(7), 6, "k").collect()))
    rows = K.bootstrap_weights(df.where("k is not null"), 6, "k").collect()
    assert 0.9 < sum(r["draws"] for r in rows) / 2400 < 1.1
    for tree in range(6):
        total = [sum(r["draws"] * r["weight"] for r in rows if r["tree"] == tree and r["label"] == c) for c in "ab"]
        assert total[0] == pytest.approx(total[1])
    assert K.bootstrap_weights(df.limit(0), 6, "k").count() == 0
