"""Regions of cells and their matches against a flood fill; connected components against union-find."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from harrow.operators import fields as D
from harrow.operators.graph import connected


def _fill(cells, diagonal):
    """{cell: smallest cell reached} per group."""
    steps = [(1, 0), (-1, 0), (0, 1), (0, -1)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if diagonal else [])
    left, out = set(cells), {}
    for start in sorted(cells, key=lambda c: (str(c[0]), c[1], c[2])):
        if start not in left:
            continue
        todo, mine = [start], []
        left.discard(start)
        while todo:
            g, x, y = todo.pop()
            mine.append((g, x, y))
            for dx, dy in steps:
                c = (g, x + dx, y + dy)
                if c in left:
                    left.discard(c)
                    todo.append(c)
        out |= dict.fromkeys(mine, start[1:])
    return out


def _cells(seed, share=0.5, size=14):
    rng = random.Random(seed)
    return [(g, x, y) for g in ("a", None, "b") for x in range(-size // 2, size // 2) for y in range(-5, size) if rng.random() < share]


def _frame(spark, cells):
    rows = [*cells, *cells[:7], ("a", None, 3), ("b", 1, None)]
    return spark.createDataFrame(rows, "grp string, x int, y int").repartition(3).withColumn("node", F.lit("clash")).withColumn("a", F.lit(1))


def _labels(df):
    rows = df.collect()
    got = {(r["grp"], r["x"], r["y"]): (r["region_x"], r["region_y"]) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize(("tile", "diagonal", "share"), ((1, False, 0.5), (100, False, 0.5), (3, False, 0.6), (4, True, 0.35), (1, True, 0.3), (256, True, 0.35)))
def test_labels_equal_a_flood_fill(spark, tile, diagonal, share):
    cells = _cells(tile, share)
    assert _labels(D.label_regions(_frame(spark, cells), ["grp"], tile=tile, diagonal=diagonal)) == _fill(cells, diagonal)


def test_a_long_snake_is_one_region(spark):
    """A path that crosses seams over and over."""
    cells = [("a", x, y) for x in range(0, 24) for y in range(24) if x % 2 == 0 or y == (23 if x % 4 == 1 else 0)]
    got = _labels(D.label_regions(_frame(spark, cells), ["grp"], tile=2))
    assert set(got.values()) == {(0, 0)} and len(got) == len(cells)


def test_labels_of_nothing_and_without_groups(spark):
    assert D.label_regions(_frame(spark, []), ["grp"]).count() == 0
    df = spark.createDataFrame([(5, 5), (5, 6), (9, 9)], "x long, y long")
    assert {tuple(r) for r in D.label_regions(df, []).collect()} == {(5, 5, 5, 5), (5, 6, 5, 5), (9, 9, 9, 9)}


def test_overlaps_and_scores_equal_counting(spark):
    pred, true = _cells(1, 0.3), _cells(2, 0.2) + _cells(1, 0.3)[::2]
    true = sorted(set(true), key=str)
    p, t = (D.label_regions(_frame(spark, c), ["grp"], tile=4) for c in (pred, true))
    overlaps = D.region_overlaps(p, t, ["grp"])
    lp, lt = _fill(pred, False), _fill(true, False)
    np_, nt = Counter((c[0], r) for c, r in lp.items()), Counter((c[0], r) for c, r in lt.items())
    both = Counter((c[0], r, lt[c]) for c, r in lp.items() if c in lt)
    want = {(g, *a, *b, np_[g, a], nt[g, b], n, round(n / (np_[g, a] + nt[g, b] - n), 9)) for (g, a, b), n in both.items()}
    want |= {(g, *a, None, None, n, 0, 0, 0.0) for (g, a), n in np_.items() if not any(k[:2] == (g, a) for k in both)}
    want |= {(g, None, None, *b, 0, n, 0, 0.0) for (g, b), n in nt.items() if not any((k[0], k[2]) == (g, b) for k in both)}
    rows = overlaps.collect()
    assert {(*tuple(r)[:-1], round(r["iou"], 9)) for r in rows} == want and len(rows) == len(want)
    for s in D.region_scores(overlaps, ["grp"]).collect():
        g = s["grp"]
        ious = [n / (np_[k[0], k[1]] + nt[k[0], k[2]] - n) for k, n in both.items() if k[0] == g]
        good = [i for i in ious if i > 0.5]
        n_pred, n_true = sum(k[0] == g for k in np_), sum(k[0] == g for k in nt)
        assert (s["pred_regions"], s["true_regions"], s["matches"]) == (n_pred, n_true, len(good))
        assert s["precision"] == pytest.approx(len(good) / n_pred) and s["recall"] == pytest.approx(len(good) / n_true)
        assert s["mean_iou"] == pytest.approx(sum(good) / len(good) if good else 0.0)
        assert s["split"] == sum(n > 1 for n in Counter(k[2] for k in both if k[0] == g).values())
        assert s["merged"] == sum(n > 1 for n in Counter(k[1] for k in both if k[0] == g).values())


def test_scores_where_one_side_is_empty(spark):
    cells = D.label_regions(_frame(spark, [("a", 1, 1)]), ["grp"])
    none = D.label_regions(_frame(spark, []), ["grp"])
    s = D.region_scores(D.region_overlaps(cells, none, ["grp"]), ["grp"]).first()
    assert (s["pred_regions"], s["true_regions"], s["matches"], s["precision"], s["recall"], s["f1"], s["mean_iou"]) == (1, 0, 0, 0.0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    names = list(range(200))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(0, 90)]  # a long path in no order
    edges += [(names[100], names[i]) for i in range(101, 130)] + [(rng.choice(names[130:]), rng.choice(names[130:])) for _ in range(40)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {n: find(n) for n in root}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_labels_and_overlaps_send_no_rows_through_the_driver(spark):
    p, t = (D.label_regions(_frame(spark, _cells(s, 0.4)), ["grp"], tile=3) for s in (1, 2))
    for df in (p, D.region_overlaps(p, t, ["grp"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("size", (1, 5, 1000))
def test_tiles_run_on_over_batches_and_share_them(size):
    tile = 3
    cells = sorted({(x // tile, y // tile, x, y) for g, x, y in _cells(7, 0.7) if g == "a"})
    rows, seen = [], Counter()
    for tx, ty, x, y in cells:
        seen[tx, ty] += 1
        rows.append({"_x": x, "_y": y, "_n": seen[tx, ty]})
    batches = [pa.RecordBatch.from_pylist(rows[i : i + size]) for i in range(0, len(rows), size)]
    out = [r for b in D._label_tiles(tile, False)(iter([pa.RecordBatch.from_pylist([], schema=batches[0].schema), *batches])) for r in b.to_pylist()]
    want = {}
    for place in seen:
        want |= _fill([(place, x, y) for *t, x, y in cells if tuple(t) == place], False)
    assert {((r["_x"] // tile, r["_y"] // tile), r["_x"], r["_y"]): (r["_rx"], r["_ry"]) for r in out} == want and len(out) == len(cells)
