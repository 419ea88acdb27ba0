"""Sigmoids on held-out margins."""

import math

import numpy as np
import pytest

from harrow.operators import models as L
from harrow.session import scratch_path


@pytest.fixture(scope="module")
def noisy(spark):
    """Three classes with a little overlap: most rows are far surer than a margin of about one says to the plain logistic."""
    rng = np.random.default_rng(5)
    label = rng.integers(0, 3, 900)
    x = np.stack([label == 1, label == 2], axis=1) * 3.0 + rng.normal(0, 1, (900, 2))
    rows = [(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, "id long, features array<double>, label int").repartition(4)


def _loss(rows):
    """Mean log loss and calibration error (ten bins of the top class's probability)."""
    p = np.array([r["p"] for r in rows])
    y = np.array([r["label"] for r in rows])
    top, hit = p.max(1), p.argmax(1) == y
    bins = np.minimum((top * 10).astype(int), 9)
    error = sum(abs(hit[bins == b].mean() - top[bins == b].mean()) * (bins == b).mean() for b in range(10) if (bins == b).any())
    return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean(), error


def test_probabilities_are_better_than_the_plain_logistic(noisy):
    train, held = noisy.where("id % 3 > 0"), noisy.where("id % 3 = 0")
    params = {"kernel": "linear", "C": 1.0, "max_iter": 20}
    plain = L.with_scores(held, L.fit_svc(train, params), "p").collect()
    model = L.fit_svc(train, params | {"probability": True})
    fitted = L.with_scores(held, model, "p").collect()
    assert all(sum(r["p"]) == pytest.approx(1.0) and len(r["p"]) == 3 for r in fitted)
    assert _loss(fitted)[0] < _loss(plain)[0] and _loss(fitted)[1] < _loss(plain)[1]
    assert all(a < 0 for a, _ in model.spec["sigmoid"])  # a larger margin is a larger probability


def test_newton_finds_the_least_loss(spark):
    rng = np.random.default_rng(2)
    margin = rng.normal(0, 2, 400)
    hit = (rng.random(400) < 1 / (1 + np.exp(-1.7 * margin + 0.4))).astype(int)
    rows = [(0, float(m), int(h)) for m, h in zip(margin, hit)] + [(1, float(m), int(m > 0)) for m in margin] + [(2, 1.0, 0)] * 5
    got = L.fit_sigmoids(spark.createDataFrame(rows, "cls int, margin double, hit int").repartition(3))
    for c in (0, 1, 2):
        m, h = (np.array([r[i] for r in rows if r[0] == c], float) for i in (1, 2))
        n1, n0 = h.sum(), len(h) - h.sum()
        t = np.where(h == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))

        def loss(a, b):
            z = a * m + b
            return (t * z + np.logaddexp(0, -z)).sum()

        best = loss(*got[c])
        assert all(best <= loss(got[c][0] + da, got[c][1] + db) + 1e-7 for da in (-0.05, 0, 0.05) for db in (-0.05, 0, 0.05)), c
    assert got[0][0] == pytest.approx(-1.7, abs=0.4) and got[0][1] == pytest.approx(0.4, abs=0.4)


def test_stored_and_rare_classes(spark, noisy):
    few = noisy.where("label < 2").limit(60).unionByName(noisy.where("label = 2").limit(1))
    model = L.fit_svc(few, {"kernel": "linear", "max_iter": 5, "probability": "True"})
    assert len(model.spec["sigmoid"]) == 3 and all(math.isfinite(x) for pair in model.spec["sigmoid"] for x in pair)
    root = scratch_path(spark, "models")
    L.save_model(model, root, "svc")
    loaded = L.load_model(spark, root, "svc")
    a, b = ({r["id"]: r["p"] for r in L.with_scores(few, m, "p").collect()} for m in (model, loaded))
    assert a == b


def test_parts_do_not_depend_on_partitions(noisy):
    params = {"kernel": "linear", "max_iter": 5, "probability": True}
    a, b = (L.fit_svc(noisy.repartition(n), params).spec["sigmoid"] for n in (1, 6))
    assert np.allclose(a, b, rtol=1e-2, atol=1e-2)

