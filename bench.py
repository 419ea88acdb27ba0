"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Table queries are timed to a full, discarded write. Model searches are timed to their trial table; they
match the recorded searches in kind (trials x 5 folds on about 2,000 samples).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harrow import build_session  # noqa: E402
from harrow.operators import folds as K  # noqa: E402
from harrow.operators import models as L  # noqa: E402
from harrow.operators import search as H  # noqa: E402
from harrow.plans import catalog  # noqa: E402
from harrow.plans import fixtures as X  # noqa: E402

TABLE_QUERIES = [
    "flagship", "typed_params", "param_fingerprint", "best_trial", "leaderboard", "param_profile", "param_effect",
    "rank_trials", "best_so_far", "trials", "asof_join", "overlaps", "concurrency", "param_drift", "kappa", "threshold_curve",
    "stratified_folds", "cross_validate_rule", "vote_soft", "standard_scale", "highlight", "composite_median", "clip_bbox",
    "region_iou", "zonal_majority", "gap_fill_linear", "smooth", "series_features", "dtw_distance_arrow", "kmeans_dtw",
]

# (name, estimator, search space, trials)
SEARCHES = [
    ("search_rf_20", L.fit_rf, {"n_estimators": ("int", 10, 40), "max_depth": ("int", 3, 6), "criterion": ("choice", ["gini", "entropy"])}, 20),
    ("trial_gbt", L.fit_gbt, {"n_estimators": ("int", 5, 10), "max_depth": ("int", 2, 4), "learning_rate": ("loguniform", 0.05, 0.5)}, 1),
    ("trial_svc", L.fit_svc, {"C": ("loguniform", 0.1, 100.0), "kernel": ("choice", ["linear", "rbf"])}, 1),
    ("trial_mlp", L.fit_mlp, {"hidden_layer_sizes": ("int", 16, 64), "max_iter": ("int", 50, 100)}, 1),
]


def _vote(train, params):
    members = {
        "svc": {"kernel": "linear", "C": params["C"], "max_iter": 20},
        "xgb": {"n_estimators": 5, "max_depth": params["max_depth"]},
        "mlp": {"hidden_layer_sizes": 25, "max_iter": 50},
    }
    return L.fit_vote(train, members)


SEARCHES.append(("trial_vote", _vote, {"C": ("loguniform", 0.1, 100.0), "max_depth": ("int", 2, 4)}, 1))


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="16g", spark__sql__shuffle__partitions=cpus
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["confusion"](spark, sf).count()  # start the workers and the code cache
    times: dict[str, float] = {}
    for name in TABLE_QUERIES:
        t = time.time()
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    samples = X.training_table(spark, sf).withColumn("label", X.F.col("label") % 4)
    folded = K.stratified_folds(samples, "label", 5, ["vec_id"])
    for name, fit, space, n in SEARCHES:
        t = time.time()
        H.run_search(folded, space, n, 5, fit, seed=3).count()
        times[name] = round(time.time() - t, 3)
    out = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
