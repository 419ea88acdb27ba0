"""The exact file layout, written with plain Python, read by the scans."""

import os
from datetime import date, datetime
from pathlib import Path

import pytest

from harrow.session import scratch_path
from harrow.sources import environments, layers, runtree
from harrow.sources.pixels import read_bands, write_bands
from harrow.streaming.ingest import compact_metrics, read_metrics_copy

META = """artifact_uri: mlflow-artifacts:/17/ab/artifacts
end_time: 1700000060000
entry_point_name: ''
experiment_id: '17'
lifecycle_stage: active
run_id: ab
run_name: blue-run-53
run_uuid: ab
source_name: ''
source_type: 4
source_version: ''
start_time: 1700000000000
status: 3
tags: []
user_id: someone
"""


@pytest.fixture()
def tree(tmp_path):
    def put(path, text):
        p = tmp_path / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)

    put("17/meta.yaml", "artifact_location: mlflow-artifacts:/17\ncreation_time: 5\nexperiment_id: '17'\nlast_update_time: 6\nlifecycle_stage: active\nname: base lines\n")
    put("17/ab/meta.yaml", META)
    put("17/ab/metrics/Validation F1 score of class 0 in fold 1", "1700000123456 0.8125 0\n")
    put("17/ab/metrics/loss+aux/step", "10 0.5 0\n20 0.25 1\n")
    put("17/ab/params/hidden_layer_sizes", "(82, 53)")
    put("17/ab/params/note", "two\nlines")
    put("17/cd/tags/mlflow.parentRunId", "ab")
    put("models/m/meta.yaml", "aliases:\n  champion: 3\n  old: 1\ncreation_timestamp: 1\ndescription: ''\nlast_updated_timestamp: 9\nname: forest\n")
    put("17/ab/artifacts/forest/conda.yaml", "channels:\n- conda-forge\ndependencies:\n- python=3.11.8\n- pip<=25.1.1\n- wheel\n- pip:\n  - numpy==2.1.3\nname: env\n")
    put("17/ab/artifacts/forest/python_env.yaml", "python: 3.11.8\nbuild_dependencies:\n- pip==25.1.1\ndependencies:\n- -r requirements.txt\n")
    put("layers/base/bbox.prj", 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]')
    put("layers/base/bbox.cpg", "UTF-8")
    put("layers/tiles/p1.cpg", "UTF-8")
    return tmp_path


def test_metrics(spark, tree):
    got = {tuple(r) for r in runtree.read_metrics(spark, str(tree)).collect()}
    assert got == {
        ("17", "ab", "Validation F1 score of class 0 in fold 1", 1700000123456, 0.8125, 0),
        ("17", "ab", "loss+aux/step", 10, 0.5, 0),
        ("17", "ab", "loss+aux/step", 20, 0.25, 1),
    }


def test_params_and_tags(spark, tree):
    assert {tuple(r) for r in runtree.read_params(spark, str(tree)).collect()} == {
        ("17", "ab", "hidden_layer_sizes", "(82, 53)"), ("17", "ab", "note", "two\nlines"),
    }
    assert [tuple(r) for r in runtree.read_tags(spark, str(tree)).collect()] == [("17", "cd", "mlflow.parentRunId", "ab")]


def test_meta(spark, tree):
    r = runtree.read_run_meta(spark, str(tree)).collect()
    assert len(r) == 1
    assert r[0]["artifact_uri"] == "mlflow-artifacts:/17/ab/artifacts" and r[0]["experiment_id"] == "17"
    assert r[0]["source_name"] is None and r[0]["status"] == 3 and r[0]["end_time"] == 1700000060000
    e = runtree.read_experiments(spark, str(tree)).where("experiment_id is not null").collect()
    assert [(x["experiment_id"], x["name"], x["creation_time"]) for x in e] == [("17", "base lines", 5)]


def test_a_repeated_meta_key_keeps_its_first_line(spark, tree):
    (tree / "17/ab/meta.yaml").write_text(META + "status: 9\n")
    assert runtree.read_run_meta(spark, str(tree)).first()["status"] == 3


def test_registry(spark, tree):
    r = runtree.read_models(spark, str(tree)).first()
    assert (r["name"], r["description"], r["last_updated_timestamp"], r["aliases"]) == ("forest", None, 9, {"champion": "3", "old": "1"})


def test_pins(spark, tree):
    conda = {tuple(r)[2:] for r in environments.read_env_pins(spark, str(tree)).collect()}
    assert conda == {
        ("forest", "conda.yaml", "python", "=", "3.11.8"), ("forest", "conda.yaml", "pip", "<=", "25.1.1"),
        ("forest", "conda.yaml", "numpy", "==", "2.1.3"), ("forest", "conda.yaml", "wheel", None, None),
    }
    env = environments.read_env_pins(spark, str(tree), "python_env.yaml").collect()
    assert [(r["package"], r["version"]) for r in env] == [("pip", "25.1.1")]


def test_layers(spark, tree):
    got = {(r["variant"], r["name"]): (r["crs"], r["encoding"]) for r in layers.read_crs(spark, str(tree / "layers")).collect()}
    assert got == {("base", "bbox"): ("GCS_WGS_1984", "UTF-8"), ("tiles", "p1"): (None, "UTF-8")}


def test_new_files_are_compacted_once(spark, tree):
    out = scratch_path(spark, "compact")
    assert compact_metrics(spark, str(tree), out) == 3
    extra = Path(tree) / "17/ef/metrics/loss"
    extra.parent.mkdir(parents=True)
    extra.write_text("30 0.125 2\n")
    assert [compact_metrics(spark, str(tree), out) for _ in range(2)] == [1, 0]
    rows = read_metrics_copy(spark, out)
    assert rows.count() == 4 and rows.where("run = 'ef'").first()["value"] == 0.125
    with extra.open("a") as f:
        f.write("31 0.25 3\n31 0.25 3\n")
    old = Path(tree) / "17/ef/metrics/old one"
    old.write_text("1 0.5 0\n")
    os.utime(old, (1, 1))
    assert compact_metrics(spark, str(tree), out) == 3
    assert sorted(map(tuple, read_metrics_copy(spark, out).collect())) == sorted(map(tuple, runtree.read_metrics(spark, str(tree)).collect()))


def test_unchanged_files_are_not_read(spark, tree):
    out = scratch_path(spark, "compact")
    compact_metrics(spark, str(tree), out)
    f = Path(tree) / "17/ab/metrics/loss+aux/step"
    time = f.stat().st_mtime_ns
    f.write_text(f.read_text().replace("0.25", "0.75"))
    os.utime(f, ns=(time, time))
    # Same length and time: the other content stays unseen, so nothing was read.
    assert compact_metrics(spark, str(tree), out) == 0
    # A changed time: earlier lines differ, so the line that the copy lacks is added.
    os.utime(f, (9, 9))
    assert [compact_metrics(spark, str(tree), out) for _ in range(2)] == [1, 0]


def test_a_call_that_died_is_written_anew(spark, tree):
    out = scratch_path(spark, "compact")
    compact_metrics(spark, str(tree), out)
    (Path(tree) / "17/ab/metrics/more").write_text("5 1.5 0\n")
    left = spark.createDataFrame([("gone", "k", 1, 1.0, 0, "17")], "run string, key string, ts long, value double, step long, experiment_id string")
    left.write.partitionBy("experiment_id").parquet(f"{out}/rows/batch=1")
    assert read_metrics_copy(spark, out).count() == 3
    assert compact_metrics(spark, str(tree), out) == 1
    assert read_metrics_copy(spark, out).where("run = 'gone'").count() == 0


def test_scenes_of_one_day_written_apart_both_stay(spark):
    path = scratch_path(spark, "bands")
    schema = "scene_ts timestamp, x int, B04 double"
    noon, late, next_month = datetime(2024, 5, 31, 12), datetime(2024, 5, 31, 18), datetime(2024, 6, 1)
    write_bands(spark.createDataFrame([(noon, 1, 0.1), (noon, 2, 0.2), (None, 9, 0.9)], schema), path)
    write_bands(spark.createDataFrame([(late, 1, 0.3), (next_month, 1, 0.4)], schema), path)
    write_bands(spark.createDataFrame([(noon, 1, 0.5), (None, 8, 0.8)], schema), path)
    # A write without its manifest entry is not there.
    spark.createDataFrame([(late, 7, 0.7)], schema).selectExpr("*", "to_date(scene_ts) scene_date", "'2024-05' scene_month").write.partitionBy("scene_month").parquet(f"{path}/batches/batch=dead")
    rows = {(r["scene_ts"], r["x"], r["B04"]) for r in read_bands(spark, path).collect()}
    assert rows == {(noon, 1, 0.5), (late, 1, 0.3), (next_month, 1, 0.4), (None, 8, 0.8)}
    assert {r["B04"] for r in read_bands(spark, path, last=date(2024, 5, 31)).collect()} == {0.5, 0.3}
    assert [r["B04"] for r in read_bands(spark, path, first=date(2024, 6, 1)).collect()] == [0.4]


def test_written_tree_reads_back(spark, tmp_path):
    files = spark.createDataFrame([("1/r/params/a b", "x"), ("1/r/params/c", "None")], "path string, content string")
    sizes = runtree.write_tree(files, str(tmp_path)).collect()
    assert sorted(r["bytes"] for r in sizes) == [1, 4]
    assert {(r["key"], r["value"]) for r in runtree.read_params(spark, str(tmp_path)).collect()} == {("a b", "x"), ("c", "None")}


def test_experiment_ids_stay_text(spark):
    rows = spark.createDataFrame([("007", "r", "k", "1"), ("8", "s", "k", "2")], "experiment_id string, run string, key string, value string")
    path = scratch_path(spark, "runs")
    runtree.write_runs(rows, path)
    assert sorted(r["experiment_id"] for r in runtree.read_runs(spark, path).collect()) == ["007", "8"]
    assert [r["run"] for r in runtree.read_runs(spark, path, "007").collect()] == ["r"]
