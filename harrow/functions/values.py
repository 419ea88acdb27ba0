"""Reading the untyped text that run logs hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The run-status and source-type codes of the run-log format.
RUN_STATUS = {1: "RUNNING", 2: "SCHEDULED", 3: "FINISHED", 4: "FAILED", 5: "KILLED"}
SOURCE_TYPE = {1: "NOTEBOOK", 2: "JOB", 3: "PROJECT", 4: "LOCAL", 5: "UNKNOWN"}
# Fixed value: the key pattern of per-fold metrics.
FOLD_KEY = r"^(Training|Validation) (accuracy|kappa|F1 score of class ([0-9]+)) in fold ([0-9]+)$"


INT_TEXT = r"^[+-]?[0-9]+$"


def none_to_null(value: Column) -> Column:
    return F.when(value != "None", value)


def as_long(value: Column) -> Column:
    return F.when(value.rlike(INT_TEXT), value.try_cast("long"))


def as_double(value: Column) -> Column:
    return none_to_null(value).try_cast("double")


def as_bool(value: Column) -> Column:
    return F.when(value == "True", True).when(value == "False", False)


def value_type(value: Column) -> Column:
    """int, double, bool, null, list, map or text."""
    return (
        F.when(value.isNull() | (value == "None"), "null")
        .when(value.isin("True", "False"), "bool")
        .when(value.rlike(INT_TEXT), "int")
        .when(value.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), "double")
        .when(value.rlike(r"^[\(\[].*[\)\]]$"), "list")
        .when(value.rlike(r"^\{.*\}$"), "map")
        .otherwise("text")
    )


def parse_dict(value: Column) -> Column:
    """Dict literal text ({'C': 0.2, 'w': None, 'p': True}) -> map<string,string>; None -> null."""
    bare = r"(:\s*)(None|True|False)(?=\s*[,}])"
    quoted = F.regexp_replace(value, bare, "$1'$2'")
    parsed = F.from_json(quoted, "map<string,string>", {"allowSingleQuotes": "true"})
    return F.transform_values(parsed, lambda _, v: none_to_null(v))


def parse_layers(value: Column) -> Column:
    """'46', '(93,)', '(82, 53)' -> array<int>."""
    return F.transform(F.regexp_extract_all(value, F.lit("([0-9]+)"), 1), lambda x: x.cast("int"))


def parse_pin(line: Column) -> Column:
    """'  - numpy==2.1.3' -> struct(package, op, version); null for other lines."""
    # Fixed value: the pin line pattern.
    pattern = r"^\s*-\s*([A-Za-z0-9_.\-]+)(==|<=|>=|=)([^\s=]\S*)$"
    return F.when(
        line.rlike(pattern),
        F.struct(
            F.regexp_extract(line, pattern, 1).alias("package"),
            F.regexp_extract(line, pattern, 2).alias("op"),
            F.regexp_extract(line, pattern, 3).alias("version"),
        ),
    )


def parse_unpinned(line: Column) -> Column:
    """'- wheel' -> struct(package, op, version) with null op and version; null for other lines."""
    none = F.lit(None).cast("string")
    pattern = r"^\s*-\s*([A-Za-z0-9][A-Za-z0-9_.\-]*)\s*$"
    return F.when(
        line.rlike(pattern), F.struct(F.regexp_extract(line, pattern, 1).alias("package"), none.alias("op"), none.alias("version"))
    )


def decode_metric_key(key: Column) -> Column:
    """Metric key -> struct(split, metric, cls, fold, summary).

    Per-fold keys fill split / metric / cls / fold; `train_*` / `val_*` means, `best_*` and the
    threshold key fill split / metric / summary; other keys only name the metric.
    """
    is_fold = key.rlike(FOLD_KEY)
    raw = F.regexp_extract(key, FOLD_KEY, 2)
    cls = F.regexp_extract(key, FOLD_KEY, 3)
    best, mean = key.startswith("best_"), key.endswith("_mean")
    bare = F.regexp_replace(F.regexp_replace(key, "^best_", ""), "_mean$", "")
    side = F.regexp_extract(bare, "^(train|val)_", 1)
    summary = F.when(best, "best").when(mean, "mean").when(key == "Optimal threshold", "threshold")
    split = (
        F.when(is_fold, F.when(F.regexp_extract(key, FOLD_KEY, 1) == "Training", "train").otherwise("val"))
        .when(side != "", side)
    )
    metric = (
        F.when(is_fold & (cls != ""), "f1")
        .when(is_fold, raw)
        .when(key == "Optimal threshold", "threshold")
        .otherwise(F.regexp_replace(bare, "^(train|val)_", ""))
    )
    return F.struct(
        split.alias("split"),
        metric.alias("metric"),
        F.when(is_fold & (cls != ""), cls.cast("int")).alias("cls"),
        F.when(is_fold, F.regexp_extract(key, FOLD_KEY, 4).cast("int")).alias("fold"),
        F.when(~is_fold, summary).alias("summary"),
    )


def decode(code: Column, names: dict[int, str]) -> Column:
    """Code -> name through a small fixed table; unknown codes give null."""
    out = None
    for k, v in names.items():
        out = F.when(code == k, v) if out is None else out.when(code == k, v)
    return out


def artifact_uri(experiment: Column, run: Column) -> Column:
    # Fixed value: the artefact URI scheme of the run-log format.
    return F.concat(F.lit("mlflow-artifacts:/"), experiment, F.lit("/"), run, F.lit("/artifacts"))


def split_artifact_uri(uri: Column) -> Column:
    parts = F.split(F.regexp_replace(uri, "^[a-z-]+:/+", ""), "/")
    return F.struct(F.try_element_at(parts, F.lit(1)).alias("experiment_id"), F.try_element_at(parts, F.lit(2)).alias("run_id"))


def digest_parts(digest: Column) -> list[Column]:
    """The four 32-bit quarters of an md5 text as longs; sums of them do not depend on row order."""
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def unit_hash(*parts: Column) -> Column:
    """Uniform number in (0, 1) from the text of `parts`: the same on every run and partitioning."""
    h = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(h, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
