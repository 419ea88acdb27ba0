"""Run registered queries beside their SQL in DuckDB and compare rows, names, types and values.

`python -m tests.oracle <sf_dir> [--hot N] [name ...]` prints one line per query; `--hot N` makes every
group above N rows take the split-group path.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, float):
        return repr(0.0 if v == 0 else v)
    return str(v)


def _rows(rows, order):
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and the SQL's; empty when equal."""
    rel = con.sql(sql)
    names, types = rel.columns, dict(zip(rel.columns, map(str, rel.types)))
    right = rel.fetchall()
    left = df.collect()
    out = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for f in df.schema.fields:
        want = SAME.get(f.dataType.simpleString(), f.dataType.simpleString())
        if types[f.name] != want:
            out.append(f"type of {f.name}: {want} != {types[f.name]}")
    order = sorted(range(len(names)), key=lambda i: names[i])
    a = _rows(left, [df.columns.index(names[i]) for i in order])
    b = _rows(right, order)
    if len(a) != len(b):
        out.append(f"rows {len(a)} != {len(b)}")
    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    if a != b:
        out.append(f"values differ: spark {only_a} sql {only_b}")
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as e
    from harrow import build_session

    sf, argv = argv[0], argv[1:]
    hot = {}
    if argv[:1] == ["--hot"]:
        hot, argv = {"spark__harrow__hotGroupRows": argv[1]}, argv[2:]
    spark = build_session("oracle", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions=8, spark__driver__memory="8g", **hot)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sql = e.oracle_sql()
    bad = 0
    for name, fn in e.queries().items():
        if argv and name not in argv:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in sql:
                diff = compare(df, con, sql[name])
                state = "ok" if not diff else "DIFF " + "; ".join(diff)
            else:
                state = f"rows {df.count()}"
        except Exception as x:  # noqa: BLE001
            state = "FAIL " + str(x).strip().replace("\n", " ")[:700]
        bad += state.startswith(("DIFF", "FAIL"))
        print(f"{name:28s} {time.time() - t:6.2f}s {state}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
