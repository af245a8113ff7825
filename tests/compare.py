"""Runs a query in Spark and its SQL in DuckDB and compares the rows, in any order."""

from __future__ import annotations

import math
import pathlib

import duckdb

from chatterscope.plans.oracle import ORACLE
from chatterscope.plans.queries import REGISTRY

DATA = "/root/testdata"


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.9g}"
    return str(value) if value is not None else "\0"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, name: str, scale: str) -> list[str]:
    folder = f"{DATA}/{scale}"
    df = REGISTRY[name](spark, folder)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    con = duckdb.connect()
    for file in pathlib.Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = con.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    theirs = _rows(names, result.fetchall())
    found = []
    if sorted(names) != sorted(df.columns):
        found.append(f"columns {sorted(df.columns)} vs {sorted(names)}")
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} vs {len(theirs)}")
    a, b = set(ours), set(theirs)
    if a != b:
        found += [f"only Spark: {sorted(a - b)[:2]}", f"only SQL: {sorted(b - a)[:2]}", f"{len(a - b)}/{len(b - a)}"]
    return found or ([] if ours == theirs else ["multiplicities differ"])
