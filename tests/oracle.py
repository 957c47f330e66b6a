"""Compare a job with its SQL on the same tables."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import time

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def family(kind: str) -> str:
    kind = kind.lower()
    if kind.startswith("decimal"):
        return "decimal"
    return {"bigint": "bigint", "long": "bigint", "int": "int", "integer": "int", "double": "double",
            "float": "float", "string": "string", "varchar": "string", "timestamp_ntz": "timestamp",
            "timestamp": "timestamp", "boolean": "boolean", "hugeint": "hugeint"}.get(kind, kind)


def differences(df, con, sql: str) -> tuple[str, int, float]:
    """('ok' or what does not agree in names, types and rows; row count; seconds of the SQL)."""
    start = time.time()
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want_types = {d[0]: family(str(d[1])) for d in result.description}
    fetched = result.fetchall()
    seconds = time.time() - start
    names, want = _rows(want_names, fetched)
    got_types = {f.name: family(f.dataType.simpleString()) for f in df.schema}
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    verdict = "ok"
    if names != got_names:
        verdict = f"columns {got_names} != {names}"
    elif got_types != want_types:
        verdict = f"types {got_types} != {want_types}"
    elif len(got) != len(want):
        verdict = f"rows {len(got)} != {len(want)}"
    else:
        for g, w in zip(got, want):
            if g != w:
                verdict = f"row {g} != {w}"
                break
    return verdict, len(want), seconds
