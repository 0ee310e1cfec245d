"""Run a registered query and its SQL on the same tables and compare types and values."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else x + 0.0
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None)
    return x


def compare(df, con, sql: str) -> tuple[bool, str]:
    relation = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return False, f"columns {names} / {sorted(relation.columns)}"
    types = dict(df.dtypes)
    want = dict(zip(relation.columns, map(str, relation.types)))
    odd = {c: (types[c], want[c]) for c in names if SAME_TYPE.get(types[c], types[c]) != want[c]}
    got = Counter(tuple(_cell(row[c]) for c in names) for row in df.collect())
    expected = Counter(tuple(map(_cell, row)) for row in relation.project(", ".join(f'"{c}"' for c in names)).fetchall())
    if got != expected:
        extra, missing = list((got - expected).items())[:2], list((expected - got).items())[:2]
        return False, f"{sum(got.values())} / {sum(expected.values())} rows\n  {names}\n  spark {extra}\n  duck  {missing}"
    if odd:
        return False, f"types {odd}"
    return True, f"{sum(got.values())} rows"


if __name__ == "__main__":
    from tidemark.catalog import QUERIES, SQL
    from tidemark.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), duck(folder)
    bad = 0
    for name in QUERIES:
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            ok, note = compare(df, con, SQL[name]) if name in SQL else (df.count() > 0, "rows only")
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} failures")
