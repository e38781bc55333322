"""Compare registered queries with their check SQL: ``python -m tests.oracle [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "FLOAT": "float", "SMALLINT": "smallint", "TINYINT": "tinyint",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)) if v is None else "", v if v is not None else 0)
                 if not isinstance(v, str) else (False, "", v) for v in row)


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


def difference(df, con, sql: str) -> str | None:
    """None when rows, columns and types agree, else a description."""
    names = sorted(df.columns)
    mine = [tuple(_plain(r[c]) for c in names) for r in df.select(*names).collect()]
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(types) != names:
        return f"columns {names} against {sorted(types)}"
    spark_types = dict(df.dtypes)
    bad = [(c, spark_types[c], types[c]) for c in names
           if TYPES.get(types[c], types[c].lower()) != spark_types[c]]
    if bad and any(not b[1].startswith(("array", "struct", "timestamp")) for b in bad):
        return f"types {bad}"
    theirs = [tuple(_plain(v) for v in r) for r in
              con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in names)} FROM ({sql})")
              .fetchall()]
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    a, b = sorted(mine, key=repr), sorted(theirs, key=repr)
    wrong = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}" if wrong else None


def main(argv):
    from loanloom.session import build_session
    import __spark_entry__ as entry

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = build_session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in argv or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                state = difference(df, con, oracles[name])
            else:
                state = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            state = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += state is not None
        kind = "sql " if name in oracles else "rows"
        print(f"{'ok  ' if state is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name}"
              + (f"\n     {state}" if state else ""), flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
