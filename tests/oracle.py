"""Run named queries and their SQL on the same tables and compare the rows.

    python -m tests.oracle [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0 if value != 0 else 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


# the types that the two engines name differently
DUCKDB_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def compare(spark, con, fn, sql: str | None, sf_dir: str) -> tuple[str, int]:
    """A verdict, empty if all is well, and the number of rows."""
    df = fn(spark, sf_dir)
    names = df.columns
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return ("" if got else "no rows"), len(got)
    cursor = con.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    types = {c: DUCKDB_TYPES.get(t, t) for c, t in df.dtypes}
    want_types = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if types != want_types:
        return f"columns {sorted(types.items())} against {sorted(want_types.items())}", len(got)
    a, b = _rows(names, got), _rows(want_names, want)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}", len(got)
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{sorted(names)}: {x} against {y}", len(got)
    return "", len(got)


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from liftspark.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = argv[1:] or list(entry.queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name in chosen:
        started = time.time()
        try:
            verdict, n = compare(spark, con, entry.queries()[name], oracles.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            verdict, n = f"{type(error).__name__}: {str(error)[:600]}", 0
        failed += bool(verdict)
        kind = "oracle" if name in oracles else "rows"
        print(f"{'FAIL' if verdict else 'ok  '} {name:28s} {kind:6s} {n:7d} rows {time.time() - started:6.2f}s {verdict}", flush=True)
    print(f"{len(chosen)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
