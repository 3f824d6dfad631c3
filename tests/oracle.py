"""Compare registered queries with their SQL checks in DuckDB.

``python -m tests.oracle [sf] [name part ...]``
"""

from __future__ import annotations

import datetime as dt
import glob
import os
import sys
import time

DATA = os.environ.get("SLATEWORK_TESTDATA", "/root/testdata")


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (2, repr(value))
    if isinstance(value, dt.datetime):
        return (3, value.replace(tzinfo=None).isoformat())
    if isinstance(value, (list, tuple)):
        return (4, str([_cell(v) for v in value]))
    return (5, f"{type(value).__name__}:{value}")


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark, sf_dir: str, fn, sql: str, con) -> list[str]:
    """Empty if columns and the multiset of rows agree."""
    frame = fn(spark, sf_dir)
    mine = [tuple(row) for row in frame.collect()]
    cursor = con.execute(sql)
    theirs_names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(frame.columns) != sorted(theirs_names):
        return [f"columns {sorted(frame.columns)} != {sorted(theirs_names)}"]
    a, b = _rows(frame.columns, mine), _rows(theirs_names, theirs)
    if a == b:
        return []
    only_a, only_b = set(a) - set(b), set(b) - set(a)
    show = [f"rows {len(a)} vs {len(b)}; only spark {len(only_a)}, only sql {len(only_b)}"]
    names = sorted(frame.columns)
    for label, rows in (("spark", sorted(only_a)[:2]), ("sql", sorted(only_b)[:2])):
        for row in rows:
            show.append(label + " " + str({n: v[1] for n, v in zip(names, row)})[:1500])
    return show


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    parts = sys.argv[2:]
    import __spark_entry__ as entry
    from slatework.session import local_session

    spark = local_session(cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{DATA}/sf{sf}"
    con = connect(sf_dir)
    sqls, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        started = time.time()
        try:
            if name in sqls:
                found = differences(spark, sf_dir, fn, sqls[name], con)
                status = "ok" if not found else "DIFF"
            else:
                found, status = [f"rows {fn(spark, sf_dir).count()}"], "rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            found, status = [f"{type(error).__name__}: {str(error)[:1200]}"], "ERROR"
        bad += status in ("DIFF", "ERROR")
        print(f"{status:5} {time.time() - started:6.1f}s {name}", flush=True)
        for line in found if status != "ok" else []:
            print("      ", line, flush=True)
    print(f"failed: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
