"""Run queries next to their SQL twins: ``python tests/oracle.py FOLDER [query ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    return f"{value!r}" if isinstance(value, str) else str(value)


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None if both give the same column names and the same rows in any order."""
    found = con.execute(sql)
    names, want = _sorted(found.fetchall(), [d[0] for d in found.description])
    columns, got = _sorted([tuple(r) for r in df.collect()], df.columns)
    if columns != names:
        return f"columns {columns} != {names}"
    if got == want:
        return None
    extra, lacking = list(set(got) - set(want))[:3], list(set(want) - set(got))[:3]
    return f"{len(got)} rows, wanted {len(want)}; extra {extra}; lacking {lacking}"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tidyforge.session import local_session

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    con = connect(folder)
    sql, bad = oracle_sql(), 0
    for name, run in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problem = difference(df, con, sql[name]) if name in sql else None
            state = "rows only: %d" % df.count() if name not in sql else "ok"
        except Exception as error:  # report and go on
            problem, state = f"{type(error).__name__}: {str(error)[:600]}", "failed"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or state}", flush=True)
    print("differences:", bad)
