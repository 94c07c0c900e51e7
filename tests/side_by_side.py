"""Compare a query with its SQL counterpart on the same Parquet tables."""

from __future__ import annotations

import math
import os
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return str(value)
    return str(value)


def compare(spark, con, name, fn, sql, sf_dir):
    """None when equal, else a description of the first difference. Also returns seconds."""
    begin = time.time()
    df = fn(spark, sf_dir)
    columns = sorted(df.columns)
    ours = [tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect()]
    seconds = time.time() - begin
    if sql is None:
        return None, seconds, len(ours)
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    theirs_raw = relation.fetchall()
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}", seconds, len(ours)
    order = [names.index(c) for c in columns]
    theirs = [tuple(row[i] for i in order) for row in theirs_raw]
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}", seconds, len(ours)
    a = sorted(tuple(_cell(v) for v in row) for row in ours)
    b = sorted(tuple(_cell(v) for v in row) for row in theirs)
    for x, y in zip(a, b):
        if x != y:
            diff = [(c, p[:300], q[:300]) for c, p, q in zip(columns, x, y) if p != q]
            return f"values {diff[:3]}", seconds, len(ours)
    for i, column in enumerate(columns):
        kinds_a = {type(r[i]).__name__ for r in ours if r[i] is not None}
        kinds_b = {type(r[i]).__name__ for r in theirs if r[i] is not None}
        if kinds_a != kinds_b:
            return f"types of {column}: {kinds_a} != {kinds_b}", seconds, len(ours)
    return None, seconds, len(ours)


def main(argv):
    import __spark_entry__ as entry
    from sluice.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(8)
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    picked = [n for n in queries if not argv or any(n == a or n.startswith(a) for a in argv)]
    bad = 0
    for name in picked:
        try:
            problem, seconds, rows = compare(
                spark, con, name, queries[name], oracles.get(name), sf_dir
            )
        except Exception as error:
            problem, seconds, rows = f"{type(error).__name__}: {str(error)[:1500]}", 0.0, 0
        mark = "ok  " if problem is None else "FAIL"
        kind = "S" if name in oracles else "R"
        bad += problem is not None
        print(f"{mark} {kind} {name} rows={rows} {seconds:.1f}s {problem or ''}", flush=True)
    print(f"{len(picked) - bad} of {len(picked)} ok")


if __name__ == "__main__":
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    main(sys.argv[1:])
