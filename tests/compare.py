"""Run registered queries next to their SQL and compare the rows.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted_rows(names: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    shaped = [tuple(row[i] for i in order) for row in rows]
    return [names[i] for i in order], sorted(shaped, key=lambda r: tuple((v is not None, str(v)) for v in r))


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences as text; empty when equal."""
    got_names, got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = dict(zip(names, (str(d[1]) for d in result.description)))
    want_names, want = _sorted_rows(names, result.fetchall())
    problems = []
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    same_type = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if same_type.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: {kind} != {types[name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    for a, b in zip(got, want):
        if a != b:
            problems.append("\n   " + "\n   ".join(f"{n}: {str(x)[:200]!r} != {str(y)[:200]!r}" for n, x, y in zip(got_names, a, b) if x != y))
            if len(problems) > 3:
                break
    return problems


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from pagetables.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name, query in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problems = compare(query(spark, sf_dir), con, oracle_sql()[name])
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep=" ", flush=True)
    print("failed:", failed)
