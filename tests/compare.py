"""Run registered queries next to their SQL and compare: python tests/compare.py SF_DIR [names]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return repr(value)
    if isinstance(value, int):
        return f"{value:.6f}"
    return repr(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    mine = normal(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(mine[1]), None
    rel = con.sql(sql)
    theirs = normal(rel.columns, rel.fetchall())
    if mine[0] != theirs[0]:
        return len(mine[1]), f"columns {mine[0]} / {theirs[0]}"
    if mine[1] != theirs[1]:
        a, b = set(mine[1]), set(theirs[1])
        return len(mine[1]), (
            f"rows {len(mine[1])}/{len(theirs[1])}, only here {len(a - b)} {str(sorted(a - b)[:2])[:600]}, "
            f"only there {len(b - a)} {str(sorted(b - a)[:2])[:600]}"
        )
    return len(mine[1]), ""


def main() -> None:
    import __spark_entry__ as e
    from quernstone.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    queries, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name in names or queries:
        began = time.time()
        try:
            n, problem = compare(spark, con, queries[name], sqls.get(name), sf_dir)
        except Exception as failure:  # report and go on
            n, problem = -1, f"{type(failure).__name__}: {str(failure)[:1500]}"
        bad += bool(problem)
        state = "rows only" if problem is None else (problem or "equal")
        print(f"{name}: {n} rows, {time.time() - began:.1f}s, {state}", flush=True)
    print("differing:", bad)


if __name__ == "__main__":
    main()
