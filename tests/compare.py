"""Run registered queries and their oracle SQL side by side.

python -m tests.compare <sf_dir> [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if (Path(sf_dir) / f"{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(v) + 0.0
    return str(v)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in values]
    return [columns[i] for i in order], sorted(out, key=repr)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def type_difference(spark_df, con, sql) -> str | None:
    got = {n: TYPES.get(t, t) for n, t in spark_df.dtypes}
    want = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    bad = {n: (got[n], want[n]) for n in got if n in want and got[n] != want[n]}
    return f"types differ: {bad}" if bad else None


def difference(spark_df, con, sql) -> str | None:
    """None when both results hold the same rows, else a description."""
    got = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    got_cols, got_rows = rows(spark_df.columns, got)
    want_cols, want_rows = rows(names, rel.fetchall())
    if got_cols != want_cols:
        return f"columns differ: only Spark {set(got_cols) - set(want_cols)}, only SQL {set(want_cols) - set(got_cols)}"
    if len(got_rows) != len(want_rows):
        return f"{len(got_rows)} rows, expected {len(want_rows)}"
    bad = [(g, w) for g, w in zip(got_rows, want_rows) if g != w]
    if bad:
        g, w = bad[0]
        cells = [(c, x, y) for c, x, y in zip(got_cols, g, w) if x != y]
        return f"{len(bad)} of {len(got_rows)} rows differ, first in (column, Spark, SQL): {cells[:6]} of {g[:3]}"
    return type_difference(spark_df, con, sql)


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from patronage import session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = session.build("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    oracles = oracle_sql()
    for name, fn in queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            problem = difference(fn(spark, sf_dir), con, oracles[name]) if name in oracles else "no oracle"
        except Exception as e:  # noqa: BLE001 - reported, and counted as a failure
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
