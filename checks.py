"""Run registered queries next to their SQL on DuckDB and compare columns, types, rows and values.

    python checks.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _close(a, b, tol: float) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=tol, abs_tol=tol)
    return a == b and type(a) is type(b)


def compare(spark_df, con, sql: str, tol: float = 0.0) -> str:
    """Empty when both agree, else what differs. Without a tolerance values must be equal, not merely close."""
    cols = sorted(spark_df.columns)
    cursor = con.execute(sql)
    theirs_cols = [d[0] for d in cursor.description]
    if sorted(theirs_cols) != cols:
        return f"columns {cols} != {sorted(theirs_cols)}"
    place = [theirs_cols.index(c) for c in cols]
    theirs = [tuple(r[i] for i in place) for r in cursor.fetchall()]
    ours = [tuple(r[c] for c in cols) for r in spark_df.collect()]
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    # Doubles last, so that their last digits do not decide how rows are paired.
    order = lambda r: ([repr(v) for v in r if not isinstance(v, float)], [repr(v) for v in r])
    pairs = list(zip(sorted(ours, key=order), sorted(theirs, key=order)))
    bad = [(x, y) for x, y in pairs if not all(_close(p, q, tol) for p, q in zip(x, y))]
    if not bad:
        return ""
    return f"{len(bad)} of {len(pairs)} rows differ, first {dict(zip(cols, zip(*bad[0])))}"


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from tidemark.session import build_session
    from workload import QUERIES, SQL

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("checks", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    for name, fn in QUERIES.items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            note = compare(df, con, SQL[name]) if name in SQL else f"rows only: {df.count()}"
        except Exception as error:
            note = f"{type(error).__name__}: {str(error)[:600]}"
        bad = bool(note) and not note.startswith("rows only")
        failed += bad
        print(f"{'FAIL' if bad else 'ok  '} {name} {time.time() - start:.1f}s {note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
