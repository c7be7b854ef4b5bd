"""Run registered queries against their oracle SQL in DuckDB and report differences.

    python -m checks.compare /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _cell(v):
    if v is None:
        return ("0",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (float, Decimal)):
        v = float(v)
        return ("n", "nan") if math.isnan(v) else ("n", v + 0.0)
    if isinstance(v, int):
        return ("n", float(v)) if abs(v) < 2**53 else ("i", v)
    return ("s", str(v))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    rows = spark_df.collect()
    got_cols, got = canonical(spark_df.columns, [tuple(r) for r in rows])
    cur = con.execute(sql)
    want_cols, want = canonical([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {sorted(set(got_cols) ^ set(want_cols))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        cols = [(c, a, b) for c, a, b in zip(got_cols, g, w) if a != b]
        return f"{len(bad)} of {len(got)} rows, first: {cols[:4]}"
    return None


def main(argv: list[str]) -> int:
    from shelftide.session import local_session

    from . import registry

    sf_dir, keys = argv[0], argv[1:]
    spark = local_session(8)
    con = connect(sf_dir)
    failed = 0
    for key, fn in registry.QUERIES.items():
        if keys and not any(key.startswith(k) for k in keys):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if key in registry.ORACLE:
                problem = compare(df, con, registry.ORACLE[key])
                note = "oracle"
            else:
                problem = None if df.collect() else "no rows"
                note = "rows"
        except Exception as e:  # report and go on with the next query
            problem, note = f"{type(e).__name__}: {str(e)[:400]}", "error"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {key} [{note}] {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
