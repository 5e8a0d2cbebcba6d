"""Run every registered query next to its SQL twin and compare the rows.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, (int, float)):
        if isinstance(value, float) and math.isnan(value):
            return ("nan",)
        return ("n", 0.0 if value == 0 else float(value))
    if isinstance(value, dt.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("d", value.isoformat())
    if value is None:
        return ("",)
    return ("s", str(value))


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} <> {sorted(names)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return None
    a, b = set(got) - set(want), set(want) - set(got)
    return f"rows {len(got)} vs {len(want)}; only spark {sorted(a)[:2]}; only sql {sorted(b)[:2]}"


def main() -> int:
    from gridpulse.checks.registry import oracle_sql, queries
    from gridpulse.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = get_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", os.environ.get("COMPARE_TZ", "UTC"))
    con, bad = duck(folder), 0
    sqls = oracle_sql()
    for name, build in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = build(spark, folder)
            problem = compare(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
            ok = problem is None or name not in sqls
        except Exception as exc:
            problem, ok = f"{type(exc).__name__}: {str(exc)[:700]}", False
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:26s} {time.time() - started:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
