"""Run registered queries and their SQL side by side and compare all rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import pathlib
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def kind(v: object) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "bool"
    return type(v).__name__


def norm(v: object) -> object:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, decimal.Decimal):
        return f"decimal {v}"
    return v


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, kind(x), str(x)) for x in r))


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    cur = con.execute(sql)
    want_cols = [c[0] for c in cur.description]
    want = rows_of(want_cols, cur.fetchall())
    got_cols = df.columns
    got = rows_of(got_cols, [tuple(r) for r in df.collect()])
    if sorted(want_cols) != sorted(got_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    if len(want) != len(got):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w or [kind(x) for x in g] != [kind(x) for x in w]:
            diff = [(n, a, b) for n, a, b in zip(sorted(got_cols), g, w) if a != b or kind(a) != kind(b)]
            bad = sum(1 for x, y in zip(got, want) if x != y)
            return f"{bad} of {len(got)} rows differ, first: {str(diff)[:600]}"
    if not got:
        return "no rows on either side"
    return None


def main() -> int:
    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from tillwise.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session("8")
    con = connect(sf_dir)
    sqls, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            msg = compare(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as e:  # report and go on
            msg = f"{type(e).__name__}: {str(e)[:1200]}"
        if msg and not msg.startswith("rows only"):
            bad += 1
        print(f"{'ok  ' if msg is None else 'DIFF' if not msg.startswith('rows only') else 'rows'} {name} {time.time() - t0:.1f}s {msg or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
