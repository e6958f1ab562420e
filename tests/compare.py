"""Run registered queries next to their SQL and compare the results value by value."""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

from maskwright.queries import ORACLES, QUERIES
from maskwright.sources.tables import TABLES


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, int):
        return f"i:{value}"
    if isinstance(value, float):
        return f"f:{value:.9g}"
    if isinstance(value, datetime.datetime):
        return f"t:{value.isoformat()}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_plain(v) for v in value) + "]"
    return f"{type(value).__name__}:{value}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def compare(spark, con, folder, name):
    """None when equal, else what differs."""
    df = QUERIES[name](spark, folder)
    got_cols, got = _rows(df.columns, df.collect())
    if name not in ORACLES:
        return None if got else "no rows"
    cur = con.execute(ORACLES[name])
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if not got:
        return "no rows"
    if got != want:
        only_got = sorted(set(got) - set(want))[:2]
        only_want = sorted(set(want) - set(got))[:2]
        return f"{len(got)} rows != {len(want)} rows; got {only_got}; want {only_want}"
    return None


if __name__ == "__main__":
    from maskwright.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:] or list(QUERIES)
    spark = local_session()
    con = connect(folder)
    bad = 0
    for name in [q for q in QUERIES if any(q.startswith(w) for w in wanted)]:
        began = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {name} [{kind}] {time.time() - began:.1f}s "
              f"{problem or ''}", flush=True)
    print(f"{bad} bad of {len(wanted)} groups", flush=True)
