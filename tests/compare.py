"""Run a registered query and its SQL, and compare all rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def differences(con, frame, sql: str, show: int = 3) -> str | None:
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns differ: {sorted(set(names) ^ set(frame.columns))}"
    want = _rows(names, cursor.fetchall())
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if got == want:
        return None
    only_got = sorted(set(got) - set(want))[:show]
    only_want = sorted(set(want) - set(got))[:show]
    return f"{len(got)} rows, expected {len(want)}\n  got  {only_got}\n  want {only_want}"
