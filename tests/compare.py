"""Compare a query's rows with those of its SQL, order aside."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(float(v)) if abs(v) < 2**53 else str(v)
    return repr(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in rows)


def difference(df, connection, sql) -> str | None:
    """None if equal, else a short account of the difference."""
    # as a view, since whoever checks a query may wrap its SQL in one
    connection.execute(f"create or replace temp view stated as {sql}")
    cursor = connection.execute("select * from stated")
    expected_columns = [d[0] for d in cursor.description]
    expected = canonical(expected_columns, cursor.fetchall())
    found = canonical(df.columns, [tuple(r) for r in df.collect()])
    if expected[0] != found[0]:
        return f"columns differ: only here {sorted(set(found[0]) - set(expected[0]))}, only in SQL {sorted(set(expected[0]) - set(found[0]))}"
    if len(expected[1]) != len(found[1]):
        return f"{len(found[1])} rows here, {len(expected[1])} in SQL"
    wrong = [(a, b) for a, b in zip(found[1], expected[1]) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(found[0][i], a[i], b[i]) for i in range(len(a)) if a[i] != b[i]]
        return f"{len(wrong)} rows differ, e.g. {cells[:4]}"
    return None
