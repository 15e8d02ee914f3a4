"""Compare a registered query with its SQL on the same parquet tables."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return db


def _plain(x):
    if isinstance(x, float) and math.isnan(x):
        return None
    return x


def rows_of_sql(db, text: str) -> tuple[list[str], list[tuple]]:
    cursor = db.execute(text)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)


def rows_of_frame(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(_plain(x) for x in r) for r in df.select(*names).collect()), key=repr)


def difference(df, db, text: str) -> str | None:
    """None if equal, else a short account of the first difference."""
    names, got = rows_of_frame(df)
    wanted_names, wanted = rows_of_sql(db, text)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(got) != len(wanted):
        only = [r for r in got if r not in set(wanted)][:3], [r for r in wanted if r not in set(got)][:3]
        return f"{len(got)} rows != {len(wanted)} rows; only here / there: {only}"
    for a, b in zip(got, wanted):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{names}: {a} != {b}"
    return None
