"""Compare queries with their SQL, in the way of the driver: columns by name, rows without order."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of_sql(sql: str, folder: str) -> tuple[list[str], list]:
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    rel = con.sql(sql)
    return normal(rel.columns, rel.fetchall())


def normal(columns: list[str], rows: list) -> tuple[list[str], list]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    cell = lambda v: repr(round(v, 6) + 0.0) if isinstance(v, float) else repr(int(v)) if isinstance(v, (bool, int)) else repr(v)
    return [columns[k] for k in order], sorted([tuple(cell(r[k]) for k in order) for r in rows])


def rows_of_spark(df) -> tuple[list[str], list]:
    return normal(df.columns, [tuple(r) for r in df.collect()])
