"""Run a registered query and its SQL twin and compare the results."""

from __future__ import annotations

import datetime
import math

import duckdb

import __spark_entry__ as spark_entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value) if isinstance(value, datetime.date) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(spark, con, name: str, sf_dir: str) -> str:
    """Empty if names, types, row counts and values are equal, else what differs."""
    df = spark_entry.queries()[name](spark, sf_dir)
    result = con.sql(spark_entry.oracle_sql()[name])
    got_types = sorted((c, TYPES.get(t, t)) for c, t in df.dtypes)
    want_types = sorted((c, str(t)) for c, t in zip(result.columns, result.types))
    if got_types != want_types:
        return f"columns differ: {sorted(set(got_types) ^ set(want_types))}"
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(result.columns, result.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""
