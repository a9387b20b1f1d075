"""Compare a Spark result with the SQL twin run by DuckDB on the same files."""

import datetime
import decimal
import glob
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(directory):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(directory, "*.parquet")):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(frame, con, sql):
    """None when equal, else a short description of the difference."""
    got_columns, got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    want_columns, want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        only_got = sorted(set(got) - set(want))[:3]
        only_want = sorted(set(want) - set(got))[:3]
        return f"rows {len(got)} != {len(want)}; only spark {only_got}; only sql {only_want}"
    return None
