"""Run a query and its SQL on the same tables and compare them as bags of rows."""

import datetime as dt
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def data_dir() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, _plain(v)) for k, v in value.items())
    return value


KINDS = {
    "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark_df, sql, sf_dir):
    """Return ``(problem or None, row count)``."""
    con = connect(sf_dir)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    rows = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}", 0
    described = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    for name, kind in spark_df.dtypes:
        if described[name] != KINDS.get(kind, kind):
            return f"type of {name}: {kind} != {described[name]}", 0
    order = sorted(names)
    want = Counter(
        tuple(_plain(dict(zip(names, row))[n]) for n in order) for row in rows
    )
    got = Counter(tuple(_plain(row[n]) for n in order) for row in spark_df.collect())
    if want == got:
        return None, sum(want.values())
    missing, extra = list((want - got).items())[:2], list((got - want).items())[:2]
    return (
        f"rows {sum(got.values())} != {sum(want.values())}; columns {order}; "
        f"missing {missing}; extra {extra}",
        0,
    )
