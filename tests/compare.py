"""Compare registered queries with their oracles, value for value."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


SAME_TYPES = {
    "string": {"VARCHAR"},
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (decimal.Decimal, dt.date)) and not isinstance(value, dt.datetime):
        raise TypeError(f"result types should be portable, found {type(value)}")
    return value


def compare(spark, connection, name: str, folder: str) -> list[str]:
    """Differences between a query and its oracle; empty if none."""
    problems = []
    df = contract.queries()[name](spark, folder)
    cursor = connection.execute(contract.oracle_sql()[name])
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    theirs = cursor.fetchall()
    columns = sorted(df.columns)
    if columns != sorted(kinds):
        return [f"columns {columns} != {sorted(kinds)}"]
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if kinds[field.name] not in SAME_TYPES.get(kind, {kind}):
            problems.append(f"{field.name}: {kind} != {kinds[field.name]}")
    order = [list(kinds).index(c) for c in columns]
    ours = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    theirs = Counter(tuple(plain(r[i]) for i in order) for r in theirs)
    if ours != theirs:
        problems.append(
            f"rows {ours.total()} vs {theirs.total()};"
            f" only here {list((ours - theirs).items())[:3]}; only oracle {list((theirs - ours).items())[:3]}"
        )
    return problems


if __name__ == "__main__":
    from tests.conftest import make_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:] or sorted(contract.queries())
    session, connection = make_session(), oracle_connection(folder)
    bad = 0
    for query in names:
        began = time.time()
        try:
            if query in contract.oracle_sql():
                found = compare(session, connection, query, folder)
            else:
                found = [] if contract.queries()[query](session, folder).count() >= 0 else ["no rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {query} {time.time() - began:.1f}s {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
