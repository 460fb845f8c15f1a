"""Run registered queries against their SQL: python tests/compare.py <sf_dir> [query ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in GIVEN:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def expected(con: duckdb.DuckDBPyConnection, name: str) -> tuple[dict[str, str], list[tuple]]:
    result = con.execute(contract.oracle_sql()[name])
    columns = {d[0]: str(d[1]) for d in result.description}
    return columns, [dict(zip(columns, row)) for row in result.fetchall()]


TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


def differences(spark, con, sf_dir: str, name: str) -> list[str]:
    df = contract.queries()[name](spark, sf_dir)
    mine = df.collect()
    columns, theirs = expected(con, name)
    types = dict(df.dtypes)
    wanted = {c: TYPES.get(t, t.lower()) for c, t in columns.items()}
    found = []
    if types != wanted:
        found.append(f"schema {sorted(set(types.items()) ^ set(wanted.items()))}")
    if set(types) != set(columns):
        return found
    order = sorted(columns)
    left = sorted(repr([row[c] for c in order]) for row in mine)
    right = sorted(repr([row[c] for c in order]) for row in theirs)
    if left != right:
        only = set(left) - set(right)
        other = set(right) - set(left)
        found.append(f"rows {len(left)} / {len(right)}; spark only {sorted(only)[:2]}; sql only {sorted(other)[:2]}")
    return found


if __name__ == "__main__":
    from conftest import session

    spark = session()
    sf_dir = sys.argv[1]
    con = duck(sf_dir)
    for name in sys.argv[2:] or contract.queries():
        start = time.time()
        try:
            found = differences(spark, con, sf_dir, name)
        except Exception as error:  # keep going, report
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'ok  ' if not found else 'DIFF'} {name} {time.time() - start:.1f}s", *found, sep="\n     ", flush=True)
