"""Compare every registered query with its SQL on DuckDB.

usage: python tools/check_oracles.py [folder] [name part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.sessions import make_session  # noqa: E402
from wattspark.plans import ORACLES, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(norm(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, r))
    )


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = make_session()
    bad = 0
    for name, query in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            got = [tuple(r) for r in df.collect()]
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: {str(error)[:1500]}")
            continue
        took = time.time() - start
        if name not in ORACLES:
            print(f"rows {name}: {len(got)} rows, {took:.1f}s {df.dtypes}")
            continue
        con = duckdb.connect()
        for table in TABLES:
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
        try:
            relation = con.sql(ORACLES[name])
            columns, types, want = relation.columns, relation.types, relation.fetchall()
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"SQL  {name}: {str(error)[:600]}")
            continue
        a, b = rows_of(df.columns, got), rows_of(columns, want)
        simple = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
                  "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
        spark_types = {c: simple.get(t, t) for c, t in df.dtypes}
        duck_types = {c: str(t) for c, t in zip(columns, types)}
        problems = []
        if spark_types != duck_types:
            problems.append(
                f"types {sorted(set(spark_types.items()) ^ set(duck_types.items()))}"
            )
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            problems.append(f"{len(a)} vs {len(b)} rows, first differences {diff}")
        if problems:
            bad += 1
            print(f"DIFF {name} {took:.1f}s: " + "; ".join(problems))
        else:
            print(f"ok   {name}: {len(a)} rows, {took:.1f}s")
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
