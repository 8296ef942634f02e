"""Run registered queries beside their SQL twins.

``python -m tests.compare [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return db


def _norm(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return str(v)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, db, name, query, sql, folder):
    """None when both agree, else a short description of the difference."""
    df = query(spark, folder)
    got = normalised(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(sql)
    want = normalised([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    different = [(a, b) for a, b in zip(got[1], want[1], strict=True) if a != b]
    return f"{len(different)} rows differ, e.g. {different[0]}" if different else None


def main(argv):
    import __spark_entry__ as contract
    from stockroom.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark, db = local_session(), connect(folder)
    queries, sql = contract.queries(), contract.oracle_sql()
    print("without SQL:", sorted(queries.keys() - sql.keys()), "extra:", sorted(sql.keys() - queries.keys()))
    bad = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            problem = compare(spark, db, name, queries[name], sql[name], folder)
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
