"""Compare registered queries with their SQL on DuckDB: ``python tests/oracle.py [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, sf_dir: str, name: str) -> tuple[bool, str]:
    """Whether both engines agree on columns, types of values and values, and a short report."""
    import __spark_entry__ as entry

    started = time.time()
    df = entry.queries()[name](spark, sf_dir)
    ours = _rows(df.columns, df.collect())
    seconds = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return len(ours) > 0, f"{len(ours)} rows, no SQL, {seconds:.1f}s"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    started = time.time()
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    theirs = _rows(columns, result.fetchall())
    duck = time.time() - started
    report = f"{len(ours)} rows, spark {seconds:.1f}s, duckdb {duck:.1f}s"
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} / {sorted(columns)}"
    if ours == theirs:
        return True, report
    only_ours = [r for r in ours[:5000] if r not in set(theirs)][:4]
    only_theirs = [r for r in theirs[:5000] if r not in set(ours)][:4]
    return False, f"{report}, {len(theirs)} there\n   ours   {only_ours}\n   theirs {only_theirs}"


if __name__ == "__main__":
    import __spark_entry__ as entry

    from docloom.session import local_session

    spark = local_session(8)
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    bad = []
    for query in sys.argv[1:] or entry.queries():
        try:
            good, report = compare(spark, sf_dir, query)
        except Exception as error:  # report and go on with the next query
            good, report = False, str(error).split("\n")[0][:300]
        print("ok  " if good else "FAIL", query, report, flush=True)
        if not good:
            bad.append(query)
    print(len(bad), "failed:", " ".join(bad))
    sys.exit(bool(bad))
