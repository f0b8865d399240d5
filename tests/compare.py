"""Compare registered queries with their SQL on the given tables.

    python tests/compare.py [scale factor] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(frame, con, sql: str) -> str | None:
    """None if columns and values agree, else what differs first."""
    got = _sorted_rows(frame.collect(), frame.columns)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {frame.columns} and {names}"
    want = _sorted_rows(result.fetchall(), names)
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}"
    for a, b in zip(got, want, strict=True):
        if a != b:
            return f"{str(a)[:300]} and {str(b)[:300]}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    chosen = sys.argv[2:] or list(entry.queries())
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            frame = entry.queries()[name](spark, sf_dir)
            rows = frame.count()
            took = time.time() - start
            problem = difference(frame, con, entry.oracle_sql()[name])
        except Exception as error:  # report every query before failing
            rows, took, problem = -1, time.time() - start, f"{type(error).__name__}: {error}"[:1500]
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={rows} {took:.1f}s "
              f"{problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
