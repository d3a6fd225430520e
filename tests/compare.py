"""Compare queries with their SQL: names, number of rows, and values regardless of order.

Run as ``python tests/compare.py [sf_dir] [name ...]`` to see every difference and timing.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        if math.isnan(number):
            return "nan"
        return str(int(number)) if number.is_integer() else f"{number:.9g}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None where query and SQL agree, else what differs."""
    df = query(spark, sf_dir)
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want_types = [str(d[1]) for d in result.description]
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} vs {sorted(want_names)}"
    have_types = dict(df.dtypes)
    for name, kind in zip(want_names, want_types):
        same = {
            "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
            "boolean": "BOOLEAN",
        }.get(have_types[name])
        if same not in (None, kind):
            return f"type of {name}: {have_types[name]} vs {kind}"
    have = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(want_names, result.fetchall())
    if len(have) != len(want):
        return f"{len(have)} rows vs {len(want)}; e.g. {_first(have, want)}"
    if have != want:
        return f"values differ: {_first(have, want)}"
    return None


def _first(have, want):
    only = [r for r in have if r not in set(want)][:1], [r for r in want if r not in set(have)][:1]
    return str([[tuple(str(v)[:300] for v in r) for r in side] for side in only])


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(spark, con, query, oracles[name], sf_dir)
            else:
                problem = f"rows only: {query(spark, sf_dir).count()}"
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None and not problem.startswith("rows only")
        print(f"{name:28s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(min(main(), 1))
