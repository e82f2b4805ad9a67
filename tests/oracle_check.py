"""Compare registered queries with their SQL equivalents in DuckDB, value by value.

``python tests/oracle_check.py [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple((type(row[i]).__name__, str(row[i])) for i in order) for row in rows)


def compare(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Row count and the differences in columns, types or values."""
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = _rows(names, cursor.fetchall())
    if sorted(result.columns) != sorted(names):
        return 0, [f"columns {sorted(result.columns)} != {sorted(names)}"]
    found = _rows(result.columns, result.collect())
    problems = []
    if found != expected:
        problems = [f"{sum((found - expected).values())} unexpected, {sum((expected - found).values())} missing"]
        problems += [f"  spark {row}" for row in list((found - expected))[:2]]
        problems += [f"  sql   {row}" for row in list((expected - found))[:2]]
    return sum(found.values()), problems


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries

    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(oracle_sql())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, bad = duck(directory), 0
    for name in chosen:
        start = time.time()
        try:
            rows, problems = compare(queries()[name](spark, directory), connection, oracle_sql()[name])
        except Exception as error:  # report and go on with the next query
            rows, problems = 0, [f"{type(error).__name__}: {str(error)[:900]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} rows={rows} {time.time() - start:.1f}s", *problems, sep="\n" if problems else "")
    print(f"{len(chosen) - bad} of {len(chosen)} equal")
    spark.stop()
