"""Runs a registered query on Spark and its SQL on DuckDB and compares the rows.

As a script: python tests/compare.py <folder> [name ...] prints one line per query.
"""

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, fn, sql: str, folder: str) -> tuple[bool, str]:
    df = fn(spark, folder)
    spark_rows = _rows(df.columns, df.collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    duck_rows = _rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if spark_rows == duck_rows:
        return True, f"{sum(duck_rows.values())} rows"
    only_spark = list((spark_rows - duck_rows).items())[:2]
    only_duck = list((duck_rows - spark_rows).items())[:2]
    return False, (
        f"{sum(spark_rows.values())} vs {sum(duck_rows.values())} rows; "
        f"spark only {only_spark}; duckdb only {only_duck}"
    )


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import __spark_entry__ as entry

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, con = session(), connect(folder)
    failed = 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                ok, note = True, f"{fn(spark, folder).count()} rows, no SQL"
            else:
                ok, note = compare(spark, con, fn, sql, folder)
        except Exception as error:
            ok, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - started:.1f}s {note}", flush=True)
    print(f"{failed} failed")
