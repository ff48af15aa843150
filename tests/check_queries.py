"""Run registered queries next to their SQL: python tests/check_queries.py [sf dir] [name ...]"""

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def plain(value):
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if hasattr(value, "as_tuple"):
        return f"{value.normalize():f}" if value else "0"
    return repr(value)


def fingerprint(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir, name):
    """Seconds, row count and None, or what differs."""
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM read_parquet('{sf_dir}/{table}.parquet')")
    began = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = fingerprint(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - began
    result = connection.execute(entry.oracle_sql()[name])
    expected = fingerprint([d[0] for d in result.description], result.fetchall())
    if got[0] != expected[0]:
        return seconds, len(got[1]), f"columns {got[0]} instead of {expected[0]}"
    if got[1] != expected[1]:
        surplus, missing = set(got[1]) - set(expected[1]), set(expected[1]) - set(got[1])
        return seconds, len(got[1]), (
            f"{len(got[1])} rows instead of {len(expected[1])}; surplus {sorted(surplus)[:3]}, missing {sorted(missing)[:3]}"
        )
    return seconds, len(got[1]), None


if __name__ == "__main__":
    os.environ["TZ"] = "UTC"
    time.tzset()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    for name in sys.argv[2:] or entry.queries():
        try:
            seconds, count, difference = compare(spark, sf_dir, name)
        except Exception as e:
            seconds, count, difference = 0, 0, f"{type(e).__name__}: {str(e)[:300]}"
        print(f"{'ok  ' if difference is None else 'FAIL'} {name:32} {seconds:6.2f}s {count:8} {difference or ''}", flush=True)
