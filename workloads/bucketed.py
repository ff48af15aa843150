"""Batches on tables that lie in buckets, or in ranges, of their key."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom import KeyedTable
from changeloom.operators.merge import apply_changes, stack
from changeloom.plans.batches import write_bucketed_batch
from changeloom.session import scratch_path
from changeloom.sources.bucketed import copy_bucketed, open_bucketed, save_bucketed
from changeloom.sources.clustered import open_clustered, save_clustered

from .common import MARK, SYS, Query
from .files import OPTIONS, order_files
from .merge import SQL as MERGE_SQL
from .merge import order_batch

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
BUCKETS = 16


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return register


def _name(spark: SparkSession, label: str) -> tuple[str, str]:
    """A table name that nobody else uses, and a folder for it."""
    return f"{label}_{uuid.uuid4().hex}", scratch_path(spark, label)


def saved_orders(spark: SparkSession, target: KeyedTable) -> KeyedTable:
    name, path = _name(spark, "orders")
    save_bucketed(target, name, BUCKETS, path=path)
    return open_bucketed(spark, name, SYS)


@query(MERGE_SQL["apply_batch"])
def bucketed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that is not broadcast, on a table whose rows stay in their buckets."""
    target, replace, update, gone = order_batch(spark, sf_dir)
    return apply_changes(
        saved_orders(spark, target), replace=stack(replace), update=update, delete=gone, unmodified=MARK, small=False
    ).df


@query(MERGE_SQL["apply_batch"])
def bucketed_batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from change files into the next table, which lies in as many buckets."""
    target, files = order_files(spark, sf_dir)
    name, path = _name(spark, "orders")
    save_bucketed(target, name, BUCKETS, path=path)
    into, path = _name(spark, "orders")
    return write_bucketed_batch(spark, name, into, files, OPTIONS, system=SYS, path=path, small=False).df


@query("""
    SELECT o.* FROM orders o WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def bucketed_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletion of many keys, each of which comes several times."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    returned = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("l_returnflag = 'R'")
    table = saved_orders(spark, KeyedTable.of(orders, ["o_orderkey"], system=SYS))
    return apply_changes(table, delete=returned.select(F.col("l_orderkey").alias("o_orderkey")), small=False).df


@query("SELECT * FROM customer")
def copy_into_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table copied with its key, to which a column joins, and its defaults."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    table = KeyedTable.of(customer, ["c_custkey"], defaults={"c_name": "unknown"}, system=SYS)
    name, path = _name(spark, "customer")
    copy = copy_bucketed(table, name, BUCKETS, path=path, keys=["c_nationkey"])
    if copy.spec.keys != ["c_custkey", "c_nationkey"] or copy.spec["c_name"].default != "unknown":
        raise AssertionError(copy.spec)
    return copy.df


@query("""
    WITH b AS (SELECT MAX(o_orderkey) AS top FROM orders),
         r AS (SELECT o.* REPLACE ('Z' AS o_orderstatus) FROM orders o, b WHERE o_orderkey > top * 0.9 AND o_orderkey % 3 <> 0),
         t AS (SELECT o.* FROM orders o, b WHERE o_orderkey <= top * 0.95)
    SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM r)
        AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem, b WHERE l_orderkey > top * 0.85 AND l_returnflag = 'R')
    UNION ALL
    SELECT * FROM r WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem, b WHERE l_orderkey > top * 0.85 AND l_returnflag = 'R')""")
def clustered_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late orders replaced and deleted, in a table that lies in ranges of its key; the others are not shuffled."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    key, top = F.col("o_orderkey"), orders.agg(F.max("o_orderkey")).first()[0]
    path = scratch_path(spark, "clustered")
    save_clustered(KeyedTable.of(orders.filter(key <= top * 0.95), ["o_orderkey"], system=SYS), path, row_group_bytes=1 << 16)
    late = orders.filter((key > top * 0.9) & (key % 3 != 0)).withColumn("o_orderstatus", F.lit("Z"))
    gone = lineitem.filter((F.col("l_orderkey") > top * 0.85) & (F.col("l_returnflag") == "R")).select(F.col("l_orderkey").alias("o_orderkey"))
    return apply_changes(open_clustered(spark, path, SYS), replace=late, delete=gone, small=False).df
