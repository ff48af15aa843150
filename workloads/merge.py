"""Keyed changes on live and soft-delete tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom import KeyedTable
from changeloom.operators import merge
from changeloom.operators.merge import stack

from .common import MARK, ORDERS, Query, at, keyed, load, staged

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return register


@query("""
    WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
         s AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
               FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
    SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority
    FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey""")
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    target = keyed(orders.filter(F.col("o_orderdate") < at("2000-01-01")), "o_orderkey")
    changes = orders.filter(F.col("o_orderdate") >= at("1999-01-01")).withColumn("o_orderstatus", F.lit("X"))
    return merge.upsert(target, changes).df


@query("""
    WITH t AS (SELECT * FROM customer WHERE c_acctbal >= 0),
         s AS (SELECT o_custkey AS c_custkey, MAX(o_orderpriority) AS c_mktsegment FROM orders GROUP BY o_custkey)
    SELECT COALESCE(s.c_custkey, t.c_custkey) AS c_custkey,
           CASE WHEN t.c_custkey IS NULL THEN 'unknown' ELSE t.c_name END AS c_name, t.c_nationkey, t.c_acctbal,
           CASE WHEN s.c_custkey IS NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment
    FROM t FULL JOIN s ON t.c_custkey = s.c_custkey""")
def upsert_some_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    latest = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    changes = latest.agg(F.max("o_orderpriority").alias("c_mktsegment"))
    return merge.upsert(keyed(customer, "c_custkey", defaults={"c_name": "unknown"}), changes).df


def _order_updates(spark: SparkSession, sf_dir: str, keep: str) -> DataFrame:
    """Text cells per order with line items: some carry a value, some NULL, the rest the marker."""
    per_order = load(spark, sf_dir, "lineitem").groupBy("l_orderkey")
    return staged(
        per_order.agg(
            F.when(F.min("l_linestatus") == F.max("l_linestatus"), F.max("l_linestatus"))
            .otherwise(keep)
            .alias("o_orderstatus"),
            F.when(F.count("*") > 4, F.max("l_suppkey").cast("string")).otherwise(keep).alias("o_custkey"),
            F.when(F.max("l_returnflag") == "R", F.lit(None)).otherwise(keep).alias("o_orderpriority"),
        )
        .withColumn("o_orderkey", F.col("l_orderkey").cast("string"))
        .drop("l_orderkey"),
        "updates",
    )


_UPDATE_SQL = """
    WITH s AS (SELECT l_orderkey,
                      CASE WHEN MIN(l_linestatus) = MAX(l_linestatus) THEN MAX(l_linestatus) ELSE '{0}' END AS status,
                      CASE WHEN COUNT(*) > 4 THEN CAST(MAX(l_suppkey) AS VARCHAR) ELSE '{0}' END AS cust,
                      CASE WHEN MAX(l_returnflag) = 'R' THEN NULL ELSE '{0}' END AS priority
               FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey,
           CASE WHEN l_orderkey IS NULL OR cust = '{0}' THEN o_custkey ELSE TRY_CAST(cust AS BIGINT) END AS o_custkey,
           CASE WHEN l_orderkey IS NULL OR status = '{0}' THEN o_orderstatus ELSE status END AS o_orderstatus,
           o_totalprice, o_orderdate,
           CASE WHEN l_orderkey IS NULL OR priority = '{0}' THEN o_orderpriority ELSE priority END AS o_orderpriority
    FROM orders LEFT JOIN s ON o_orderkey = l_orderkey"""


@query(_UPDATE_SQL.format(MARK))
def update_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = keyed(load(spark, sf_dir, "orders"), "o_orderkey")
    return merge.update_partial(target, _order_updates(spark, sf_dir, MARK), MARK).df


@query(_UPDATE_SQL.format(""))
def update_without_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = keyed(load(spark, sf_dir, "orders"), "o_orderkey")
    return merge.update_partial(target, _order_updates(spark, sf_dir, "")).df


@query("""
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def delete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = load(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return merge.delete_rows(keyed(load(spark, sf_dir, "customer"), "c_custkey"), gone).df


@query("""
    SELECT * FROM conversations c WHERE NOT EXISTS (
        SELECT 1 FROM conversations d
        WHERE d.role = 'assistant' AND d.conv_id = c.conv_id AND d.turn + 1 = c.turn)""")
def delete_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = load(spark, sf_dir, "conversations")
    answered = conversations.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.lit("ignored").alias("text")
    )
    return merge.delete_rows(keyed(conversations, "conv_id", "turn"), answered).df


@query("SELECT * FROM events WHERE NOT (ts < TIMESTAMP '2024-01-15')")
def truncate_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = keyed(load(spark, sf_dir, "events"), "event_id")
    return merge.truncate_before(events, "ts", at("2024-01-15")).df


@query("""
    SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN TRUE
                   WHEN event_type = 'view' THEN NULL ELSE event_type = 'error' END AS is_deleted FROM events""")
def truncate_soft(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("event_type") != "view", F.col("event_type") == "error")
    events = keyed(load(spark, sf_dir, "events").withColumn("is_deleted", flag), "event_id")
    return merge.truncate_before(events, "ts", at("2024-01-15"), "is_deleted").df


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL
    SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier""")
def insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = keyed(load(spark, sf_dir, "customer"), "c_custkey", defaults={"c_mktsegment": "SUPPLIER"})
    rows = load(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("c_name"),
        (-1 - F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.col("s_nationkey").alias("c_nationkey"),
    )
    return merge.insert(customer, rows).df


@query("""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, ROW_NUMBER() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                     l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
        FROM lineitem) WHERE rn = 1""")
def one_change_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", "synced_at")
    spec = keyed(lineitem, "l_orderkey", "l_linenumber").spec
    return merge.one_per_key(lineitem, spec).withColumnRenamed("synced_at", "l_shipdate")


def order_batch(spark: SparkSession, sf_dir: str) -> tuple[KeyedTable, list[DataFrame], DataFrame, DataFrame]:
    """Orders up to 1999, and a batch for them: two replace files, an update file and a delete file."""
    orders = load(spark, sf_dir, "orders").select(*ORDERS)
    target = keyed(orders.filter(F.col("o_orderdate") < at("2000-01-01")), "o_orderkey")
    recent = orders.filter(F.col("o_orderdate") >= at("1999-01-01")).withColumn("o_orderstatus", F.lit("A"))
    urgent = orders.filter("o_orderpriority = '1-URGENT'").withColumns(
        {"o_orderstatus": F.lit("B"), "o_orderpriority": F.lit("urgent")}
    )
    gone = orders.filter("o_orderstatus = 'P' AND o_orderpriority = '5-LOW'")
    return target, [recent, urgent], _order_updates(spark, sf_dir, MARK), gone


@query(f"""
    WITH r1 AS (SELECT o_orderkey, o_custkey, 'A' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
                FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'),
         r2 AS (SELECT o_orderkey, o_custkey, 'B', o_totalprice, o_orderdate, 'urgent'
                FROM orders WHERE o_orderpriority = '1-URGENT'),
         t1 AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
                  AND o_orderkey NOT IN (SELECT o_orderkey FROM r1) UNION ALL SELECT * FROM r1),
         t2 AS (SELECT * FROM t1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM r2) UNION ALL SELECT * FROM r2),
         t3 AS ({_UPDATE_SQL.format(MARK).replace("FROM orders", "FROM t2")})
    SELECT * FROM t3 WHERE o_orderkey NOT IN (
        SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW')""")
def apply_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files as one plan with one join of the target."""
    target, replace, update, gone = order_batch(spark, sf_dir)
    return merge.apply_changes(target, replace=stack(replace), update=update, delete=gone, unmodified=MARK).df


@query("""
    WITH s AS (SELECT o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY f DESC) AS rn, status
               FROM (SELECT l_orderkey AS o_orderkey, 1 AS f, MAX(l_linestatus) AS status
                     FROM lineitem GROUP BY l_orderkey HAVING MAX(l_linestatus) <> 'O'
                     UNION ALL
                     SELECT l_orderkey, 2, MAX(l_returnflag) FROM lineitem GROUP BY l_orderkey
                     HAVING MAX(l_returnflag) <> 'R'))
    SELECT o.* REPLACE (COALESCE(s.status, o.o_orderstatus) AS o_orderstatus)
    FROM orders o LEFT JOIN s ON s.o_orderkey = o.o_orderkey AND s.rn = 1""")
def update_files_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two update files; where the later one leaves a cell alone, the earlier one counts."""
    per_order = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("o_orderkey"))

    def file(column: str, keep: str) -> DataFrame:
        value = F.max(column)
        return per_order.agg(F.when(value == keep, F.lit(MARK)).otherwise(value).alias("o_orderstatus"))

    target = keyed(load(spark, sf_dir, "orders"), "o_orderkey")
    update = stack([file("l_linestatus", "O"), file("l_returnflag", "R")])
    return merge.apply_changes(target, update=update, unmodified=MARK).df


@query("SELECT * REPLACE ('0' AS p_brand, CAST(NULL AS VARCHAR) AS p_type, CAST(12 AS INTEGER) AS p_size) FROM part")
def update_column_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = keyed(load(spark, sf_dir, "part"), "p_partkey")
    for column, value in (("p_brand", "0"), ("p_type", "NULL"), ("p_size", "12")):
        part = merge.update_column_value(part, column, value)
    return part.df
