"""Schema evolution, mode migrations and data checks."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom import Column, KeyedTable, UserActionError
from changeloom.operators import checks, modes, schema

from .common import VERSIONS, Query, at, keyed, load, versions_of, versions_sql

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return register


def _customer(spark: SparkSession, sf_dir: str, **kwargs) -> KeyedTable:
    return keyed(load(spark, sf_dir, "customer"), "c_custkey", **kwargs)


def _part(spark: SparkSession, sf_dir: str) -> KeyedTable:
    return keyed(load(spark, sf_dir, "part"), "p_partkey")


def _history(spark: SparkSession, sf_dir: str) -> KeyedTable:
    versions = versions_of(load(spark, sf_dir, "events"))
    # Users whose last event is an error count as deleted: their last version is closed.
    closed = F.col("is_current") & (F.col("event_type") == "error")
    versions = versions.withColumns(
        {
            "valid_to": F.when(closed, F.col("valid_from") + F.expr("INTERVAL '1' HOUR")).otherwise(F.col("valid_to")),
            "is_current": F.col("is_current") & ~closed,
        }
    )
    return keyed(versions.select(*VERSIONS), "user_id", "valid_from")


_HISTORY = f"""
    SELECT * REPLACE (
        CASE WHEN is_current AND event_type = 'error' THEN valid_from + INTERVAL '1 hour' ELSE valid_to END AS valid_to,
        is_current AND event_type <> 'error' AS is_current) FROM ({versions_sql()})"""
_LAST = f"SELECT * FROM ({_HISTORY}) QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY valid_from DESC) = 1"
_FLAG = "CASE WHEN event_type <> 'view' THEN event_type = 'error' END"
_FLAGGED = f"SELECT event_id, user_id, event_type, ts AS synced_at, {_FLAG} AS is_deleted FROM events"


def _flagged(spark: SparkSession, sf_dir: str, flag: str = "is_deleted") -> KeyedTable:
    """Events as a soft-delete table: errors are deleted, and views have no flag."""
    events = load(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").alias("synced_at"),
        F.when(F.col("event_type") != "view", F.col("event_type") == "error").alias(flag),
    )
    return keyed(events, "event_id")


# --- schema ---


@query("""
    SELECT c_custkey, c_name, c_acctbal, c_mktsegment, CAST(NULL AS DATE) AS since, 'none' AS remark FROM customer""")
def alter_add_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _customer(spark, sf_dir)
    columns = [c for c in customer.spec.columns if c.name != "c_nationkey"]
    added = [Column("since", T.DateType()), Column("remark", T.StringType(), default="none")]
    requested = customer.spec.with_columns([*columns, *added])
    return schema.alter_table(customer, requested, drop_columns=True).df


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS BIGINT) AS points FROM customer")
def alter_keep_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _customer(spark, sf_dir)
    requested = customer.spec.with_columns([customer.spec["c_custkey"], Column("points", T.LongType())])
    return schema.alter_table(customer, requested, drop_columns=False).df


@query("""
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size,
           CAST(p_retailprice AS DECIMAL(12,1)) AS p_retailprice FROM part""")
def alter_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir)
    # Cents first, so that the narrowing to one digit starts from an exact value.
    part = schema.change_type(part, "p_retailprice", T.DecimalType(12, 2))
    new = {"p_partkey": T.StringType(), "p_size": T.LongType(), "p_retailprice": T.DecimalType(12, 1)}
    requested = part.spec.with_columns(replace(c, dtype=new.get(c.name, c.dtype)) for c in part.spec.columns)
    return schema.alter_table(part, requested).df


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, '' AS region, TIMESTAMP '1970-01-01' AS opened,
           0 AS branch FROM customer""")
def alter_key_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _customer(spark, sf_dir)
    joining = [
        Column("region", T.StringType(), key=True),
        Column("opened", T.TimestampNTZType(), key=True),
        Column("branch", T.IntegerType(), key=True),
    ]
    requested = customer.spec.with_columns([*customer.spec.columns, *joining])
    return schema.alter_table(customer, requested).df


@query("""
    SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def alter_key_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key change that rows stand against, which are named; the table stays as it is."""
    lineitem = keyed(load(spark, sf_dir, "lineitem"))
    wanted = ["l_orderkey", "l_linenumber", "batch"]
    requested = lineitem.spec.with_columns([*lineitem.spec.columns, Column("batch", T.IntegerType())]).with_keys(wanted)
    try:
        schema.alter_table(lineitem, requested)
    except UserActionError:
        return checks.key_conflicts(lineitem, wanted)
    raise AssertionError("the key change was not refused")


_DESCRIBED = {
    "customer": (["c_custkey"], {"c_name": "unknown"}, "LONG STRING INT DOUBLE STRING"),
    "part": (["p_partkey", "p_brand"], {}, "LONG STRING STRING STRING INT DOUBLE"),
    "events": (["event_id"], {"value": "0", "props": "{}"}, "LONG NAIVE_DATETIME LONG STRING DOUBLE STRING"),
}


def _describe_sql() -> str:
    """From the types that the files are known to have, and counts."""
    columns = {
        "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
        "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
        "events": "event_id ts user_id event_type value props",
    }
    rows = []
    for table, (keys, defaults, types) in _DESCRIBED.items():
        for position, (name, kind) in enumerate(zip(columns[table].split(), types.split(), strict=True)):
            default = f"'{defaults[name]}'" if name in defaults else "CAST(NULL AS VARCHAR)"
            rows.append(
                f"SELECT '{table}' AS table_name, {position} AS position, '{name}' AS column_name, '{kind}' AS column_type, "
                f"CAST(NULL AS INTEGER) AS precision, CAST(NULL AS INTEGER) AS scale, {name in keys} AS primary_key, "
                f"{default} AS column_default, COUNT(*) AS row_count, COUNT(*) - COUNT({name}) AS null_count FROM {table}"
            )
    return " UNION ALL ".join(rows)


@query(_describe_sql())
def describe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of several tables with types, keys and defaults, and how full they are."""
    described = None
    for name, (keys, defaults, _) in _DESCRIBED.items():
        found = schema.describe_content(keyed(load(spark, sf_dir, name), *keys, defaults=defaults)).withColumn("table_name", F.lit(name))
        described = found if described is None else described.unionByName(found)
    return described


@query("SELECT c_custkey, c_name AS full_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def rename_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.rename_column(_customer(spark, sf_dir), "c_name", "full_name").df


@query("SELECT *, c_acctbal AS balance_before FROM customer")
def copy_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.copy_column(_customer(spark, sf_dir), "c_acctbal", "balance_before").df


@query("SELECT * EXCLUDE (props) FROM events")
def drop_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.drop_column(keyed(load(spark, sf_dir, "events"), "event_id"), "props").df


@query("""
    SELECT *, CAST('2.50' AS DECIMAL(6,2)) AS fee, DATE '2024-02-29' AS since, 'NULL' AS remark FROM customer""")
def add_column_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _customer(spark, sf_dir)
    for column in (
        Column("fee", T.DecimalType(6, 2), default="2.50"),
        Column("since", T.DateType(), default="2024-02-29"),
        Column("remark", T.StringType(), default="NULL"),
        Column("remark", T.StringType(), default="later rows only"),
    ):
        customer = schema.add_column_with_default(customer, column)
    return customer.df


# --- modes ---


@query(f"SELECT * EXCLUDE (is_deleted) FROM ({_FLAGGED}) WHERE is_deleted IS NULL OR NOT is_deleted")
def mode_soft_to_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes.soft_delete_to_live(_flagged(spark, sf_dir)).df


_SOFT_TO_HISTORY = """
    SELECT {0}, COALESCE(NOT is_deleted, TRUE) AS is_current,
           CASE WHEN is_deleted THEN TIMESTAMP '1970-01-01' ELSE (SELECT MAX(ts) FROM events) END AS valid_from,
           CASE WHEN is_deleted THEN TIMESTAMP '1970-01-01' ELSE TIMESTAMP '9999-12-31 23:59:59.999' END AS valid_to
    FROM ({1})"""


@query(_SOFT_TO_HISTORY.format("* EXCLUDE (is_deleted)", _FLAGGED))
def mode_soft_to_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes.soft_delete_to_history(_flagged(spark, sf_dir)).df


@query(_SOFT_TO_HISTORY.format("* EXCLUDE (is_deleted), is_deleted AS removed", _FLAGGED))
def mode_soft_to_history_own_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes.soft_delete_to_history(_flagged(spark, sf_dir, "removed"), "removed").df


@query(f"SELECT user_id, event_id, event_type, props, NOT is_current AS is_deleted FROM ({_LAST})")
def mode_history_to_soft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes.history_to_soft_delete(_history(spark, sf_dir)).df


@query(f"""
    SELECT user_id, event_id, event_type, props, NOT is_current AS removed, FALSE AS is_deleted FROM ({_LAST})""")
def mode_history_to_soft_own_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _history(spark, sf_dir)
    table = schema.add_column(table, Column("removed", T.BooleanType()))
    return modes.history_to_soft_delete(table, "removed").df


@query(f"SELECT user_id, event_id, event_type, props FROM ({_HISTORY}) WHERE is_current")
def mode_history_to_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes.history_to_live(_history(spark, sf_dir)).df


@query(f"SELECT user_id, event_id, event_type, props FROM ({_HISTORY})")
def mode_history_to_live_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes.history_to_live(_history(spark, sf_dir), keep_deleted_rows=True).df


@query("SELECT *, FALSE AS is_deleted FROM orders")
def mode_live_to_soft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes.live_to_soft_delete(keyed(load(spark, sf_dir, "orders"), "o_orderkey")).df


@query(f"SELECT * REPLACE (COALESCE(is_deleted, FALSE) AS is_deleted) FROM ({_FLAGGED})")
def mode_live_to_soft_existing_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes.live_to_soft_delete(_flagged(spark, sf_dir)).df


_LIVE_TO_HISTORY = """
    SELECT *, TIMESTAMP '2024-06-01 12:00:00' AS valid_from, TIMESTAMP '9999-12-31 23:59:59.999' AS valid_to,
           TRUE AS is_current FROM orders"""


@query(_LIVE_TO_HISTORY)
def mode_live_to_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes.live_to_history(keyed(load(spark, sf_dir, "orders"), "o_orderkey"), at("2024-06-01 12:00:00")).df


@query(_SOFT_TO_HISTORY.format("* EXCLUDE (is_deleted)", _FLAGGED))
def copy_to_history_of_soft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes.copy_table_to_history(_flagged(spark, sf_dir), at("2024-06-01 12:00:00"), "is_deleted").df


@query(_LIVE_TO_HISTORY)
def copy_to_history_of_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = keyed(load(spark, sf_dir, "orders"), "o_orderkey")
    return modes.copy_table_to_history(orders, at("2024-06-01 12:00:00")).df


# --- checks ---


@query("""
    SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT COUNT(*) FILTER (WHERE label IS NOT NULL AND n > 1) AS duplicate_keys,
           CAST(COALESCE(SUM(n) FILTER (WHERE label IS NULL), 0) AS BIGINT) AS null_keys
    FROM (SELECT CASE WHEN event_type <> 'view' THEN user_id END AS label, COUNT(*) AS n FROM events GROUP BY 1)""")
def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("event_type") != "view", F.col("user_id")).alias("label")
    return checks.key_violations(load(spark, sf_dir, "events").select(label), ["label"])
