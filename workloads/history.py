"""Type-2 history. Every event of a user is a version; a batch re-sends and adds events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom import Column, KeyedTable
from changeloom.operators import checks, history, modes

from .common import MARK, VERSIONS, Query, at, keyed, load, versions_of, versions_sql

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The table was loaded up to LOADED; the batch holds the events from RESENT on, so the two overlap.
LOADED, RESENT = "2024-01-25", "2024-01-20"
_T = versions_sql(f"ts < TIMESTAMP '{LOADED}'")
_E = f"SELECT user_id, MIN(ts) AS first_start FROM events WHERE ts >= TIMESTAMP '{RESENT}' GROUP BY user_id"
_D = "SELECT user_id, MAX(ts) AS close_at FROM events WHERE event_type = 'error' GROUP BY user_id"
_CLOSE = "is_current AND e.user_id IS NOT NULL"


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return register


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events")


def loaded_table(spark: SparkSession, sf_dir: str) -> KeyedTable:
    loaded = _events(spark, sf_dir).filter(F.col("ts") < at(LOADED))
    return keyed(versions_of(loaded).select(*VERSIONS), "user_id", "valid_from")


def _whole(spark: SparkSession, sf_dir: str) -> KeyedTable:
    return keyed(versions_of(_events(spark, sf_dir)).select(*VERSIONS), "user_id", "valid_from")


def _resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).filter(F.col("ts") >= at(RESENT))


def earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resent(spark, sf_dir).groupBy("user_id").agg(F.min("ts").alias("valid_from"))


def deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = _events(spark, sf_dir).filter("event_type = 'error'")
    return errors.groupBy("user_id").agg(F.max("ts").alias("valid_to"))


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The re-sent clicks as text cells: the type, and part of the properties, are those of the version before."""
    recent = versions_of(_resent(spark, sf_dir)).filter("event_type = 'click'")
    text = [F.col(c).cast("string").alias(c) for c in VERSIONS]
    props = F.when(F.col("user_id").cast("int") < 50, MARK).otherwise(F.col("props"))
    return recent.select(*text).withColumns({"event_type": F.lit(MARK), "props": props})


def new_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions_of(_resent(spark, sf_dir)).filter("event_type <> 'click'")


_RECENT = versions_sql(f"ts >= TIMESTAMP '{RESENT}'")
_TRIM = f"""
    SELECT t.*, e.first_start FROM ({_T}) t LEFT JOIN ({_E}) e ON t.user_id = e.user_id
    WHERE e.first_start IS NULL OR t.valid_from < e.first_start"""
_LATEST = f"""
    SELECT * EXCLUDE (first_start) FROM ({_TRIM}) WHERE first_start IS NOT NULL
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY valid_from DESC) = 1"""


@query(f"SELECT * EXCLUDE (first_start) FROM ({_TRIM})")
def hist_drop_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.drop_overlapping(loaded_table(spark, sf_dir), earliest(spark, sf_dir)).df


@query(_LATEST)
def hist_latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.latest_versions(loaded_table(spark, sf_dir), earliest(spark, sf_dir))


@query(f"""
    SELECT t.* REPLACE (
        CASE WHEN {_CLOSE} THEN first_start - INTERVAL '1 millisecond' ELSE valid_to END AS valid_to,
        CASE WHEN {_CLOSE} THEN FALSE ELSE is_current END AS is_current)
    FROM ({versions_sql()}) t LEFT JOIN ({_E}) e ON t.user_id = e.user_id""")
def hist_close_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.close_versions(_whole(spark, sf_dir), earliest(spark, sf_dir)).df


_PARTIAL = f"""
    SELECT s.user_id, s.valid_from, s.valid_to, s.is_current, s.event_id,
           l.event_type, CASE WHEN s.user_id < 50 THEN l.props ELSE s.props END AS props
    FROM ({_RECENT}) s LEFT JOIN ({_LATEST}) l ON s.user_id = l.user_id WHERE s.event_type = 'click'"""


@query(f"SELECT * FROM ({_T}) UNION ALL SELECT * FROM ({_PARTIAL})")
def hist_partial_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = loaded_table(spark, sf_dir)
    latest = history.latest_versions(table, earliest(spark, sf_dir))
    return history.append_partial_versions(table, updates(spark, sf_dir), latest, MARK).df


@query(f"SELECT * FROM ({_T}) UNION ALL SELECT * FROM ({_PARTIAL})")
def hist_partial_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with only the marked columns of earlier versions, by the way taken for many keys."""
    table, update = loaded_table(spark, sf_dir), updates(spark, sf_dir)
    latest = history.previous_cells(table, update, earliest(spark, sf_dir), MARK, small=False)
    return history.append_partial_versions(table, update, latest, MARK).df


@query(f"""
    SELECT * FROM ({versions_sql(f"ts < TIMESTAMP '{RESENT}'")})
    UNION ALL SELECT * FROM ({_RECENT}) WHERE event_type <> 'click'""")
def hist_append_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions that start after all stored ones, so that no key and start comes twice."""
    older = versions_of(_events(spark, sf_dir).filter(F.col("ts") < at(RESENT)))
    return history.append_versions(keyed(older.select(*VERSIONS), "user_id", "valid_from"), new_versions(spark, sf_dir)).df


@query(f"""
    SELECT user_id, ts AS valid_from, CAST(COUNT(*) + COUNT(*) FILTER (WHERE ts < TIMESTAMP '{LOADED}') AS BIGINT) AS row_count
    FROM events WHERE ts >= TIMESTAMP '{RESENT}' GROUP BY user_id, ts
    HAVING user_id IS NULL OR COUNT(*) + COUNT(*) FILTER (WHERE ts < TIMESTAMP '{LOADED}') > 1""")
def hist_resent_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions sent again without earliest starts: the keys that a batch is refused for."""
    return history.refused_versions(loaded_table(spark, sf_dir), versions_of(_resent(spark, sf_dir)))


def _close_deleted_sql(source: str) -> str:
    hit = "is_current AND d.user_id IS NOT NULL"
    return f"""
        SELECT v.* REPLACE (CASE WHEN {hit} THEN close_at ELSE valid_to END AS valid_to,
                            CASE WHEN {hit} THEN FALSE ELSE is_current END AS is_current)
        FROM ({source}) v LEFT JOIN ({_D}) d ON v.user_id = d.user_id"""


@query(_close_deleted_sql(versions_sql()))
def hist_close_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.close_deleted(_whole(spark, sf_dir), deletions(spark, sf_dir)).df


_CLOSED = f"""
    SELECT * EXCLUDE (first_start) REPLACE (
        CASE WHEN is_current AND first_start IS NOT NULL THEN first_start - INTERVAL '1 millisecond'
             ELSE valid_to END AS valid_to,
        CASE WHEN is_current AND first_start IS NOT NULL THEN FALSE ELSE is_current END AS is_current)
    FROM ({_TRIM})"""
_BATCH = _close_deleted_sql(
    f"SELECT * FROM ({_CLOSED}) UNION ALL SELECT * FROM ({_PARTIAL}) "
    f"UNION ALL SELECT * FROM ({_RECENT}) WHERE event_type <> 'click'"
)


@query(_BATCH)
def hist_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _apply(spark, sf_dir, small=None)


@query(_BATCH)
def hist_batch_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``hist_batch``, by the way taken when the keys of the batch are too many to broadcast."""
    return _apply(spark, sf_dir, small=False)


def _apply(spark: SparkSession, sf_dir: str, small: bool | None) -> DataFrame:
    return history.apply_history_batch(
        loaded_table(spark, sf_dir),
        earliest=earliest(spark, sf_dir),
        update=updates(spark, sf_dir),
        replace=new_versions(spark, sf_dir),
        delete=deletions(spark, sf_dir),
        unmodified=MARK,
        small=small,
    ).df


_FIRST_PURCHASE = "SELECT user_id, MIN(ts) AS first_start FROM events WHERE event_type = 'purchase' GROUP BY user_id"


@query(f"""
    SELECT v.* FROM ({versions_sql()}) v LEFT JOIN ({_FIRST_PURCHASE}) e ON v.user_id = e.user_id
    WHERE e.user_id IS NULL OR (valid_from < first_start AND NOT is_current)
    UNION ALL
    SELECT v.* REPLACE (first_start - INTERVAL '1 millisecond' AS valid_to, FALSE AS is_current)
    FROM ({versions_sql()}) v JOIN ({_FIRST_PURCHASE}) e ON v.user_id = e.user_id
    WHERE valid_from < first_start AND is_current
    UNION ALL
    SELECT * FROM ({versions_sql("event_type = 'purchase'")})""")
def hist_late_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch older than most of the table: each user starts anew with the first purchase."""
    purchases = _events(spark, sf_dir).filter("event_type = 'purchase'")
    return history.apply_history_batch(
        _whole(spark, sf_dir),
        earliest=purchases.groupBy("user_id").agg(F.min("ts").alias("valid_from")),
        replace=versions_of(purchases),
    ).df


@query(f"""
    WITH h AS ({versions_sql()})
    SELECT h.*, CAST(NULL AS INTEGER) AS grade FROM h WHERE NOT is_current
    UNION ALL
    SELECT h.* REPLACE (TIMESTAMP '2024-02-01' - INTERVAL '1 millisecond' AS valid_to, FALSE AS is_current),
           CAST(NULL AS INTEGER) FROM h WHERE is_current
    UNION ALL
    SELECT h.* REPLACE (TIMESTAMP '2024-02-01' AS valid_from), CAST(7 AS INTEGER) FROM h WHERE is_current""")
def hist_add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    column = Column("grade", T.IntegerType())
    return modes.add_column_in_history(_whole(spark, sf_dir), column, "7", at("2024-02-01")).df


@query(f"""
    WITH h AS (SELECT * REPLACE (CASE WHEN event_type = 'view' THEN NULL ELSE props END AS props)
               FROM ({versions_sql()})),
         hit AS (SELECT * FROM h WHERE is_current AND props IS NOT NULL)
    SELECT * FROM h WHERE NOT (is_current AND props IS NOT NULL)
    UNION ALL
    SELECT * REPLACE (TIMESTAMP '2024-02-01' - INTERVAL '1 millisecond' AS valid_to, FALSE AS is_current) FROM hit
    UNION ALL
    SELECT * REPLACE (TIMESTAMP '2024-02-01' AS valid_from, CAST(NULL AS VARCHAR) AS props) FROM hit""")
def hist_drop_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _whole(spark, sf_dir)
    some = table.with_df(table.df.withColumn("props", F.when(F.col("event_type") != "view", F.col("props"))))
    return modes.drop_column_in_history(some, "props", at("2024-02-01")).df


_DAMAGED = f"""
    SELECT user_id, valid_from,
           CASE WHEN event_id % 7 = 0 THEN valid_from + INTERVAL '5 days'
                WHEN event_id % 11 = 0 THEN valid_from - INTERVAL '1 second'
                WHEN event_id % 17 = 0 THEN NULL ELSE valid_to END AS valid_to,
           is_current OR event_id % 13 = 0 AS is_current
    FROM ({versions_sql()})"""


@query(f"""
    WITH v AS ({_DAMAGED}),
         s AS (SELECT *, MAX(valid_to) OVER w AS earlier_end, MAX(CAST(is_current AS INTEGER)) OVER w AS earlier_active FROM v
               WINDOW w AS (PARTITION BY user_id ORDER BY valid_from NULLS FIRST, valid_to NULLS FIRST, is_current NULLS FIRST
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT user_id, valid_from, valid_to, is_current, 'ends before it starts' AS problem FROM s WHERE valid_to < valid_from
    UNION ALL
    SELECT user_id, valid_from, valid_to, is_current, 'overlaps an earlier version' FROM s WHERE earlier_end >= valid_from
    UNION ALL
    SELECT user_id, valid_from, valid_to, is_current, 'not the only active version' FROM s WHERE is_current AND earlier_active = 1""")
def hist_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions that were damaged: ends moved to both sides or lost, and closed ones made active."""
    table, number = _whole(spark, sf_dir), F.col("event_id")
    start, end = F.col("valid_from"), F.col("valid_to")
    ends = F.when(number % 7 == 0, start + F.expr("INTERVAL '5' DAY")).when(number % 11 == 0, start - F.expr("INTERVAL '1' SECOND"))
    damaged = table.df.withColumn("valid_to", ends.when(number % 17 == 0, F.lit(None)).otherwise(end))
    return checks.history_violations(table.with_df(damaged.withColumn("is_current", F.col("is_current") | (number % 13 == 0))))


@query(f"""
    SELECT COUNT(*) AS total_rows, MAX(valid_from) FILTER (WHERE is_current) AS last_start,
           MAX(valid_from) FILTER (WHERE is_current) <= TIMESTAMP '2024-02-01' AS ready FROM ({versions_sql()})""")
def hist_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.history_state(_whole(spark, sf_dir), at("2024-02-01"))
