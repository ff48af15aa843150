"""Checks that read data: key uniqueness, and readiness of a history table for a migration."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import ChangeError, UserActionError
from ..model import KeyedTable
from ..session import scratch_path, shuffle_partitions


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their ``row_count``. Counts are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``duplicate_keys`` and ``null_keys``, the numbers of repeated key values and of NULL keys."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.agg(
        F.count(F.when(~has_null & (F.col("rows") > 1), 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(has_null, F.col("rows"))), F.lit(0)).alias("null_keys"),
    )


def check_keys(table: KeyedTable) -> None:
    """Raise if the key is not unique or holds NULL. Spark does not enforce keys, so this costs an aggregate."""
    if not table.spec.keys:
        return
    found = key_violations(table.df, table.spec.keys).first()
    if found["duplicate_keys"] or found["null_keys"]:
        raise UserActionError(
            f"Key ({', '.join(table.spec.keys)}) violated: {found['duplicate_keys']} repeated values, "
            f"{found['null_keys']} rows with NULL"
        )


def check_new_key(table: KeyedTable, new_keys: Sequence[str]) -> None:
    """Raise if the rows would not be unique under ``new_keys``, some of which may not exist yet.

    New key columns hold one constant, so only the existing ones can tell rows apart.
    """
    if not new_keys:
        return
    known = [k for k in new_keys if k in table.spec]
    if known:
        found = key_violations(table.df, known).first()
        if found["null_keys"]:
            raise UserActionError(f"{found['null_keys']} rows have no value in the new key ({', '.join(known)})")
        clash = bool(found["duplicate_keys"])
    else:
        clash = table.df.limit(2).count() > 1
    if clash:
        raise UserActionError(
            f"Several rows agree in ({', '.join(known)}), so that cannot be the key; make the rows differ first"
        )


def key_conflicts(table: KeyedTable, new_keys: Sequence[str]) -> DataFrame:
    """The rows that :func:`check_new_key` refuses a key change for: values of the new key's existing columns that several
    rows have or that hold NULL, with their ``row_count``. If all its columns are new, any two rows collide and there is
    the count alone."""
    known = [k for k in new_keys if k in table.spec]
    if not known:
        return table.df.agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > (1 if new_keys else 2**62))
    empty = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in known])
    counted = table.df.groupBy(*known).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter(empty | (F.col("row_count") > 1))


#: What :func:`history_violations` finds.
BACKWARD, OVERLAP, ACTIVE = "ends before it starts", "overlaps an earlier version", "not the only active version"


def history_violations(table: KeyedTable, *, partitions: int | None = None) -> DataFrame:
    """Versions that break a history table: source key, start, end, active flag and the ``problem``, a row for each.

    A version *ends before it starts*; *overlaps an earlier version* of its key if one ends at or after its start; or is
    *not the only active version* if an earlier one is active as well. Earlier is by start, end and active flag, NULL
    first. Versions without start or end are not known to overlap; NULL keys count as one key.

    A sweep over range partitions of (key, start): each carries the greatest end and the active flag of a key so far,
    first inside a partition, then across its border. So a key with any share of the versions is spread over as many
    partitions as it fills. What crosses borders is a row for each partition's first and last key.
    """
    keys, system = table.require_source_keys(), table.spec.system
    start, end, active = (F.col(c) for c in system.version_columns)
    spark = table.df.sparkSession
    n = partitions or shuffle_partitions(spark)
    part, top, first_active = "__part", "__greatest_end", "__some_active"
    order = [*keys, *system.version_columns]
    path = scratch_path(spark, "sweep")
    dealt = table.df.select(*order).repartitionByRange(n, *order)
    dealt.withColumn(part, F.spark_partition_id()).write.parquet(path)
    versions = spark.read.parquet(path)

    inside = Window.partitionBy(part, *keys).orderBy(*system.version_columns).rowsBetween(Window.unboundedPreceding, -1)
    swept = versions.withColumns({top: F.max(end).over(inside), first_active: F.bool_or(active).over(inside)})

    # Two rows for each partition at most, so they can be broadcast.
    one = F.struct(*keys)
    borders = versions.groupBy(part).agg(F.array_distinct(F.array(F.min(one), F.max(one))).alias("keys"))
    borders = borders.select(part, F.inline("keys"))
    at_border = _null_safe(versions.alias("v"), F.broadcast(borders.alias("b")), [part, *keys], "left_semi")
    sums = at_border.groupBy(part, *keys).agg(F.max(end).alias(top), F.bool_or(active).alias(first_active))
    across = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(part, *keys, F.max(top).over(across).alias("__carried_end"), F.bool_or(first_active).over(across).alias("__carried_active"))

    joined = _null_safe(swept.alias("v"), F.broadcast(carried.alias("b")), [part, *keys], "left")
    joined = joined.select("v.*", "b.__carried_end", "b.__carried_active")
    greatest, some = F.greatest(top, "__carried_end"), F.coalesce(first_active, F.lit(False)) | F.coalesce("__carried_active", F.lit(False))
    problems = F.array(
        F.when(end < start, F.lit(BACKWARD)), F.when(greatest >= start, F.lit(OVERLAP)), F.when(active & some, F.lit(ACTIVE))
    )
    return joined.select(*order, F.explode(F.array_compact(problems)).alias("problem"))


def _null_safe(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """A join of the aliases v and b on columns of which some may be NULL."""
    on = reduce(lambda a, b: a & b, [F.col(f"v.{c}").eqNullSafe(F.col(f"b.{c}")) for c in names])
    return left.join(right, on, how)


def history_state(table: KeyedTable, moment: Expr) -> DataFrame:
    """One row: ``total_rows``, ``last_start`` of the active versions, and whether the table is ``ready``.

    ``ready`` is FALSE for an empty table, and NULL where an active version starts after ``moment``.
    """
    system = table.spec.system
    state = table.df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.max(F.when(F.col(system.active), F.col(system.start))).alias("last_start"),
    )
    ready = (
        F.when(F.col("total_rows") == 0, F.lit(False))
        .when(F.col("last_start") > moment, F.lit(None))
        .otherwise(F.lit(True))
    )
    return state.withColumn("ready", ready)


def history_ready(table: KeyedTable, moment: Expr) -> bool:
    """Whether versions can be closed at ``moment``: False if there are none, an error if one is newer."""
    ready = history_state(table, moment).first()["ready"]
    if ready is None:
        raise ChangeError("Some active version starts after the moment of the migration")
    return ready
