"""Schema evolution. Every change is a projection; the new state is published by the caller."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ChangeError
from ..functions.types import convert, default_value, key_filler, source_type
from ..model import Column, KeyedTable, TableSpec
from .checks import check_new_key


def describe_table(table: KeyedTable) -> DataFrame:
    """One row per column: position, name, source type, precision and scale, key flag and default."""
    rows = []
    for position, c in enumerate(table.spec.columns):
        decimal = isinstance(c.dtype, T.DecimalType)
        rows.append(
            (
                position,
                c.name,
                source_type(c.dtype),
                c.dtype.precision if decimal else None,
                c.dtype.scale if decimal else None,
                c.key,
                c.default,
            )
        )
    schema = (
        "position int, column_name string, column_type string, precision int, scale int, "
        "primary_key boolean, column_default string"
    )
    return table.df.sparkSession.createDataFrame(rows, schema)


def describe_content(table: KeyedTable) -> DataFrame:
    """:func:`describe_table` with the table's ``row_count`` and each column's ``null_count``, from one aggregate over it."""
    names = table.spec.names
    counts = [F.count_if(F.col(c).isNull()).alias(f"null_{k}") for k, c in enumerate(names)]
    found = table.df.agg(F.count(F.lit(1)).alias("row_count"), *counts)
    per_column = F.inline(F.array(*[F.struct(F.lit(k).alias("position"), F.col(f"null_{k}").alias("null_count")) for k in range(len(names))]))
    return describe_table(table).join(found.select("row_count", per_column), "position")


def add_column(table: KeyedTable, column: Column, *, if_not_exists: bool = False) -> KeyedTable:
    """Add a column at the end; existing rows get its default. The text ``NULL`` is just text."""
    if column.name in table.spec:
        if if_not_exists:
            return table
        raise ChangeError(f"Column <{column.name}> already exists")
    df = table.df.withColumn(column.name, default_value(column.default, column.dtype))
    return KeyedTable(df, table.spec.put(column))


def add_column_with_default(table: KeyedTable, column: Column) -> KeyedTable:
    """As :func:`add_column`; on an existing column only the default of later rows changes."""
    _refuse_reserved(table, column.name)
    if column.name not in table.spec:
        return add_column(table, column)
    if column.default is None or column.default == "NULL":
        return table
    return KeyedTable(table.df, table.spec.put(replace(table.spec[column.name], default=column.default)))


def drop_column(table: KeyedTable, name: str, *, if_exists: bool = False) -> KeyedTable:
    if name not in table.spec:
        if if_exists:
            return table
        raise ChangeError(f"Column <{name}> not found")
    return KeyedTable(table.df.drop(name), table.spec.without(name))


def rename_column(table: KeyedTable, old: str, new: str) -> KeyedTable:
    column = table.spec[old]
    _refuse_reserved(table, new)
    if new in table.spec:
        raise ChangeError(f"Column <{new}> already exists")
    columns = [replace(column, name=new) if c.name == old else c for c in table.spec.columns]
    return KeyedTable(table.df.withColumnRenamed(old, new), table.spec.with_columns(columns))


def copy_column(table: KeyedTable, source: str, target: str) -> KeyedTable:
    """A new column with the same type, default and values; it is not part of the key."""
    column = table.spec[source]
    _refuse_reserved(table, target)
    if target in table.spec:
        raise ChangeError(f"Column <{target}> already exists")
    return KeyedTable(
        table.df.withColumn(target, F.col(source)),
        table.spec.put(replace(column, name=target, key=False)),
    )


def change_type(table: KeyedTable, name: str, dtype: T.DataType) -> KeyedTable:
    """Convert a column; a value that does not fit fails the job, and nothing is published."""
    column = table.spec[name]
    df = table.df.withColumn(name, convert(F.col(name), column.dtype, dtype))
    return KeyedTable(df, table.spec.put(replace(column, dtype=dtype)))


@dataclass(frozen=True)
class SchemaDiff:
    """What it takes to get from one specification to another."""

    added: tuple[Column, ...]
    dropped: tuple[str, ...]
    retyped: tuple[Column, ...]
    key_changed: bool
    result: TableSpec


def diff_schema(existing: TableSpec, requested: TableSpec, *, drop_columns: bool) -> SchemaDiff:
    """Compare by name. Columns keep their place, new ones follow in the order of the request.

    A column missing in the request is dropped only with ``drop_columns``; otherwise it stays, but a key
    column among them loses its key status.
    """
    added = tuple(c for c in requested.columns if c.name not in existing)
    missing = [c for c in existing.columns if c.name not in requested]
    retyped, result = [], []
    key_changed = any(c.key for c in added) or any(c.key for c in missing)
    for column in existing.columns:
        if column.name not in requested:
            if not drop_columns:
                result.append(replace(column, key=False))
            continue
        wanted = requested[column.name]
        key_changed = key_changed or wanted.key != column.key
        if wanted.dtype != column.dtype:
            retyped.append(wanted)
        result.append(replace(column, dtype=wanted.dtype, key=wanted.key, default=wanted.default or column.default))
    return SchemaDiff(
        added,
        tuple(c.name for c in missing) if drop_columns else (),
        tuple(retyped),
        key_changed,
        existing.with_columns((*result, *added)),
    )


def alter_table(table: KeyedTable, requested: TableSpec, *, drop_columns: bool = False) -> KeyedTable:
    """Bring a table to the requested columns and key with one projection.

    A key change is refused if it would make rows collide. Columns that join the key are filled with a
    constant, as a key cannot be NULL.
    """
    diff = diff_schema(table.spec, requested, drop_columns=drop_columns)
    if diff.key_changed:
        check_new_key(table, diff.result.keys)
    out = []
    for column in diff.result.columns:
        if column.name in table.spec:
            value = convert(F.col(column.name), table.spec[column.name].dtype, column.dtype)
        else:
            text = column.default
            if text is None and column.key:
                text = key_filler(column.dtype)
            value = default_value(text, column.dtype)
        out.append(value.alias(column.name))
    return KeyedTable(table.df.select(*out), diff.result)


def _refuse_reserved(table: KeyedTable, name: str) -> None:
    if name in table.spec.system.reserved:
        raise ChangeError(f"Column name <{name}> is reserved")
