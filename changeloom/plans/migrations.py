"""Migrations by name, on published tables."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import functions as F

from ..errors import ChangeError, UnsupportedMigration
from ..functions.types import instant
from ..model import KeyedTable, TableSpec
from ..operators import modes, schema
from ..operators.merge import update_column_value
from ..sources.tables import Commit, VersionedTable


def _moment(table: KeyedTable, text: str):
    return instant(text, table.spec[table.spec.system.start].dtype)


def _now(now: str | None):
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")


# Kind of migration -> new state of the table. Arguments are those of the request.
IN_PLACE: dict[str, Callable[..., KeyedTable]] = {
    "rename_column": lambda t, from_column, to_column: schema.rename_column(t, from_column, to_column),
    "copy_column": lambda t, from_column, to_column: schema.copy_column(t, from_column, to_column),
    "add_column_with_default_value": lambda t, column: schema.add_column_with_default(t, column),
    "update_column_value": lambda t, column, value: update_column_value(t, column, value),
    "add_column_in_history_mode": lambda t, column, default, operation_timestamp: modes.add_column_in_history(
        t, column, default, _moment(t, operation_timestamp)
    ),
    "drop_column_in_history_mode": lambda t, column, operation_timestamp: modes.drop_column_in_history(
        t, column, _moment(t, operation_timestamp)
    ),
    "soft_delete_to_live": lambda t, flag=None: modes.soft_delete_to_live(t, flag),
    "soft_delete_to_history": lambda t, flag=None: modes.soft_delete_to_history(t, flag),
    "history_to_soft_delete": lambda t, flag=None: modes.history_to_soft_delete(t, flag),
    "history_to_live": lambda t, keep_deleted_rows=False: modes.history_to_live(
        t, keep_deleted_rows=keep_deleted_rows
    ),
    "live_to_soft_delete": lambda t, flag=None: modes.live_to_soft_delete(t, flag),
    "live_to_history": lambda t, now=None: modes.live_to_history(t, _now(now)),
}

# Kinds whose plan shuffles, so that their rows do not come out bucket by bucket.
REGROUPING = {"history_to_soft_delete"}

# Kind of migration -> content of a second table.
INTO_OTHER: dict[str, Callable[..., KeyedTable]] = {
    "copy_table": lambda t: modes.copy_table(t),
    "copy_table_to_history_mode": lambda t, soft_deleted=None, now=None: modes.copy_table_to_history(
        t, _now(now), soft_deleted
    ),
}


def migrate(table: VersionedTable, kind: str, *, into: VersionedTable | None = None, **arguments: Any) -> Commit:
    """Carry out one migration and publish the result, in the table itself or as the new table ``into``."""
    if kind in IN_PLACE:
        base = table.head()
        current = table.read(version=base.version)
        state = IN_PLACE[kind](current, **arguments)
        if state.df is current.df:  # only the specification changes, as with another default
            return base if state.spec == current.spec else table.evolve(state.spec, base)
        return table.publish(state, base=base, rebalance=kind in REGROUPING or _moves(base, state.spec))
    if kind in INTO_OTHER:
        if into is None:
            raise ChangeError(f"Migration <{kind}> needs a target table")
        base = table.head()
        state = INTO_OTHER[kind](table.read(version=base.version), **arguments)
        created = VersionedTable.create(table.spark, into.path, state.spec, buckets=base.buckets)
        return created.publish(state)
    raise UnsupportedMigration(f"Migration <{kind}> is not supported")


def alter_table(table: VersionedTable, requested: TableSpec, *, drop_columns: bool = False) -> Commit:
    """Bring a published table to the requested columns and key.

    Data is rewritten only if stored values change; a dropped or an empty new column takes just a commit.
    """
    base = table.head()
    current = table.read(version=base.version)
    altered = schema.alter_table(current, requested, drop_columns=drop_columns)
    if altered.spec == current.spec:
        return base
    return table.evolve(altered.spec, base) or table.publish(altered, base=base, rebalance=_moves(base, altered.spec))


def _moves(base: Commit, spec: TableSpec) -> bool:
    """Whether rows change their bucket; otherwise they are written as they lie, without a shuffle."""
    return tuple(spec.source_keys) != base.bucket_keys
