"""Moving tables between the live, soft-delete and history modes, and whole-table copies.

No migration needs a keyed shuffle of the table except the two that choose the last version per key, and
those limit the rows per key before it.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column as Expr
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ChangeError
from ..functions.skew import first_per_key
from ..functions.types import EPOCH, OPEN_END, default_value, instant, just_before
from ..model import Column, KeyedTable
from .checks import history_ready
from .schema import add_column, drop_column

_PIECE = "__piece"


def copy_table(table: KeyedTable) -> KeyedTable:
    """The same rows, defaults and key for a second table; publishing it is up to the caller."""
    table.require_keys()
    return table


def copy_table_to_history(table: KeyedTable, now: Expr, soft_deleted: str | None = None) -> KeyedTable:
    """History copy of a soft-delete table (``soft_deleted`` names its flag) or of a live table."""
    copied = copy_table(table)
    if soft_deleted:
        return soft_delete_to_history(copied, soft_deleted)
    return live_to_history(copied, now)


def soft_delete_to_live(table: KeyedTable, flag: str | None = None) -> KeyedTable:
    """Remove the flagged rows and the standard flag column; a flag column of the source's own stays."""
    flag = flag or table.spec.system.deleted
    _require(table, flag)
    kept = table.with_df(table.df.filter(~F.coalesce(F.col(flag), F.lit(False))))
    return drop_column(kept, table.spec.system.deleted, if_exists=True)


def soft_delete_to_history(table: KeyedTable, flag: str | None = None) -> KeyedTable:
    """One version per row: open since the last load of the table, or closed at the epoch if flagged."""
    system = table.spec.system
    flag = flag or system.deleted
    _require(table, flag, system.synced)
    last_load = table.df.agg(F.max(system.synced)).scalar()
    gone = F.coalesce(F.col(flag), F.lit(False))
    epoch = instant(EPOCH, system.time_type)
    versioned = _versioned(
        table,
        start=F.when(gone, epoch).otherwise(last_load.cast(system.time_type)),
        end=F.when(gone, epoch).otherwise(instant(OPEN_END, system.time_type)),
        active=~gone,
    )
    return drop_column(versioned, system.deleted, if_exists=True)


def history_to_soft_delete(table: KeyedTable, flag: str | None = None) -> KeyedTable:
    """Keep the last version per key; it is flagged unless active.

    A flag column of the source's own is overwritten, and the standard one added as FALSE.
    """
    system = table.spec.system
    flag = flag or system.deleted
    keys = table.require_source_keys()
    last = first_per_key(table.df, keys, [F.col(system.start).desc()])
    last = last.withColumn(flag, ~F.col(system.active))
    standard = Column(system.deleted, T.BooleanType(), default="false")
    if flag == system.deleted:
        spec = table.spec.put(standard)
    else:
        _require(table, flag)
        last = last.withColumn(system.deleted, F.lit(False))
        spec = table.spec.put(standard)
    spec = spec.without(*system.version_columns).with_keys(keys)
    return KeyedTable(last.select(*spec.names), spec)


def history_to_live(table: KeyedTable, *, keep_deleted_rows: bool = False) -> KeyedTable:
    """Keep the versions that are not closed, or with ``keep_deleted_rows`` all of them, then without key."""
    system = table.spec.system
    df, keys = table.df, []
    if not keep_deleted_rows:
        df = df.filter(F.coalesce(F.col(system.active), F.lit(True)))
        keys = table.require_source_keys()
    spec = table.spec.without(*system.version_columns).with_keys(keys)
    return KeyedTable(df.select(*spec.names), spec)


def live_to_soft_delete(table: KeyedTable, flag: str | None = None) -> KeyedTable:
    """Add the flag if it is missing; rows without a flag value are not deleted."""
    flag = flag or table.spec.system.deleted
    flagged = add_column(table, Column(flag, T.BooleanType()), if_not_exists=True)
    return flagged.with_df(flagged.df.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def live_to_history(table: KeyedTable, now: Expr) -> KeyedTable:
    """One open version per row, starting ``now``."""
    time_type = table.spec.system.time_type
    return _versioned(table, start=now.cast(time_type), end=instant(OPEN_END, time_type), active=F.lit(True))


def add_column_in_history(
    table: KeyedTable, column: Column, default: str, moment: Expr, *, checked: bool = False
) -> KeyedTable:
    """Add a column whose value is known from ``moment`` on.

    Open versions end there and go on with the default; older versions hold NULL. Versions that start at
    that very moment get the default in place, so several columns added at once make one version.
    """
    added = add_column(table, replace(column, default=None))
    if not checked and not history_ready(table, moment):
        return added
    value = default_value(default, column.dtype)
    return _split_versions(added, column.name, value, F.lit(True), moment)


def drop_column_in_history(table: KeyedTable, name: str, moment: Expr, *, checked: bool = False) -> KeyedTable:
    """End the use of a column at ``moment``: open versions that have a value go on with NULL.

    The column itself stays, as older versions keep their values.
    """
    column = table.spec[name]
    if not checked and not history_ready(table, moment):
        return table
    value = default_value(None, column.dtype)
    return _split_versions(table, name, value, F.col(name).isNotNull(), moment)


def _split_versions(table: KeyedTable, name: str, value: Expr, affected: Expr, moment: Expr) -> KeyedTable:
    """Cut affected open versions in two at ``moment``, in one pass and without a shuffle.

    Each row is repeated once per piece: an affected one as its closed and its continuing half.
    """
    system = table.spec.system
    moment = moment.cast(table.spec[system.start].dtype)
    start, end, active = (F.col(c) for c in system.version_columns)
    cut = F.coalesce(active & affected & (start < moment), F.lit(False))
    pieces = F.when(cut, F.array(F.lit("closed"), F.lit("continued"))).otherwise(F.array(F.lit("whole")))
    piece = F.col(_PIECE)
    at_moment = (piece == "continued") | ((piece == "whole") & (start == moment))
    split = table.df.withColumn(_PIECE, F.explode(pieces)).withColumns(
        {
            name: F.when(at_moment, value).otherwise(F.col(name)),
            system.start: F.when(piece == "continued", moment).otherwise(start),
            system.end: F.when(piece == "closed", just_before(moment)).otherwise(end),
            system.active: F.when(piece == "closed", F.lit(False)).otherwise(active),
        }
    )
    return table.with_df(split.select(*table.spec.names))


def _versioned(table: KeyedTable, start: Expr, end: Expr, active: Expr) -> KeyedTable:
    system = table.spec.system
    taken = [c for c in system.version_columns if c in table.spec]
    if taken:
        raise ChangeError(f"The table has version columns already: {taken}")
    df = table.df.withColumns({system.start: start, system.end: end, system.active: active})
    spec = table.spec
    for column in (
        Column(system.start, system.time_type, key=True),
        Column(system.end, system.time_type),
        Column(system.active, T.BooleanType(), default="true"),
    ):
        spec = spec.put(column)
    table.require_keys()
    return KeyedTable(df, spec)


def _require(table: KeyedTable, *names: str) -> None:
    for name in names:
        table.spec[name]
