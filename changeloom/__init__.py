"""Change-data application on Spark: typed change files, keyed merges, type-2 history and table modes."""

from .errors import ChangeError, UnsupportedMigration, UserActionError
from .model import BatchFiles, Column, KeyedTable, ReadOptions, SystemColumns, TableSpec
from .session import configure

__all__ = [
    "BatchFiles",
    "ChangeError",
    "Column",
    "KeyedTable",
    "ReadOptions",
    "SystemColumns",
    "TableSpec",
    "UnsupportedMigration",
    "UserActionError",
    "configure",
]
