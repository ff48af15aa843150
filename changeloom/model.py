"""Data model: columns, table specifications, keyed tables and reading options."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .errors import ChangeError


@dataclass(frozen=True)
class SystemColumns:
    """Names of the columns that carry the state of a row."""

    # The names the upstream change files use for these columns.
    start: str = "_fivetran_start"
    end: str = "_fivetran_end"
    active: str = "_fivetran_active"
    deleted: str = "_fivetran_deleted"
    synced: str = "_fivetran_synced"

    #: Type given to start and end when a migration creates them.
    time_type: T.DataType = field(default_factory=T.TimestampType)

    @property
    def reserved(self) -> frozenset[str]:
        return frozenset((self.start, self.end, self.active, self.deleted, self.synced))

    @property
    def version_columns(self) -> tuple[str, str, str]:
        return (self.start, self.end, self.active)


@dataclass(frozen=True)
class Column:
    """One column. ``dtype=None`` asks the file reader to detect the type."""

    name: str
    dtype: T.DataType | None = None
    key: bool = False
    #: Text of the default; cast to ``dtype`` where it is used.
    default: str | None = None


@dataclass(frozen=True)
class TableSpec:
    """Ordered columns of a table, with its key and its defaults.

    Spark neither enforces keys nor applies defaults on plain files, so both travel here and in the
    field metadata of :meth:`schema`.
    """

    columns: tuple[Column, ...]
    system: SystemColumns = field(default_factory=SystemColumns)

    def __post_init__(self) -> None:
        object.__setattr__(self, "columns", tuple(self.columns))
        names = [c.name for c in self.columns]
        if len(set(names)) != len(names):
            raise ChangeError(f"Column names must be unique: {names}")
        if any(c in name for name in names for c in ".`"):
            raise ChangeError(f"Column names must not contain dots or backquotes: {names}")

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Iterable[str] = (),
        defaults: Mapping[str, str] | None = None,
        system: SystemColumns | None = None,
    ) -> TableSpec:
        """Specification of an existing DataFrame."""
        keys, defaults = list(keys), dict(defaults or {})
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise ChangeError(f"Key columns not found: {missing}")
        return cls(
            tuple(Column(f.name, f.dataType, f.name in keys, defaults.get(f.name)) for f in df.schema.fields),
            system or SystemColumns(),
        )

    @classmethod
    def from_schema(cls, schema: T.StructType, system: SystemColumns | None = None) -> TableSpec:
        """Inverse of :meth:`schema`."""
        return cls(
            tuple(
                Column(f.name, f.dataType, bool(f.metadata.get("key")), f.metadata.get("default"))
                for f in schema.fields
            ),
            system or SystemColumns(),
        )

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def keys(self) -> list[str]:
        return [c.name for c in self.columns if c.key]

    @property
    def source_keys(self) -> list[str]:
        """The key of the source: without the version start that history tables add to it."""
        return [k for k in self.keys if k != self.system.start]

    def __contains__(self, name: str) -> bool:
        return any(c.name == name for c in self.columns)

    def __getitem__(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise ChangeError(f"Column <{name}> not found")

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, True, _metadata(c)) for c in self.columns])

    def to_json(self) -> str:
        return json.dumps(self.schema().jsonValue())

    def with_columns(self, columns: Iterable[Column]) -> TableSpec:
        return replace(self, columns=tuple(columns))

    def with_keys(self, keys: Iterable[str]) -> TableSpec:
        keys = set(keys)
        return self.with_columns(replace(c, key=c.name in keys) for c in self.columns)

    def without(self, *names: str) -> TableSpec:
        return self.with_columns(c for c in self.columns if c.name not in names)

    def put(self, column: Column) -> TableSpec:
        """Replace the column of that name where it stands, or add it at the end."""
        if column.name in self:
            return self.with_columns(column if c.name == column.name else c for c in self.columns)
        return self.with_columns((*self.columns, column))


def _metadata(column: Column) -> dict:
    meta: dict = {}
    if column.key:
        meta["key"] = True
    if column.default is not None:
        meta["default"] = column.default
    return meta


@dataclass(frozen=True)
class KeyedTable:
    """A lazy DataFrame and its specification: what every operator takes and returns."""

    df: DataFrame
    spec: TableSpec
    #: In how many buckets of the key the rows are known to lie, if they are (:mod:`changeloom.sources.bucketed`).
    buckets: int | None = None
    #: Whether the rows are known to lie in ranges of the key (:mod:`changeloom.sources.clustered`).
    clustered: bool = False

    @classmethod
    def of(cls, df: DataFrame, keys: Iterable[str] = (), **kwargs) -> KeyedTable:
        return cls(df, TableSpec.of(df, keys, **kwargs))

    def with_df(self, df: DataFrame) -> KeyedTable:
        return KeyedTable(df, self.spec)

    def require_keys(self) -> list[str]:
        if not self.spec.keys:
            raise ChangeError("The operation needs a table with a key")
        return self.spec.keys

    def require_source_keys(self) -> list[str]:
        if not self.spec.source_keys:
            raise ChangeError("The table has no key columns besides the version start")
        return self.spec.source_keys


# Bounds of the record size option, in MiB.
RECORD_SIZE_DEFAULT = 24
RECORD_SIZE_MIN = 24
RECORD_SIZE_MAX = 1024


@dataclass(frozen=True)
class ReadOptions:
    """How to read change files.

    ``keys`` maps a file path to its AES key; a file without an entry is read as it is, unless
    ``encrypted`` says that every file must have one.
    """

    null_value: str = ""
    unmodified: str = ""
    max_record_mib: int = RECORD_SIZE_DEFAULT
    encrypted: bool = False
    keys: Mapping[str, bytes] = field(default_factory=dict)
    #: Plain files above this size are cut at record boundaries and parsed by many tasks.
    split_bytes: int = 256 * 1024 * 1024

    @property
    def record_bytes(self) -> int:
        return max(RECORD_SIZE_MIN, min(RECORD_SIZE_MAX, self.max_record_mib)) * 1024 * 1024


@dataclass(frozen=True)
class BatchFiles:
    """The files of one batch, each list in the order in which it is to be applied."""

    replace: tuple[str, ...] = ()
    update: tuple[str, ...] = ()
    delete: tuple[str, ...] = ()
    #: History tables only: one row per key with the earliest version start of the batch.
    earliest: tuple[str, ...] = ()
