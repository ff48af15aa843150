"""A batch of change files applied to a published table: stage, plan, publish once."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ChangeError, UserActionError
from ..functions.skew import fits_broadcast
from ..model import BatchFiles, Column, KeyedTable, ReadOptions, SystemColumns, TableSpec
from ..operators.checks import check_keys
from ..operators.history import history_batch_parts, refused_versions
from ..operators.merge import apply_changes, cell, cutoff_at, loaded_before, truncate_before
from ..session import scratch_path
from ..sources.bucketed import open_bucketed, save_bucketed
from ..sources.change_files import deletion_columns, earliest_columns, key_columns, read_changes
from ..sources.tables import Commit, VersionedTable


def write_batch(
    table: VersionedTable,
    files: BatchFiles,
    options: ReadOptions | None = None,
    columns: Sequence[Column] = (),
    *,
    stream: dict[str, int] | None = None,
) -> Commit:
    """Replace, then update, then delete files on a live or soft-delete table.

    ``columns`` are those the files bring; by default all of the table. All files take effect together,
    or none does.
    """
    options = options or ReadOptions()
    base = table.head()
    spec = table.spec(base)
    if not spec.keys:
        raise ChangeError("Batches need a table with a key")
    if files.earliest:
        raise ChangeError("Earliest-start files belong to history tables")
    brought = _brought(spec, columns)
    with _Staging(table.spark, options) as staging:
        replace = staging.read(files.replace, brought)
        update = staging.read(files.update, brought, as_text=True)
        delete = staging.read(files.delete, key_columns(spec))
        touched = _touched(table, base, spec, (replace, update, delete))
        current = table.read(touched, base.version)
        small = all(fits_broadcast(df) for df in (replace, update, delete) if df is not None)
        state = apply_changes(
            current, replace=replace, update=update, delete=delete, unmodified=options.unmodified, small=small
        )
        return table.publish(state, buckets=touched, base=base, stream=stream, rebalance=not small)


def write_bucketed_batch(
    spark: SparkSession,
    name: str,
    into: str,
    files: BatchFiles,
    options: ReadOptions | None = None,
    columns: Sequence[Column] = (),
    *,
    system: SystemColumns | None = None,
    path: str | None = None,
    small: bool | None = None,
) -> KeyedTable:
    """Replace, update and delete files applied to the bucketed catalog table ``name``; the result is the new table ``into``.

    Of a large batch only the change rows are shuffled. ``name`` stays as it is, so readers of it are not disturbed,
    and a view moves them to the result in one step.
    """
    options = options or ReadOptions()
    current = open_bucketed(spark, name, system)
    if files.earliest:
        raise ChangeError("Earliest-start files belong to history tables")
    brought = _brought(current.spec, columns)
    with _Staging(spark, options) as staging:
        replace = staging.read(files.replace, brought)
        update = staging.read(files.update, brought, as_text=True)
        delete = staging.read(files.delete, key_columns(current.spec))
        state = apply_changes(
            current, replace=replace, update=update, delete=delete, unmodified=options.unmodified, small=small
        )
        save_bucketed(state, into, current.buckets, path=path, dealt=True)
    return open_bucketed(spark, into, system)


def write_history_batch(
    table: VersionedTable,
    files: BatchFiles,
    options: ReadOptions | None = None,
    columns: Sequence[Column] = (),
    *,
    stream: dict[str, int] | None = None,
) -> Commit:
    """Earliest-start, update, replace and delete files on a history table."""
    options = options or ReadOptions()
    base = table.head()
    spec = table.spec(base)
    if not spec.source_keys:
        raise ChangeError("Batches need a table with a key")
    brought = _brought(spec, columns)
    with _Staging(table.spark, options) as staging:
        earliest = staging.read(files.earliest, earliest_columns(spec))
        update = staging.read(files.update, brought, as_text=True)
        replace = staging.read(files.replace, brought)
        delete = staging.read(files.delete, deletion_columns(spec))
        touched = _touched(table, base, spec, (earliest, update, replace, delete))
        small = all(fits_broadcast(df) for df in (earliest, update, replace, delete) if df is not None)
        current = table.read(touched, base.version)
        _check_new_versions(current, update, replace, earliest, small)
        moved, settled = history_batch_parts(
            current,
            earliest=earliest,
            update=update,
            replace=replace,
            delete=delete,
            unmodified=options.unmodified,
            small=small or None,
        )
        if moved is None:
            moved, settled = settled, None
        return table.publish(
            current.with_df(moved), settled=settled, buckets=touched, base=base, stream=stream, rebalance=not small
        )


def truncate(
    table: VersionedTable, synced: str, before_ns: int | None = None, deleted: str | None = None
) -> Commit | None:
    """Delete or flag the rows loaded before a moment; a table that does not exist is left alone."""
    if not synced:
        raise ChangeError("Synced column cannot be empty")
    if not table.exists():
        return None
    base = table.head()
    current = table.read(version=base.version)
    cutoff = _cutoff(current, synced, before_ns)
    truncate_before(current, synced, cutoff, deleted)  # names are checked before data is read
    touched = None
    if base.buckets > 1:
        touched = table.touched(current.df.filter(loaded_before(synced, cutoff)), base)
        current = table.read(touched, base.version)
    return table.publish(truncate_before(current, synced, cutoff, deleted), buckets=touched, base=base, rebalance=False)


def load(table: VersionedTable, df: DataFrame, *, check: bool = False) -> Commit:
    """Replace the content of a table, with ``check`` only if its key is unique and never NULL."""
    state = KeyedTable(df, table.spec())
    if check:
        check_keys(state)
    return table.publish(state)


def _check_new_versions(
    current: KeyedTable, update: DataFrame | None, replace: DataFrame | None, earliest: DataFrame | None, small: bool
) -> None:
    """Fail if the batch brings versions whose key is NULL or taken; nothing else enforces the key."""
    keys = current.spec.keys
    if keys == current.spec.source_keys:
        return
    new = None
    for df in (update, replace):
        if df is not None:
            given = [cell(df, k, F.col(k), current.spec[k].dtype) if k in df.columns else F.lit(None).cast(current.spec[k].dtype) for k in keys]
            part = df.select(*[v.alias(k) for k, v in zip(keys, given)])
            new = part if new is None else new.unionByName(part)
    if new is None:
        return
    found = refused_versions(current, new, earliest, small=small).first()
    if found is not None:
        values = ", ".join(f"{k} {found[k]}" for k in keys)
        raise UserActionError(f"Versions need a key of their own, but {found['row_count']} rows would have ({values})")


def _cutoff(current: KeyedTable, synced: str, before_ns: int | None) -> Expr:
    cutoff = cutoff_at(before_ns)
    return cutoff.cast(current.spec[synced].dtype) if synced in current.spec else cutoff


def _brought(spec: TableSpec, columns: Sequence[Column]) -> list[Column]:
    unknown = [c.name for c in columns if c.name not in spec]
    if unknown:
        raise ChangeError(f"Columns not found in the table: {unknown}")
    brought = list(columns) or list(spec.columns)
    missing = [k for k in spec.keys if k not in [c.name for c in brought]]
    if missing:
        raise ChangeError(f"The files must bring the key columns {missing}")
    return brought


class _Staging:
    """Change files parsed once and kept as parquet in the shared scratch folder, until the batch is done.

    The plans use them several times, and a lost executor does not make anyone parse them again.
    """

    def __init__(self, spark: SparkSession, options: ReadOptions) -> None:
        self.spark = spark
        self.options = options
        self.root = scratch_path(spark, "staged")

    def __enter__(self) -> _Staging:
        return self

    def read(self, paths: Sequence[str], columns: Sequence[Column], *, as_text: bool = False) -> DataFrame | None:
        if not paths:
            return None
        path = f"{self.root}/{uuid.uuid4().hex}"
        read_changes(self.spark, paths, columns, self.options, as_text=as_text).write.parquet(path)
        return self.spark.read.parquet(path)

    def __exit__(self, kind, error, trace) -> None:
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
        if isinstance(error, PySparkException) and "record limit" in str(error):
            raise UserActionError(
                f"A change file holds a record beyond the record limit; raise max_record_mib to let it pass. {str(error)[:500]}"
            ) from error


def _touched(
    table: VersionedTable, base: Commit, spec: TableSpec, changes: Sequence[DataFrame | None]
) -> set[int] | None:
    if base.buckets == 1:
        return None
    keys = None
    for df in changes:
        if df is not None:
            part = df.select(*[cell(df, k, F.col(k), spec[k].dtype).alias(k) for k in spec.source_keys])
            keys = part if keys is None else keys.unionByName(part)
    return set() if keys is None else table.touched(keys, base)
