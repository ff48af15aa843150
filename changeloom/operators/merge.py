"""Keyed change application for live and soft-delete tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..errors import ChangeError
from ..functions.skew import fits_broadcast
from ..functions.types import default_value, from_text
from ..model import KeyedTable, TableSpec

#: Position of a row's file in the batch; later files win.
SEQ = "__seq"
_ROW, _STORED, _DELETED, _PATCH = "__row", "__stored", "__deleted", "__patch_"


def stack(changes: Sequence[DataFrame]) -> DataFrame | None:
    """Several change DataFrames of one kind as one, marked with their order."""
    stacked = None
    for seq, df in enumerate(changes):
        df = df.withColumn(SEQ, F.lit(seq))
        stacked = df if stacked is None else stacked.unionByName(df, allowMissingColumns=True)
    return stacked


def typed(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """The columns of ``changes`` the table has, in table order and with the table's types."""
    cols = [F.col(c.name).cast(c.dtype).alias(c.name) for c in spec.columns if c.name in changes.columns]
    return changes.select(*cols, *_seq(changes))


def one_per_key(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Resolve repeated keys: the last file wins, then the latest load time, then the greatest row.

    An aggregate rather than a window: rows are combined before the shuffle, so a hot key costs one row per
    task, and only the key is sorted.
    """
    cells = [c for c in changes.columns if c not in (*spec.keys, SEQ)]
    if not cells:
        return changes.select(*spec.keys).distinct()
    best = changes.groupBy(*spec.keys).agg(F.max(_ranked(changes, spec, cells)).alias(_ROW))
    return best.select(*spec.keys, *[F.col(_ROW)[c].alias(c) for c in cells])


def insert(table: KeyedTable, rows: DataFrame) -> KeyedTable:
    """Append by column name; columns the rows lack get their default, or NULL."""
    return table.with_df(table.df.unionByName(conform(rows, table.spec)))


def upsert(table: KeyedTable, changes: DataFrame) -> KeyedTable:
    """Insert new keys and overwrite, for known ones, every column that ``changes`` has.

    A table without key just gets the rows appended.
    """
    if not table.spec.keys:
        return insert(table, changes)
    return apply_changes(table, replace=changes)


def update_partial(table: KeyedTable, changes: DataFrame, unmodified: str = "") -> KeyedTable:
    """Change known keys cell by cell; ``changes`` holds text, and the marker keeps the stored value."""
    return apply_changes(table, update=changes, unmodified=unmodified)


def delete_rows(table: KeyedTable, keys: DataFrame) -> KeyedTable:
    """Remove the rows with the given keys; other columns of ``keys`` are ignored."""
    return apply_changes(table, delete=keys)


def apply_changes(
    table: KeyedTable,
    *,
    replace: DataFrame | None = None,
    update: DataFrame | None = None,
    delete: DataFrame | None = None,
    unmodified: str = "",
    small: bool | None = None,
) -> KeyedTable:
    """Apply a batch: all replacements, then all partial updates, then all deletions.

    Each input may stack several files (:func:`stack`). They are first folded into one change per key, in
    one aggregate over batch-sized data, so the target is read and joined once, however many files there
    are. Rows with the same key take effect in the order of file, load time and content.

    If the changes are small (``small=None`` measures them), they are broadcast and the target is not
    shuffled. Otherwise one full outer join keeps, changes and inserts rows in a single pass; the key is
    unique on either side, so no key is hot. A target that lies in buckets of its key is not shuffled then either:
    the changes are sent to its buckets, and so the result comes bucket by bucket. Of a target that lies in ranges of
    its key, only what lies between the least and the greatest key of the changes is joined; the rest is a scan that
    leaves these row groups out.
    """
    spec = table.spec
    keys = table.require_keys()
    if replace is None and update is None and delete is None:
        return table
    if small is None:
        small = all(fits_broadcast(df) for df in (delete, replace, update) if df is not None)
    first = keys[0]
    given = [df for df in (replace, update, delete) if df is not None]
    near, far = _reached(table, [df.select(cell(df, first, F.col(first), spec[first].dtype).alias("key")) for df in given])
    if replace is None and update is None:
        gone = typed(delete.select(*keys), spec)
        left = near.join(F.broadcast(gone) if small else _dealt(gone.distinct(), table), keys, "left_anti")
        return table.with_df(left if far is None else left.unionByName(far))

    upserts = None if replace is None else _with_keys(typed(replace, spec), keys)
    changes = _fold(spec, upserts, update, delete, unmodified)
    replaced, kept = F.col(_ROW).isNotNull(), F.col(_DELETED).isNull()
    stored = near.withColumn(_STORED, F.lit(True))
    if upserts is None:
        lookup = F.broadcast(changes) if small else _dealt(changes, table)
        changed = stored.join(lookup, keys, "left")
    elif not small:
        changed = stored.join(_dealt(changes, table), keys, "full_outer").filter(F.col(_STORED).isNotNull() | replaced)
    else:
        changed, new = stored.join(F.broadcast(changes), keys, "left"), changes.filter(replaced)
        # Stored rows are changed in place, also where a key that should be unique is not: the join below gives the same.
        known = near.select(*keys).join(F.broadcast(changes.select(*keys)), keys, "left_semi")
        new = new.join(known, keys, "left_anti")
        changed = changed.unionByName(new, allowMissingColumns=True)
    result = changed.filter(kept).select(*_cells(spec, upserts, update))
    return table.with_df(result if far is None else result.unionByName(far.select(*spec.names)))


def _reached(table: KeyedTable, keys: list[DataFrame]) -> tuple[DataFrame, DataFrame | None]:
    """The rows of the target that some of ``keys`` (values of the first key column) may meet, and the others.

    Bounds are one aggregate over the change rows, and constants in the plan, so the scans leave out row groups by them.
    """
    if not table.clustered:
        return table.df, None
    every = reduce(DataFrame.unionByName, keys)
    low, high = every.agg(F.min("key").cast("string"), F.max("key").cast("string")).first()
    if low is None:
        return table.df.filter(F.lit(False)), table.df
    name = table.spec.keys[0]
    dtype, key = table.spec[name].dtype, F.col(name)
    low, high = F.lit(low).cast(dtype), F.lit(high).cast(dtype)
    return table.df.filter((key >= low) & (key <= high)), table.df.filter((key < low) | (key > high) | key.isNull())


def _dealt(changes: DataFrame, table: KeyedTable) -> DataFrame:
    """Changes where the target's rows of their keys are, if it lies in buckets."""
    return changes if table.buckets is None else changes.repartition(table.buckets, *table.spec.keys)


def _fold(
    spec: TableSpec,
    upserts: DataFrame | None,
    update: DataFrame | None,
    delete: DataFrame | None,
    unmodified: str,
) -> DataFrame:
    """One row per changed key: the replacing row, the cells to patch, and whether it is deleted.

    A patched cell is a struct around its text, so that "set to NULL" and "leave alone" differ.
    """
    keys = spec.keys
    parts = []
    if upserts is not None:
        cells = [c for c in upserts.columns if c not in (*keys, SEQ)]
        parts.append(upserts.select(*keys, _ranked(upserts, spec, cells).alias(_ROW)))
    if update is not None:
        typed_keys = [cell(update, k, F.col(k), spec[k].dtype).alias(k) for k in keys]
        cells = [c for c in spec.names if c in update.columns and c not in keys]
        # Rows that rank alike are ordered as wholes, so no result mixes cells of two of them.
        tie = [F.xxhash64(*cells).alias("__tie")] if cells else []
        patches = [
            F.when(_is_set(update, c, unmodified), _ranked(update, spec, [*tie, c], unmodified)).alias(_PATCH + c)
            for c in cells
        ]
        parts.append(update.select(*typed_keys, *patches))
    if delete is not None:
        parts.append(typed(delete.select(*keys), spec).withColumn(_DELETED, F.lit(True)))
    tagged = parts[0]
    for part in parts[1:]:
        tagged = tagged.unionByName(part, allowMissingColumns=True)
    values = [c for c in tagged.columns if c not in keys]
    folded = tagged.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values]) if values else tagged.distinct()
    missing = {name: F.lit(None).cast("boolean") for name in (_ROW, _DELETED) if name not in values}
    return folded.withColumns(missing) if missing else folded


def _ranked(changes: DataFrame, spec: TableSpec, cells: Sequence[str | Expr], unmodified: str = "") -> Expr:
    """The cells behind what ranks them, so that the greatest struct is the one that takes effect last."""
    rank = [F.col(c) for c in _seq(changes)]
    synced = spec.system.synced
    if synced in changes.columns and synced in spec:
        loaded = cell(changes, synced, F.col(synced), spec[synced].dtype)
        rank.append(F.when(_is_set(changes, synced, unmodified), loaded).alias("__loaded"))
    return F.struct(*rank, *cells) if rank or cells else F.struct(F.lit(True).alias("__present"))


def _cells(spec: TableSpec, upserts: DataFrame | None, update: DataFrame | None) -> list[Expr]:
    """Final value of each column: the patch, else the replacing row, else what is stored, else the default."""
    out = []
    for c in spec.columns:
        value = F.col(c.name)
        if not c.key:
            if upserts is not None and c.name in upserts.columns:
                value = F.when(F.col(_ROW).isNotNull(), F.col(_ROW)[c.name]).otherwise(value)
            elif upserts is not None and c.default is not None:
                value = F.when(F.col(_STORED).isNull(), default_value(c.default, c.dtype)).otherwise(value)
            if update is not None and c.name in update.columns:
                patch = F.col(_PATCH + c.name)
                value = F.when(patch.isNotNull(), cell(update, c.name, patch[c.name], c.dtype)).otherwise(value)
        out.append(value.alias(c.name))
    return out


def _with_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows to insert; one without key value fails the job."""
    present = {
        k: F.coalesce(F.col(k), F.raise_error(F.lit(f"Key column <{k}> is NULL")).cast(rows.schema[k].dataType))
        for k in keys
    }
    return rows.withColumns(present)


def truncate_before(
    table: KeyedTable,
    synced: str,
    cutoff: Expr,
    deleted: str | None = None,
) -> KeyedTable:
    """Delete the rows loaded strictly before ``cutoff``, or flag them where ``deleted`` names a column.

    Rows without load time stay. Use :func:`cutoff_at` for a cutoff in nanoseconds.
    """
    for name in filter(None, (synced, deleted)):
        if name not in table.spec:
            raise ChangeError(f"Referenced column <{name}> not found")
    old = loaded_before(synced, cutoff)
    if deleted is None:
        return table.with_df(table.df.filter(~old))
    return table.with_df(table.df.withColumn(deleted, F.when(old, F.lit(True)).otherwise(F.col(deleted))))


def loaded_before(synced: str, cutoff: Expr) -> Expr:
    """Rows that a truncation hits; those without load time are never among them."""
    return F.coalesce(F.col(synced) < cutoff, F.lit(False))


def cutoff_at(nanoseconds: int | None) -> Expr:
    """Moment of a cutoff in nanoseconds since the epoch, cut to microseconds; unset means the epoch."""
    micros = abs(nanoseconds or 0) // 1000
    return F.timestamp_micros(F.lit(-micros if (nanoseconds or 0) < 0 else micros).cast("long"))


def update_column_value(table: KeyedTable, column: str, value: str) -> KeyedTable:
    """Set a column of all rows; the text ``NULL`` stands for NULL."""
    target = table.spec[column]
    text = None if value == "NULL" else value
    return table.with_df(table.df.withColumn(column, default_value(text, target.dtype)))


def conform(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """``rows`` with exactly the table's columns; missing ones hold their default, or NULL."""
    rows = typed(rows, spec)
    return rows.select(
        *[
            F.col(c.name) if c.name in rows.columns else default_value(c.default, c.dtype).alias(c.name)
            for c in spec.columns
        ]
    )


def _seq(df: DataFrame) -> list[str]:
    return [SEQ] if SEQ in df.columns else []


def _is_text(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() == "string"


def _is_set(df: DataFrame, name: str, unmodified: str) -> Expr:
    """A cell that carries a value: anything but the marker, and NULL is a value."""
    if not _is_text(df, name):
        return F.lit(True)
    return F.col(name).isNull() | (F.col(name) != F.lit(unmodified))


def cell(df: DataFrame, name: str, value: Expr, dtype: DataType) -> Expr:
    """``value`` of column ``name`` as ``dtype``: parsed where the change DataFrame holds text."""
    return from_text(value, dtype) if _is_text(df, name) else value.cast(dtype)
