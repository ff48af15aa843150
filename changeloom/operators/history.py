"""Type-2 history: one row per key and version.

A version row has a start, an end and an active flag; the table's key is the source key plus the start.
The change inputs are:

* ``earliest``: source key and the earliest version start that the batch brings for it,
* ``update``: new versions as text cells, where the marker stands for the previous version's value,
* ``replace``: complete new versions,
* ``delete``: source key and the end of its last version.

A key may own any share of the versions, so every join of the target goes through
:mod:`changeloom.functions.skew`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.skew import first_per_key, fits_broadcast, lookup_join, lookup_parts
from ..functions.types import just_before
from ..model import KeyedTable
from .merge import SEQ, cell, conform, insert, typed

_FIRST, _CLOSE = "__first_start", "__close_at"


def drop_overlapping(table: KeyedTable, earliest: DataFrame, *, small: bool | None = None) -> KeyedTable:
    """Delete the versions, active or not, that start at or after the earliest start of their key."""
    return table.with_df(_union(table, *_trimmed(table, _first_starts(table, earliest), small)))


def latest_versions(
    table: KeyedTable,
    earliest: DataFrame,
    *,
    only: DataFrame | None = None,
    small: bool | None = None,
) -> DataFrame:
    """For each key of ``earliest``, the version with the greatest start before the earliest start.

    Inactive versions count as well. ``only`` limits the answer to the keys it holds.
    """
    keys = table.require_source_keys()
    start = F.col(table.spec.system.start)
    starts = _first_starts(table, earliest)
    if only is not None:
        starts = starts.join(only.select(*keys).distinct(), keys, "left_semi")
    before = lookup_join(
        table.df, starts, keys, salt_by=[table.spec.system.start], how="inner", small=small
    ).filter(start < F.col(_FIRST))
    return first_per_key(before.select(*table.spec.names), keys, [start.desc()])


def marked_columns(table: KeyedTable, update: DataFrame, unmodified: str = "") -> list[str]:
    """The columns of which some cell of ``update`` holds the marker; one aggregate over the change rows."""
    cells = _markable(table, update)
    if not cells:
        return []
    found = update.agg(*[F.bool_or(_holds(c, unmodified)).alias(c) for c in cells]).first()
    return [c for c in cells if found[c]]


def previous_cells(
    table: KeyedTable, update: DataFrame, earliest: DataFrame, unmodified: str = "", *, small: bool | None = None
) -> DataFrame | None:
    """What :func:`append_partial_versions` needs for marked cells: for each key with one, the columns in which markers
    stand, as of the version before the earliest start. None if nothing is marked.

    Of the stored versions only keys, starts and these columns are read. A version's cells travel to the key's
    latest ones as an aggregate, so one row per key and task is shuffled, not one per version; where the keys are too
    many to be broadcast, that is preceded by the keyed lookup of the earliest start, on the same few columns.
    """
    marked = marked_columns(table, update, unmodified)
    if not marked:
        return None
    keys, start = table.require_source_keys(), table.spec.system.start
    anything = reduce(lambda a, b: a | b, [_holds(c, unmodified) for c in marked])
    wanted = update.filter(anything).select(*[cell(update, k, F.col(k), table.spec[k].dtype).alias(k) for k in keys])
    starts = _first_starts(table, earliest).join(wanted.distinct(), keys, "left_semi")
    stored = table.df.select(*keys, start, *[c for c in marked if c != start])
    before = lookup_join(stored, starts, keys, salt_by=[start], how="inner", small=small).filter(F.col(start) < F.col(_FIRST))
    latest = before.groupBy(*keys).agg(F.max_by(F.struct(*marked), start).alias("__cells"))
    return latest.select(*keys, *[F.col("__cells")[c].alias(c) for c in marked])


def _markable(table: KeyedTable, update: DataFrame) -> list[str]:
    keys = table.require_source_keys()
    return [c for c in update.columns if c in table.spec and c not in keys and update.schema[c].dataType.typeName() == "string"]


def _holds(column: str, unmodified: str) -> Expr:
    return F.coalesce(F.col(column) == F.lit(unmodified), F.lit(False))


def close_versions(table: KeyedTable, earliest: DataFrame, *, small: bool | None = None) -> KeyedTable:
    """Close the active versions of the keys in ``earliest``, one millisecond before its start."""
    starts = _first_starts(table, earliest)
    ends = starts.select(*table.require_source_keys(), _ending(just_before(F.col(_FIRST))))
    return table.with_df(_union(table, *_close(table, ends, small)))


def append_versions(table: KeyedTable, versions: DataFrame) -> KeyedTable:
    """Add complete versions; they bring their own start, end and active flag."""
    return insert(table, versions)


def refused_versions(
    table: KeyedTable, versions: DataFrame, earliest: DataFrame | None = None, *, small: bool | None = None
) -> DataFrame:
    """Key values of new ``versions`` that the table's key does not admit, and the ``row_count`` each would come to.

    These hold NULL, come more than once, or are stored and not dropped by ``earliest``. Of the target only key
    columns are read, from the first new start on; if the new keys are few it is not shuffled.
    """
    spec, keys, start = table.spec, table.spec.keys, table.spec.system.start
    source_keys = table.require_source_keys()
    values = [cell(versions, k, F.col(k), spec[k].dtype) if k in versions.columns else F.lit(None).cast(spec[k].dtype) for k in keys]
    brought = versions.select(*[v.alias(k) for k, v in zip(keys, values)]).groupBy(*keys).agg(F.count(F.lit(1)).alias("__brought"))
    oldest = _least(brought, start)
    stored = table.df.select(*keys) if oldest is None else table.df.select(*keys).filter(F.col(start) >= oldest)
    if small is None:
        small = fits_broadcast(brought.select(*keys))
    wanted = brought.select(*keys)
    stored = stored.join(F.broadcast(wanted) if small else wanted, keys, "left_semi")
    if earliest is not None:
        kept = F.col(_FIRST).isNull() | (F.col(start) < F.col(_FIRST))
        stored = stored.join(_first_starts(table, earliest), source_keys, "left").filter(kept)
    counted = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("__stored"))
    rows = F.col("__brought") + F.coalesce("__stored", F.lit(0))
    empty = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return brought.join(counted, keys, "left").filter(empty | (rows > 1)).select(*keys, rows.alias("row_count"))


def append_partial_versions(
    table: KeyedTable,
    update: DataFrame,
    latest: DataFrame | None,
    unmodified: str = "",
    *,
    small: bool = False,
) -> KeyedTable:
    """Add new versions given as text cells, taking marked cells from ``latest``.

    That is :func:`latest_versions`, or of these the columns with markers (:func:`previous_cells`). A key without
    previous version gets NULL there. ``small`` states that ``latest`` may be broadcast.
    """
    return insert(table, _completed(table, update, latest, unmodified, small))


def close_deleted(table: KeyedTable, deletions: DataFrame, *, small: bool | None = None) -> KeyedTable:
    """Close the active versions of the given keys at the given end; nothing is removed."""
    return table.with_df(_union(table, *_close(table, _deletion_ends(table, deletions), small)))


def apply_history_batch(table: KeyedTable, **batch) -> KeyedTable:
    """Apply a batch in the order earliest, update, replace, delete, as one plan.

    Takes the arguments of :func:`history_batch_parts`.
    """
    return table.with_df(_union(table, *history_batch_parts(table, **batch)))


def history_batch_parts(
    table: KeyedTable,
    *,
    earliest: DataFrame | None = None,
    update: DataFrame | None = None,
    replace: DataFrame | None = None,
    delete: DataFrame | None = None,
    unmodified: str = "",
    small: bool | None = None,
) -> tuple[DataFrame | None, DataFrame | None]:
    """The state after a batch in two parts: rows that moved or are new, and rows that lie as they were read.

    ``earliest`` and ``delete`` are folded into one row per key first, so trimming, closing and deleting
    take one join of the target. A second read of it, limited to the keys and columns of marked cells, finds what
    they held before. Without ``earliest`` there are no previous versions to take from.

    The key sets of ``earliest`` and ``delete`` are narrow. If they are small (``small=None`` measures
    them), the stored versions are not shuffled at all.
    """
    spec = table.spec
    keys = table.require_source_keys()
    if small is None:
        small = all(
            fits_broadcast(df.select(*keys, moment))
            for df, moment in ((earliest, spec.system.start), (delete, spec.system.end))
            if df is not None
        )
    starts = None if earliest is None else _first_starts(table, earliest)
    ends = None if delete is None else _deletion_ends(table, delete)

    new = None
    if update is not None:
        latest = None
        if starts is not None:
            latest = previous_cells(table, update, earliest, unmodified, small=small)
        new = _completed(table, update, latest, unmodified, small=False)
    if replace is not None:
        rows = conform(replace, spec)
        new = rows if new is None else new.unionByName(rows)
    if new is not None and ends is not None:
        new, _ = _close(table.with_df(new), ends, small, rescan=False)

    if starts is not None:
        moved, settled = _settled(table, starts, ends, small)
    elif ends is not None:
        moved, settled = _close(table, ends, small)
    else:
        moved, settled = None, table.df
    parts = [df.select(*spec.names) for df in (moved, new) if df is not None]
    if settled is not None:
        settled = settled.select(*spec.names)
    return (reduce(DataFrame.unionByName, parts) if parts else None), settled


def _union(table: KeyedTable, *parts: DataFrame | None) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.select(*table.spec.names) for df in parts if df is not None])


def _settled(
    table: KeyedTable, starts: DataFrame, ends: DataFrame | None, small: bool | None
) -> tuple[DataFrame, DataFrame | None]:
    """Stored versions after trimming, closing and deleting, with one lookup per version."""
    folded = starts.withColumn("__by_start", F.struct(just_before(F.col(_FIRST)).alias("end")))
    if ends is None:
        folded = folded.withColumnRenamed("__by_start", _CLOSE)
    else:
        folded = folded.join(ends, table.require_source_keys(), "full_outer")
        folded = folded.withColumn(_CLOSE, F.coalesce("__by_start", _CLOSE)).drop("__by_start")
    kept, idle = _trimmed(table, folded, small, earliest=starts)
    return _closed(table, kept), idle


def _trimmed(
    table: KeyedTable, folded: DataFrame, small: bool | None, earliest: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """The target with the lookup columns of ``folded``, without the versions from the first start on.

    Versions that are closed and older than every start of the batch cannot be touched. They are most of a
    history table, so they are kept out of the keyed shuffle.
    """
    system, keys = table.spec.system, table.require_source_keys()
    touchable = untouchable = None
    if not small:
        active, start = F.col(system.active), F.col(system.start)
        touchable, untouchable = active == F.lit(True), active.isNull() | (active == F.lit(False))
        oldest = _least(folded if earliest is None else earliest, _FIRST)
        if oldest is not None:
            touchable, untouchable = touchable | (start >= oldest), untouchable & (start.isNull() | (start < oldest))
    joined, idle = lookup_parts(
        table.df, folded, keys, salt_by=[system.start], eligible=touchable, idle=untouchable, small=small
    )
    # A version without start is not known to overlap, so it stays.
    return joined.filter(~F.coalesce(F.col(system.start) >= F.col(_FIRST), F.lit(False))), idle


def _least(df: DataFrame, column: str) -> Expr | None:
    """The least value of a column as a constant, so that scans can be pruned by it; None without any."""
    text = df.agg(F.min(column).cast("string")).first()[0]
    return None if text is None else F.lit(text).cast(df.schema[column].dataType)


def _close(
    table: KeyedTable, ends: DataFrame, small: bool | None, *, rescan: bool = True
) -> tuple[DataFrame, DataFrame | None]:
    """Only active versions can match, and a key has one of them, so no key is hot here."""
    system = table.spec.system
    joined, idle = lookup_parts(
        table.df,
        ends,
        table.require_source_keys(),
        salt_by=[system.start],
        eligible=None if small else F.col(system.active) == F.lit(True),
        idle=F.col(system.active).isNull() | (F.col(system.active) == F.lit(False)),
        small=small,
        detect=False,
        rescan=rescan,
    )
    return _closed(table, joined).select(*table.spec.names), idle


def _ending(end: Expr) -> Expr:
    """Wrapped, so that a given end of NULL differs from no end given."""
    return F.struct(end.alias("end")).alias(_CLOSE)


def _closed(table: KeyedTable, joined: DataFrame) -> DataFrame:
    system = table.spec.system
    end = F.col(_CLOSE)["end"]
    hit = F.coalesce(F.col(system.active), F.lit(False)) & F.col(_CLOSE).isNotNull()
    end_type = table.spec[system.end].dtype
    return joined.withColumns(
        {
            system.end: F.when(hit, end.cast(end_type)).otherwise(F.col(system.end)),
            system.active: F.when(hit, F.lit(False)).otherwise(F.col(system.active)),
        }
    )


def _first_starts(table: KeyedTable, earliest: DataFrame) -> DataFrame:
    """One row per key; several files may name a key, and the earliest start counts."""
    spec, keys = table.spec, table.require_source_keys()
    given = typed(earliest.select(*keys, spec.system.start), spec)
    return given.groupBy(*keys).agg(F.min(spec.system.start).alias(_FIRST))


def _deletion_ends(table: KeyedTable, deletions: DataFrame) -> DataFrame:
    """One row per key; the first file closes a version, and a later one finds nothing open."""
    spec, keys = table.spec, table.require_source_keys()
    end = F.col(spec.system.end)
    seq = [SEQ] if SEQ in deletions.columns else []
    given = typed(deletions.select(*keys, spec.system.end, *seq), spec)
    first = F.min(F.struct(*seq, end.alias("end")))
    return given.groupBy(*keys).agg(_ending(first["end"]))


def _completed(
    table: KeyedTable, update: DataFrame, latest: DataFrame | None, unmodified: str, small: bool
) -> DataFrame:
    spec, keys = table.spec, table.require_source_keys()
    typed_keys = [cell(update, k, F.col(k), spec[k].dtype).alias(k) for k in keys]
    cells = [c for c in spec.columns if c.name in update.columns and c.name not in keys]
    rows = update.select(*typed_keys, *[F.col(c.name).alias(f"__new_{c.name}") for c in cells])
    if latest is not None:
        known = [c.name for c in cells if c.name in latest.columns]
        previous = latest.select(*keys, *[F.col(c).alias(f"__old_{c}") for c in known])
        start = f"__new_{spec.system.start}"
        rows = lookup_join(rows, previous, keys, salt_by=[start if start in rows.columns else keys[0]], small=small)
    out = [F.col(k) for k in keys]
    for c in cells:
        new = F.col(f"__new_{c.name}")
        value = cell(update, c.name, new, c.dtype)
        if update.schema[c.name].dataType.typeName() == "string":
            old = F.col(f"__old_{c.name}") if latest is not None and c.name in known else F.lit(None).cast(c.dtype)
            value = F.when(new == F.lit(unmodified), old).otherwise(value)
        out.append(value.alias(c.name))
    return conform(rows.select(*out), spec)
