"""Typed reading of CSV change files.

Cells are matched to columns by header name, whatever their order. All routes give text cells first, and
one set of expressions turns them into NULLs and typed values. The format is fixed: comma, double quotes
doubled inside quoted cells, ``\\n`` between records, UTF-8, one header line. A file with other bytes, or with a quoted
cell that is never closed, fails the batch, however large it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ChangeError
from ..functions.types import from_text, source_type, try_from_text
from ..model import Column, ReadOptions, TableSpec
from ..operators.merge import SEQ
from ..session import scratch_path
from .damage import refuse_damaged
from .files import ChangeFile, cell_bytes, probe, with_position, within
from .records import read_split
from .sealed import read_sealed, sealed_headers

# Records with missing or extra cells fail. Cells grow as needed: a fixed bound would be allocated up
# front by every task, so the record size is checked after parsing.
_CSV = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "multiLine": "true",
    "lineSep": "\n",
    "mode": "FAILFAST",
    "columnPruning": "false",
    "maxCharsPerColumn": "-1",
    "maxColumns": "100000",
}


def read_changes(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[Column] = (),
    options: ReadOptions | None = None,
    *,
    as_text: bool = False,
) -> DataFrame:
    """Rows of one or more change files, with exactly ``columns`` in that order.

    Without ``columns``, those of the header, with detected types. A cell that is not of its type fails
    the job that uses it. ``as_text`` leaves the cells as text, for files in which the unmodified marker
    may stand in any column. Several files are marked with their order in the column ``SEQ``.
    """
    options = options or ReadOptions()
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = _opened(spark, paths, options)
    wanted = list(columns) or [Column(name) for name in _common_header(files)]
    names = [c.name for c in wanted]

    raw = _raw(spark, files, names, options)
    text = raw.select(*[_null_or_text(F.col(n), options.null_value).alias(n) for n in names], SEQ)
    if not as_text:
        untyped = [c.name for c in wanted if c.dtype is None]
        detected = detect_types(text, untyped) if untyped else {}
        text = text.select(
            *[from_text(F.col(c.name), c.dtype or detected[c.name]).alias(c.name) for c in wanted], SEQ
        )
    return text if len(paths) > 1 else text.drop(SEQ)


def read_checked(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[Column],
    options: ReadOptions | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The good rows of change files, as :func:`read_changes` gives them, and what is wrong with the others.

    The second DataFrame has a row for each bad cell: ``file`` (position in the list), ``record`` (number in the file,
    from 1), ``column``, ``reason`` and ``cell`` (its text). A record with too many or too few cells, or beyond the
    record limit, is one row without column. Files that several tasks read, or that are sealed, have no record numbers,
    and a wrong number of cells fails them. Damaged files (:mod:`changeloom.sources.damage`) fail as ever.

    Files are parsed once; both results are read from what was kept in the shared scratch folder.
    """
    options = options or ReadOptions()
    paths = [paths] if isinstance(paths, str) else list(paths)
    untyped = [c.name for c in columns if c.dtype is None]
    if untyped or not columns:
        raise ChangeError(f"Checked reading needs the types of all columns: {untyped}")
    names = [c.name for c in columns]
    parts = []
    for kind, header, members in _groups(_opened(spark, paths, options), names, options):
        if kind == "whole":
            part = _read_permissive(spark, members, header, names)
            size = F.when(cell_bytes(header) > options.record_bytes, F.lit(True)).otherwise(F.lit(False))
            parts.append(part.withColumn("__long", size).select(SEQ, "__at", "__record", "__long", *names))
        else:
            part = _raw_group(spark, kind, header, members, names, options)
            none = [F.lit(None).cast("long").alias("__at"), F.lit(None).cast("string").alias("__record"), F.lit(False).alias("__long")]
            parts.append(part.select(SEQ, *none, *names))
    raw = reduce(DataFrame.unionByName, parts)
    cells = {c.name: _null_or_text(F.col(c.name), options.null_value) for c in columns}
    values = {c.name: try_from_text(cells[c.name], c.dtype) for c in columns}

    def bad(condition: Expr, reason: str, column: str | None = None, cell: Expr | None = None) -> Expr:
        texts = (F.lit(column).alias("column"), F.lit(reason).alias("reason"), (F.lit(None) if cell is None else cell).cast("string").alias("cell"))
        return F.when(condition, F.struct(*texts))

    whole = F.col("__record").isNull() & ~F.col("__long")
    found = [bad(F.col("__record").isNotNull(), "wrong number of cells", None, F.col("__record"))]
    found.append(bad(F.col("__long"), f"beyond the record limit of {options.record_bytes // 2**20} MiB"))
    for c in columns:
        filled = F.nullif(cells[c.name], F.lit("")).isNotNull() & values[c.name].isNull()
        found.append(bad(whole & filled, f"not {source_type(c.dtype)}", c.name, cells[c.name]))
    checked = raw.select(SEQ, "__at", F.array_compact(F.array(*found)).alias("__bad"), *[values[n].alias(n) for n in names])
    path = scratch_path(spark, "checked")
    checked.write.parquet(path)
    checked = spark.read.schema(checked.schema).parquet(path)

    good = checked.filter(F.size("__bad") == 0).select(*names, *([SEQ] if len(paths) > 1 else []))
    # Numbers run through a task; a file is one stretch of them.
    first = checked.groupBy(SEQ).agg(F.min("__at").alias("__first"))
    broken = checked.filter(F.size("__bad") > 0).join(first, SEQ)
    record = (F.col("__at") - F.col("__first") + 1).alias("record")
    return good, broken.select(F.col(SEQ).alias("file"), record, F.inline("__bad"))


def _opened(spark: SparkSession, paths: Sequence[str], options: ReadOptions) -> list[ChangeFile]:
    """The files with their headers."""
    if not paths:
        raise ChangeError("No change files given")
    for path in paths:
        if options.encrypted and path not in options.keys:
            raise ChangeError(f"Missing encryption key for file <{path}>")
    files = probe(spark, paths, [path in options.keys for path in paths])
    sealed = [f for f in files if not f.direct]
    if not sealed:
        return files
    found = sealed_headers(spark, sealed, options)
    return [f if f.direct else replace(f, header=found[f.seq][0], compressed=found[f.seq][1]) for f in files]


def key_columns(spec: TableSpec) -> list[Column]:
    """What is read of a delete file of a live or soft-delete table."""
    return [c for c in spec.columns if c.key]


def earliest_columns(spec: TableSpec) -> list[Column]:
    """What is read of an earliest-start file: the source key and the version start."""
    return [c for c in spec.columns if c.name in (*spec.source_keys, spec.system.start)]


def deletion_columns(spec: TableSpec) -> list[Column]:
    """What is read of a delete file of a history table: the source key and the version end."""
    return [c for c in spec.columns if c.name in (*spec.source_keys, spec.system.end)]


def detect_types(text: DataFrame, names: Sequence[str]) -> dict[str, T.DataType]:
    """The narrowest type that all non-empty cells of a column fit, found with one aggregate."""
    candidates = [
        (T.BooleanType(), lambda c: F.lower(c).isin("true", "false")),
        (T.LongType(), lambda c: c.rlike(r"^[+-]?\d+$") & c.try_cast("bigint").isNotNull()),
        (T.DoubleType(), lambda c: c.try_cast("double").isNotNull()),
        (T.DateType(), lambda c: c.rlike(r"^\d{4}-\d{2}-\d{2}$") & c.try_cast("date").isNotNull()),
        (T.TimestampNTZType(), lambda c: ~c.rlike(r"(Z|[+-]\d\d(:?\d\d)?)$") & c.try_cast("timestamp_ntz").isNotNull()),
        (T.TimestampType(), lambda c: c.try_cast("timestamp").isNotNull()),
    ]
    checks = []
    for i, name in enumerate(names):
        filled = F.nullif(F.col(name), F.lit(""))
        checks.append(F.count(filled).alias(f"n_{i}"))
        checks += [F.bool_and(F.when(filled.isNotNull(), fits(filled))).alias(f"t_{i}_{j}") for j, (_, fits) in enumerate(candidates)]
    found = text.agg(*checks).first()
    types: dict[str, T.DataType] = {}
    for i, name in enumerate(names):
        fitting = [dtype for j, (dtype, _) in enumerate(candidates) if found[f"n_{i}"] and found[f"t_{i}_{j}"]]
        types[name] = fitting[0] if fitting else T.StringType()
    return types


def _raw(spark: SparkSession, files: list[ChangeFile], names: list[str], options: ReadOptions) -> DataFrame:
    """Text cells of all files. Files with the same header share one scan."""
    parts = [_raw_group(spark, *group, names, options) for group in _groups(files, names, options)]
    return reduce(DataFrame.unionByName, parts)


def _groups(
    files: list[ChangeFile], names: list[str], options: ReadOptions
) -> list[tuple[str, tuple[str, ...], list[ChangeFile]]]:
    """Files by the way they are read (whole, split, sealed) and their header."""
    groups: dict[tuple, list[ChangeFile]] = {}
    for f in files:
        large = f.direct and not f.compressed and f.size > options.split_bytes
        groups.setdefault(("split" if large else "whole" if f.direct else "sealed", f.header), []).append(f)
    for (_, header), members in groups.items():
        missing = [n for n in names if n not in header]
        if missing:
            raise ChangeError(f"Columns {missing} not found in file <{members[0].path}>")
    return [(*key, members) for key, members in groups.items()]


def _raw_group(
    spark: SparkSession, kind: str, header: Sequence[str], members: list[ChangeFile], names: list[str], options: ReadOptions
) -> DataFrame:
    if kind == "sealed":
        return read_sealed(spark, members, header, names, _CSV, options).select(*names, SEQ)
    read = read_split if kind == "split" else _read_whole
    return read(spark, members, header, names, _CSV, options.record_bytes).select(*names, SEQ)


def _read_permissive(spark: SparkSession, members: list[ChangeFile], header: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Text cells, the text of a record with a wrong number of them, and the row's number in its task."""
    refuse_damaged(spark, members)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*header, "__record")])
    permissive = _CSV | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__record"}
    df = spark.read.schema(schema).options(**permissive).csv([f.pattern for f in members])
    return with_position(df.withColumn("__at", F.monotonically_increasing_id()), members, F.col("_metadata.file_path"))


def _read_whole(
    spark: SparkSession,
    members: list[ChangeFile],
    header: Sequence[str],
    names: Sequence[str],
    parser: dict[str, str],
    limit: int,
) -> DataFrame:
    refuse_damaged(spark, members)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in header])
    df = spark.read.schema(schema).options(**parser).csv([f.pattern for f in members])
    return with_position(df, members, F.col("_metadata.file_path")).filter(within(cell_bytes(header), limit))


def _null_or_text(cell: Expr, null_value: str) -> Expr:
    """With a NULL token, the token is NULL and an empty cell is empty text; without one, empty is NULL."""
    if null_value:
        return F.nullif(F.coalesce(cell, F.lit("")), F.lit(null_value))
    return F.nullif(cell, F.lit(""))


def _common_header(files: list[ChangeFile]) -> list[str]:
    """All names that some file has, in the order they come up; a file that lacks one of them is refused when it is read."""
    return list(dict.fromkeys(name for f in files for name in f.header))
