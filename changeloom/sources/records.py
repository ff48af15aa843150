"""Parallel reading of one large CSV file whose quoted cells may hold line breaks.

Spark reads such a file with a single task, because a task that starts in the middle cannot tell whether
it is inside a quoted cell. Here the file is read as lines, which splits, and every line tells what it does to
that state, whatever it was before. Doubled quotes change nothing. Of the others, one at the start of a cell
opens or closes a quoted cell, so it flips the state; one elsewhere closes a quoted cell or is an ordinary
character outside of one, so the state after it is "outside" in any case. The state before a line is thus the
last such reset plus the flips since, added up in two steps: per block of the file, then per line inside its
block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..operators.merge import SEQ
from .files import ChangeFile, cell_bytes, with_position, within

_BLOCK, _LINE, _RECORD = "__block", "__line", "__record"


def read_split(
    spark: SparkSession,
    members: Sequence[ChangeFile],
    header: Sequence[str],
    names: Sequence[str],
    parser: dict[str, str],
    limit: int,
) -> DataFrame:
    """Text cells ``names`` of files that share a header, and the file position."""
    return parse_lines(_lines(spark, members), header, names, parser, limit)


def parse_lines(lines: DataFrame, header: Sequence[str], names: Sequence[str], parser: dict[str, str], limit: int) -> DataFrame:
    """The same from lines that :func:`told` has made."""
    line_parser = {k: v for k, v in parser.items() if k not in ("header", "multiLine", "columnPruning", "encoding")}
    # Quoting at most doubles a cell and adds three characters, so a longer record is beyond the limit by its cells.
    records = assemble(lines, 2 * limit + 3 * len(header), limit).filter(
        ~F.col("is_header") & (F.col("record") != "")
    )
    parsed = records.select(F.from_csv("record", _ddl(header), line_parser).alias("cells"), SEQ)
    sized = parsed.filter(within(cell_bytes([F.col("cells")[n] for n in header]), limit))
    return sized.select(*[F.col("cells")[n].alias(n) for n in names], SEQ)


def _ddl(header: Sequence[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` STRING" for n in header)


def _lines(spark: SparkSession, members: Sequence[ChangeFile]) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text([f.pattern for f in members])
    path = F.col("_metadata.file_path")
    numbered = lines.select(
        path.alias("path"),
        F.col("_metadata.file_block_start").alias(_BLOCK),
        F.monotonically_increasing_id().alias(_LINE),
        *told(F.col("value"), path),
    )
    return with_position(numbered, members, F.col("path")).drop("path")


def told(value: Expr, path: Expr) -> tuple[Expr, ...]:
    """A line and what it does to quoting; one that is not UTF-8 fails the job, which names the file."""
    bad = F.raise_error(F.concat(F.lit("File <"), path, F.lit("> holds bytes that are not UTF-8"))).cast("string")
    return F.when(F.is_valid_utf8(value), value).otherwise(bad).alias("value"), *quoting(value)


def quoting(line: Expr) -> tuple[Expr, Expr]:
    """What a line does to the quoting state: ``resets`` to outside at some point, and number of ``flips`` after that."""
    single = F.replace(line, F.lit('""'), F.lit(""))
    rest = F.regexp_replace(single, r'(?s)^.*[^,]"', "")
    flips = F.length(rest) - F.length(F.replace(rest, F.lit('"'), F.lit("")))
    return single.rlike(r'[^,]"').alias("resets"), flips.alias("flips")


def _state_before(window: WindowSpec, open_at_start: Expr) -> Expr:
    """Whether a row starts inside a quoted cell, from ``resets`` and ``flips`` of the rows before it."""
    upto = F.coalesce(F.sum("flips").over(window), F.lit(0))
    # Flips before the last row that resets; those of that row itself came after its reset.
    settled = F.last(F.when(F.col("resets"), F.col("flips_before")), ignorenulls=True).over(window)
    return F.when(settled.isNotNull(), (upto - settled) % 2).otherwise((open_at_start + upto) % 2)


def assemble(lines: DataFrame, longest: int, limit: int) -> DataFrame:
    """Lines to records: ``record``, ``is_header`` and the file. More than ``longest`` bytes in one fail before they are joined.

    One shuffle brings the lines of a block together; blocks have the size of a scan split, so they are
    even. Only the first and the last record of a block can reach into another block, and only their lines
    are compared across blocks.
    """
    by_line = Window.partitionBy(SEQ, _BLOCK).orderBy(_LINE)
    upto, past = (w.rowsBetween(Window.unboundedPreceding, end) for w, end in ((by_line, 0), (by_line, -1)))
    lines = lines.withColumn("flips_before", F.sum("flips").over(upto) - F.col("flips"))
    last_reset = F.max(F.when(F.col("resets"), F.col("flips_before")))
    blocks = lines.groupBy(SEQ, _BLOCK).agg(
        last_reset.isNotNull().alias("resets"), (F.sum("flips") - F.coalesce(last_reset, F.lit(0))).alias("flips")
    )
    by_block = Window.partitionBy(SEQ).orderBy(_BLOCK)
    upto_block, past_blocks = (by_block.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    blocks = blocks.withColumn("flips_before", F.sum("flips").over(upto_block) - F.col("flips"))
    blocks = blocks.withColumn("open", _state_before(past_blocks, F.lit(0)))
    ends = F.when(F.col("resets"), F.col("flips") % 2).otherwise((F.col("open") + F.col("flips")) % 2)
    blocks = blocks.withColumn("ends", F.last(ends).over(by_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    # A quote that is never closed would make one record of the rest of the file: fail early.
    unclosed = F.raise_error(F.lit("Malformed change file: a quoted cell is not closed")).cast("bigint")
    blocks = blocks.select(SEQ, _BLOCK, F.when(F.col("ends") == 0, F.col("open")).otherwise(unclosed).alias("open"))

    bytes_upto = F.sum("bytes").over(upto)
    begun_at = F.last(F.when(F.col("starts") == 1, F.col("bytes_before")), ignorenulls=True).over(upto)
    numbered = (
        lines.join(blocks, [SEQ, _BLOCK])
        .withColumn("starts", (_state_before(past, F.col("open")) == 0).cast("int"))
        .withColumn("bytes", F.octet_length("value").cast("bigint") + 1)
        .withColumn("bytes_before", bytes_upto - F.col("bytes"))
        .withColumn("so_far", F.col("bytes_before") + F.col("bytes") - 1 - F.coalesce(begun_at, F.lit(0)))
        .filter(within(F.col("so_far"), longest, limit))
        .withColumn(_RECORD, F.sum("starts").over(upto))
        .withColumn("last", F.max(_RECORD).over(Window.partitionBy(SEQ, _BLOCK)))
        .select(SEQ, _BLOCK, _LINE, _RECORD, "value", "bytes", "last")
    )
    edge = (F.col(_RECORD) == 0) | (F.col(_RECORD) == F.col("last"))
    first = (F.col(_BLOCK) == 0) & (F.col(_RECORD) == 1)
    record, is_header = _joined(F.struct(_BLOCK, _LINE, "value")).alias("record"), F.max(first).alias("is_header")
    inner = numbered.filter(~edge).groupBy(SEQ, _BLOCK, _RECORD).agg(record, is_header)

    # The lines before the first record of a block belong to the last record begun in an earlier block.
    earlier = Window.partitionBy(SEQ).orderBy(_BLOCK).rangeBetween(Window.unboundedPreceding, -1)
    begun = F.max(F.when(F.col(_RECORD) > 0, F.col(_BLOCK))).over(earlier)
    owner = F.when(F.col(_RECORD) > 0, F.col(_BLOCK)).otherwise(begun)
    whole = F.sum("bytes").over(Window.partitionBy(SEQ, "owner")) - 1
    edges = numbered.filter(edge).withColumn("owner", owner).withColumn("whole", whole).filter(within(F.col("whole"), longest, limit))
    outer = edges.groupBy(SEQ, "owner").agg(record, is_header)
    return inner.select(SEQ, "record", "is_header").unionByName(outer.select(SEQ, "record", "is_header"))


def _joined(piece: Expr) -> Expr:
    return F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["value"]), "\n")
