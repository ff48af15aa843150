"""Files that no reader should guess about: bytes that are no UTF-8, and quoted cells that are never closed.

Spark's CSV reader turns the first into U+FFFD and takes the rest of the file for the cell of the second. So plain files
are looked at as lines before: one scan in which only lines that hold a quote or a bad byte go on, and of these a row
for each file and scan split is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from ..errors import ChangeError
from .files import ChangeFile
from .records import quoting

NOT_UTF8, NOT_CLOSED = "holds bytes that are not UTF-8", "Malformed change file: a quoted cell is not closed"


def refuse_damaged(spark: SparkSession, members: Sequence[ChangeFile]) -> None:
    """Raise if one of the files is damaged. A quote opens and closes cells by the rule of :mod:`changeloom.sources.records`."""
    lines = spark.read.option("lineSep", "\n").text([f.pattern for f in members]).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        (~F.is_valid_utf8("value")).alias("bad"),
        *quoting(F.col("value")),
    )
    telling = lines.filter(F.col("bad") | F.col("resets") | (F.col("flips") > 0))
    so_far = F.sum("flips").over(Window.partitionBy("path", "block").orderBy("line"))
    last = F.max(F.when(F.col("resets"), F.col("before")))
    blocks = telling.withColumn("before", so_far - F.col("flips")).groupBy("path", "block").agg(
        F.bool_or("bad").alias("bad"), last.isNotNull().alias("resets"), (F.sum("flips") - F.coalesce(last, F.lit(0))).alias("flips")
    )
    files = blocks.groupBy("path").agg(
        F.bool_or("bad").alias("bad"), F.array_sort(F.collect_list(F.struct("block", "resets", "flips"))).alias("blocks")
    )
    state = F.aggregate("blocks", F.lit(0).cast("long"), lambda s, b: (F.when(b["resets"], F.lit(0)).otherwise(s) + b["flips"]) % 2)
    found = files.select("path", "bad", (state == 1).alias("open")).filter("bad OR open").first()
    if found is not None:
        problem = f"File <{found['path']}> {NOT_UTF8}" if found["bad"] else f"{NOT_CLOSED}: <{found['path']}>"
        raise ChangeError(problem)
