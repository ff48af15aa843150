"""Keyed tables that lie in ranges of their key, so that a batch reads and shuffles only the ranges it touches.

Files follow each other in the order of the key and are sorted inside, so the statistics of a row group tell which keys
it may hold; Bloom filters on the key columns say no for single keys in between.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..errors import ChangeError
from ..model import KeyedTable, SystemColumns, TableSpec
from ..session import shuffle_partitions


def save_clustered(table: KeyedTable, path: str, *, files: int | None = None, row_group_bytes: int | None = None) -> None:
    """Write a keyed table as parquet below ``path``, which must not exist. Keys and defaults are kept with the columns.

    ``row_group_bytes`` is the size of what is read or left out as a whole (default: parquet's 128 MiB).
    """
    keys = table.require_keys()
    described = {f.name: f.metadata for f in table.spec.schema().fields}
    rows = table.df.select(*[F.col(c).alias(c, metadata=described[c]) for c in table.spec.names])
    dealt = rows.repartitionByRange(files or shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    writer = dealt.write.options(**{f"parquet.bloom.filter.enabled#{k}": "true" for k in keys})
    (writer if row_group_bytes is None else writer.option("parquet.block.size", str(row_group_bytes))).parquet(path)


def open_clustered(spark: SparkSession, path: str, system: SystemColumns | None = None) -> KeyedTable:
    df = spark.read.parquet(path)
    spec = TableSpec.from_schema(df.schema, system)
    if not spec.keys:
        raise ChangeError(f"The table at {path} was not written with a key")
    return KeyedTable(df, spec, clustered=True)
