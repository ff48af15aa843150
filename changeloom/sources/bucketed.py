"""Keyed tables in buckets of their key, as catalog tables.

Spark knows from the catalog in which bucket a key lies. A batch that is too large to be broadcast is then sent to the
buckets, while the target is joined where it lies and the result is written bucket by bucket: of all rows of a table of
100 TB, none is shuffled.

    books = open_bucketed(spark, "books_1")
    save_bucketed(apply_changes(books, replace=changes, small=False), "books_2", books.buckets, dealt=True)
    spark.sql("CREATE OR REPLACE VIEW books AS SELECT * FROM books_2")
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..errors import ChangeError
from ..model import KeyedTable, SystemColumns, TableSpec


def save_bucketed(table: KeyedTable, name: str, buckets: int, *, path: str | None = None, dealt: bool = False) -> None:
    """Write a keyed table as the new catalog table ``name``; one that exists is refused.

    Keys and defaults are kept in the columns' metadata. ``dealt`` states that the rows already come bucket by bucket, as
    they do from a batch applied to a table with as many buckets. Otherwise they are sent to their buckets, as writing
    from any task to any bucket would make a file for each pair of them.
    """
    keys = table.require_keys()
    if buckets < 1:
        raise ChangeError("A table needs at least one bucket")
    described = {f.name: f.metadata for f in table.spec.schema().fields}
    rows = table.df.select(*[F.col(c).alias(c, metadata=described[c]) for c in table.spec.names])
    writer = (rows if dealt else rows.repartition(buckets, *keys)).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer if path is None else writer.option("path", path)).saveAsTable(name)


def open_bucketed(spark: SparkSession, name: str, system: SystemColumns | None = None) -> KeyedTable:
    """The table with its specification. It must lie in buckets of its whole key."""
    df = spark.table(name)
    spec = TableSpec.from_schema(df.schema, system)
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    columns = facts.get("Bucket Columns", "[]").strip("[]").replace("`", "")
    if not spec.keys or [c.strip() for c in columns.split(",")] != spec.keys:
        raise ChangeError(f"Table {name} does not lie in buckets of its key {spec.keys}")
    return KeyedTable(df, spec, buckets=int(facts["Num Buckets"]))



def copy_bucketed(
    table: KeyedTable, name: str, buckets: int, *, path: str | None = None, keys: Sequence[str] = ()
) -> KeyedTable:
    """A copy of the rows, with defaults and key, as the new catalog table ``name``; ``keys`` join the key of the copy.

    A table without key cannot be copied. A history table keeps its version start in the key, as its source key alone
    does not tell versions apart.
    """
    spec = table.spec.with_keys([*table.require_keys(), *keys])
    unknown = [k for k in keys if k not in table.spec]
    if unknown:
        raise ChangeError(f"Key columns not found: {unknown}")
    save_bucketed(KeyedTable(table.df, spec), name, buckets, path=path)
    return open_bucketed(table.df.sparkSession, name, table.spec.system)
