"""Helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.session import scratch_path, ship_package


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the folder all executors share and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of rows that a Python worker gets at once, so that its memory does not depend on how long the texts are.
BATCH_BYTES = 8 << 20


def with_python(df: DataFrame) -> DataFrame:
    """The same rows, once this package can be imported in the Python workers and they get them in batches of bounded size."""
    spark = df.sparkSession
    ship_package(spark)
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(limit).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(limit, str(BATCH_BYTES))
    return df


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the rows do not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def raw(text: str = "text") -> Column:
    """The UTF-8 bytes of a text, empty where it is null. ASCII white space and A-Z are what ``bytes`` methods mean by them."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


def bounded_sample(df: DataFrame, id_col: str, rows: int, seed: int = 7) -> DataFrame:
    """About ``rows`` rows at most, chosen by a hash of the id, so that reruns choose the same; for fitting models only."""
    total = df.count()
    if total <= rows:
        return df
    share = int(rows / total * 1_000_000)
    return df.filter(F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1_000_000)) < share)
