"""Sharding by proportional stratified interleaving: every shard holds the sources in the proportions of the whole.

Rows of a source are put into a seeded order and ranked; the rank, moved by a phase of the source's own and divided by
the source's rows, is a row's place between 0 and 1. In the order of these places each stretch holds all sources in
proportion, so cutting it into stretches of equally many rows gives shards that match the mixture. The phase keeps sources of a few rows from meeting in one place.

Neither ranking nor cutting brings a source into one task. Rows are hashed into buckets of (source, leading bits of the
seeded order), whose sizes are added up to where each bucket's ranks begin; inside a bucket rows are numbered. The same
is done once more with cells of the places between 0 and 1. Everything is built-in functions, joins and windows.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.llm.common import fresh, staged
from changeloom.session import shuffle_partitions

SHARDS = 40
SEED = 2024
#: Rows that a bucket or a cell is meant to hold, and the most buckets of a source, or cells: so many sizes meet in one task.
BUCKET_ROWS = 100_000
MOST_BUCKETS = 1 << 16
#: Buckets for each shuffle partition at least, so that hashing them evens out.
SPREAD = 4
_ORDER_BITS = 60


def _digits(text: Column, hex_digits: int) -> Column:
    """The first hexadecimal digits of the text's MD5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("long")


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def seeded_order(key: Sequence[str], seed: int) -> Column:
    """A 60-bit number that depends on the key columns' texts and the seed alone."""
    parts = [x for k in key for x in (F.lit("|"), _text(F.col(f"`{k}`")))]
    return _digits(F.concat(F.lit(str(seed)), *parts), _ORDER_BITS // 4)


def phase_of(stratum: Column, seed: int) -> Column:
    """Between 0 and 1, from the source's name and the seed."""
    return _digits(F.concat(F.lit(f"{seed}|"), stratum), 13) / F.lit(float(1 << 52))


def bucket_count(spark: SparkSession, rows: int) -> int:
    return max(1, min(MOST_BUCKETS, max(SPREAD * shuffle_partitions(spark), ceil(rows / BUCKET_ROWS))))


def interleave(
    docs: DataFrame,
    shards: int = SHARDS,
    *,
    by: str = "source",
    key: Sequence[str] = ("doc_id", "text"),
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs`` with the columns ``shard`` and ``slot`` (place in the shard, from 0 without gaps).

    Shards hold equally many rows, up to one. Each holds of every source what its share of all rows asks for; at
    either end of a shard this is off by less than one row, and that share of the number of sources. The order depends on the key columns, the source and the seed only, so reruns agree; rows that
    agree in all of these are interchangeable and take neighbouring places. They meet in one task, as one bucket, so the
    key should tell rows apart.

    A null source is a source of its own. Null keys count as empty texts. An empty table gives no rows, a table with
    fewer rows than shards leaves shards empty. Texts are not looked into unless they are part of the key. If ``docs``
    has columns named shard or slot, the new ones get an underscore more. ``docs`` must give the same rows when it is read
    again, as files do.
    """
    spark = docs.sparkSession
    shard, slot = fresh(docs, "shard"), fresh(docs, "slot")
    stratum, order, bucket = (fresh(docs, f"_{n}") for n in ("stratum", "order", "bucket"))
    n, before, of_all, place, cell = (fresh(docs, f"_{x}") for x in ("n", "before", "of_all", "place", "cell"))
    buckets = bucket_count(spark, docs.count())

    # Names get a letter in front, so that none is taken for the null source.
    name = F.col(f"`{by}`")
    marked = docs.withColumn(stratum, F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), name.cast("string"))))
    marked = marked.withColumn(order, seeded_order(key, seed))
    marked = marked.withColumn(bucket, F.shiftright(F.shiftright(F.col(order), _ORDER_BITS - 32) * buckets, 32))
    group = [stratum, bucket]
    so_far = Window.partitionBy(stratum).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    begins = marked.groupBy(*group).agg(F.count(F.lit(1)).alias(n)).select(
        *group,
        F.coalesce(F.sum(n).over(so_far), F.lit(0)).alias(before),
        F.sum(n).over(Window.partitionBy(stratum)).alias(of_all),
    )
    ties = [F.col(f"`{k}`") for k in key]
    in_bucket = Window.partitionBy(*group).orderBy(order, *ties)
    ranked = marked.join(begins, group).withColumn(before, F.col(before) + F.row_number().over(in_bucket) - 1)
    ranked = ranked.withColumn(place, (F.col(before) + phase_of(F.col(stratum), seed)) / F.col(of_all))
    ranked = ranked.withColumn(cell, F.least(F.floor(F.col(place) * buckets), F.lit(buckets - 1)))
    placed = staged(ranked.drop(bucket, before, of_all), "interleave-places")

    total = placed.count()
    up_to = Window.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    # At most MOST_BUCKETS rows.
    sizes = placed.groupBy(cell).agg(F.count(F.lit(1)).alias(n))
    begins = sizes.select(cell, F.coalesce(F.sum(n).over(up_to), F.lit(0)).alias(before))
    in_cell = Window.partitionBy(cell).orderBy(place, stratum, order, *ties)
    row = F.col(before) + F.row_number().over(in_cell) - 1
    at = placed.join(begins, cell).withColumn(place, row)
    # Shard s holds the rows from ceil(s * total / shards) on.
    cut = at.withColumn(shard, F.expr(f"cast((`{place}` * {shards}) div {max(1, total)} as int)"))
    cut = cut.withColumn(slot, F.expr(f"`{place}` - (cast(`{shard}` as long) * {total} + {shards - 1}) div {shards}"))
    return cut.select(*[f"`{c}`" for c in docs.columns], shard, slot)


def write_shards(sharded: DataFrame, path: str, *, files: int | None = None) -> None:
    """Writes what :func:`interleave` returned below ``path``, as ``shard=n`` folders whose files follow each other in the
    order of slots. Rows are dealt out by ranges of (shard, slot), so no task holds more than its share."""
    dealt = sharded.repartitionByRange(files or shuffle_partitions(sharded.sparkSession), "shard", "slot")
    dealt.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and source of documents, the size of a row (bytes of its text, and 16) and the CRC-32 of its text; a null text is none."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.select("doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))


def report(docs: DataFrame) -> DataFrame:
    """Documents with size, checksum, shard and slot. Texts are read once; only these numbers are shuffled."""
    slim = staged(measured(docs), "interleave-sizes")
    sharded = interleave(slim, key=("doc_id", "text_crc32", "size"))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


#: Places are sums, products and quotients of 64-bit numbers, so both engines find the same.
SQL = f"""
    WITH step AS (
        SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
    ), texts AS (
        SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS h FROM documents
    ), measured AS (
        SELECT doc_id, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS stratum, length(h) // 2 + 16 AS size,
               xor(list_reduce(list_transform(range(0, length(h), 2), lambda i: CAST('0x' || substr(h, i + 1, 2) AS BIGINT)),
                               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS crc
        FROM texts, step
    ), ordered AS (
        SELECT *, CAST('0x' || substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || crc || '|' || size), 1, 15) AS BIGINT) AS o,
               CAST(CAST('0x' || substr(md5('{SEED}|' || stratum), 1, 13) AS BIGINT) AS DOUBLE) / CAST(4503599627370496 AS DOUBLE) AS phase
        FROM measured
    ), placed AS (
        SELECT *, (CAST(row_number() OVER (PARTITION BY stratum ORDER BY o, doc_id NULLS FIRST, crc, size) - 1 AS DOUBLE) + phase)
                  / CAST(count(*) OVER (PARTITION BY stratum) AS DOUBLE) AS place
        FROM ordered
    ), numbered AS (
        SELECT *, row_number() OVER (ORDER BY place, stratum, o, doc_id NULLS FIRST, crc, size) - 1 AS pos, count(*) OVER () AS total
        FROM placed
    ), cut AS (SELECT *, (pos * {SHARDS}) // total AS shard FROM numbered)
    SELECT doc_id, size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
           pos - (shard * total + {SHARDS - 1}) // {SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM cut
"""
