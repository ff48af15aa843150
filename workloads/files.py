"""Change files and published tables: data goes through CSV files in the scratch folder and back."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom import BatchFiles, Column, KeyedTable, ReadOptions
from changeloom.functions.types import spark_type
from changeloom.plans.batches import load as load_table
from changeloom.plans.batches import truncate, write_batch, write_history_batch
from changeloom.plans.migrations import migrate
from changeloom.session import scratch_path, set_for
from changeloom.sources.change_files import read_changes, read_checked
from changeloom.sources.sealed import write_sealed
from changeloom.sources.tables import VersionedTable
from changeloom.streaming.requests import follow

from .common import MARK, ORDERS, SYS, TOKEN, Query, keyed, load, parts, write_csv
from .history import SQL as HISTORY_SQL
from .history import deletions, earliest, loaded_table, new_versions, updates
from .merge import SQL as MERGE_SQL
from .merge import order_batch

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

OPTIONS = ReadOptions(null_value=TOKEN, unmodified=MARK)


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return register


def _columns(df: DataFrame) -> list[Column]:
    return [Column(f.name, f.dataType) for f in df.schema.fields]


@query("SELECT * FROM documents")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, quotes and commas."""
    documents = load(spark, sf_dir, "documents")
    return read_changes(spark, write_csv(documents, "documents"), _columns(documents), OPTIONS).select(
        *documents.columns
    )


@query("SELECT * FROM documents")
def csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, by the way taken for files too large for one task."""
    documents = load(spark, sf_dir, "documents")
    options = ReadOptions(null_value=TOKEN, split_bytes=0)
    return read_changes(spark, write_csv(documents, "documents"), _columns(documents), options).select(
        *documents.columns
    )


# Bytes of lines that become one zstd frame of the files below.
_FRAME_BYTES = 4 << 20
# An empty zstd frame that readers skip: what stands between the frames of a file below.
_EMPTY_FRAME = "P*M\x18\0\0\0\0"


@query("SELECT doc_id, text, source FROM documents")
def csv_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are compressed without saying so in their name, made by the executors."""
    documents = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    quoted = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in ("text", "source")]
    cells = [F.coalesce(c, F.lit(TOKEN)) for c in (F.col("doc_id").cast("string"), *quoted)]

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def frame(lines: list[str]) -> pa.RecordBatch:
            packed = pa.compress("".join(f"{x}\n" for x in lines).encode(), codec="zstd", asbytes=True)
            return pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["value"])

        yield frame(["doc_id,text,source"])
        for batch in batches:
            if batch.num_rows:
                yield frame(batch.column(0).to_pylist())

    lines = documents.select(F.concat_ws(",", *cells).alias("line")).repartition(spark.sparkContext.defaultParallelism)
    path = scratch_path(spark, "frames")
    packed = lines.mapInArrow(frames, "value binary").select(F.col("value").cast("string"))
    with set_for(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(_FRAME_BYTES)):
        packed.write.option("lineSep", _EMPTY_FRAME).text(path)
    return read_changes(spark, parts(spark, path), _columns(documents), OPTIONS).select(*documents.columns)


@query("SELECT * FROM documents")
def csv_sealed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encrypted files, made by the executors; each has its own key on the list, here the same."""
    documents = load(spark, sf_dir, "documents")
    key = bytes(range(32))
    paths = write_sealed(documents, scratch_path(spark, "sealed"), key, spark.sparkContext.defaultParallelism, TOKEN)
    options = ReadOptions(null_value=TOKEN, encrypted=True, keys={p: key for p in paths})
    return read_changes(spark, paths, _columns(documents), options).select(*documents.columns)


@query("SELECT doc_id, text || ' 5\" x' AS text, source FROM documents WHERE text IS NOT NULL")
def csv_split_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split reading of cells that hold quotes but are not quoted, as far as a text may go unquoted."""
    documents = load(spark, sf_dir, "documents").filter("text IS NOT NULL")
    text = F.concat("text", F.lit(' 5" x'))
    plain = ~text.rlike('^"|[,\\n\\r]')
    cell = F.when(plain, text).otherwise(F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')))
    count = spark.sparkContext.defaultParallelism
    record = F.concat_ws(",", F.col("doc_id").cast("string"), cell, F.coalesce("source", F.lit("")))
    records = documents.select(record.alias("value"), F.pmod("doc_id", F.lit(count)).alias("file"), F.lit(1).alias("rank"))
    headers = spark.range(count).select(F.lit("doc_id,text,source").alias("value"), F.col("id").alias("file"), F.lit(0).alias("rank"))
    lines = headers.unionByName(records).repartition("file").sortWithinPartitions("file", "rank")
    path = scratch_path(spark, "quotes")
    lines.select("value", "file").write.partitionBy("file").text(path)
    paths = [part for i in range(count) for part in parts(spark, f"{path}/file={i}")]
    wanted = [Column("doc_id", T.LongType()), Column("text", T.StringType()), Column("source", T.StringType())]
    return read_changes(spark, paths, wanted, ReadOptions(split_bytes=0)).select("doc_id", "text", "source")


def _damaged_events(spark: SparkSession, sf_dir: str) -> tuple[list[str], list[Column]]:
    """Events as text in four files by number, some cells of which are not of their type and some records too short."""
    number = F.col("event_id")
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    cells = [
        number.cast("string"),
        F.when(number % 17 == 0, "2024-13-01").otherwise(F.col("ts").cast("string")),
        F.when(number % 11 == 0, F.concat(F.lit("x"), number.cast("string"))).otherwise(F.col("user_id").cast("string")),
        F.when(number % 13 == 0, "1.2.3").otherwise(F.col("value").cast("string")),
    ]
    line = F.when(number % 23 == 0, F.concat_ws(",", *cells[:3])).otherwise(F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cells]))
    records = events.select(line.alias("value"), (number % 4).alias("file"), number.alias("place"))
    headers = spark.range(4).select(F.lit(",".join(events.columns)).alias("value"), F.col("id").alias("file"), F.lit(-1).cast("long").alias("place"))
    lines = headers.unionByName(records).repartition("file").sortWithinPartitions("file", "place")
    path = scratch_path(spark, "damaged")
    lines.select("value", "file").write.partitionBy("file").text(path)
    return [part for k in range(4) for part in parts(spark, f"{path}/file={k}")], _columns(events)


_RECORDS = """
    SELECT *, CAST(event_id % 4 AS INTEGER) AS file, row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) AS record FROM events"""


@query(f"""
    SELECT file, record, 'ts' AS "column", 'not NAIVE_DATETIME' AS reason, '2024-13-01' AS cell FROM ({_RECORDS})
    WHERE event_id % 17 = 0 AND event_id % 23 <> 0
    UNION ALL
    SELECT file, record, 'user_id', 'not LONG', 'x' || event_id FROM ({_RECORDS}) WHERE event_id % 11 = 0 AND event_id % 23 <> 0
    UNION ALL
    SELECT file, record, 'value', 'not DOUBLE', '1.2.3' FROM ({_RECORDS}) WHERE event_id % 13 = 0 AND event_id % 23 <> 0
    UNION ALL
    SELECT file, record, NULL, 'wrong number of cells', NULL FROM ({_RECORDS}) WHERE event_id % 23 = 0""")
def csv_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong in damaged files: file, record, column, reason and cell."""
    _, rejected = read_checked(spark, *_damaged_events(spark, sf_dir))
    short = F.col("column").isNull()
    return rejected.withColumn("cell", F.when(~short, F.col("cell")))


@query("""
    SELECT event_id, ts, user_id, value FROM events
    WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0 AND event_id % 23 <> 0""")
def csv_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the same files that nothing is wrong with."""
    paths, columns = _damaged_events(spark, sf_dir)
    return read_checked(spark, paths, columns)[0].select(*[c.name for c in columns])


@query("SELECT * FROM pages")
def csv_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    return read_changes(spark, write_csv(pages, "pages"), _columns(pages)).select(*pages.columns)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def csv_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with different column orders and columns nobody asked for."""
    customer = load(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey", "c_name", "c_custkey")
    supplier = load(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("c_name"),
        F.col("s_suppkey").alias("c_custkey"),
        F.lit(None).cast("string").alias("c_mktsegment"),
    )
    paths = write_csv(customer, "customer") + write_csv(supplier, "supplier")
    wanted = [Column("c_custkey", T.LongType()), Column("c_name", T.StringType()), Column("c_mktsegment", T.StringType())]
    return read_changes(spark, paths, wanted, OPTIONS).select("c_custkey", "c_name", "c_mktsegment")


@query("SELECT event_id, ts FROM events")
def csv_mixed_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column with moments in several forms: with a blank or a T, without zone, in UTC, and at an offset."""
    events = load(spark, sf_dir, "events")
    form = F.col("event_id") % 4
    blank, dense = "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    east = F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL '2' HOUR"), dense), F.lit("+02:00"))
    text = (
        F.when(form == 0, F.date_format("ts", blank))
        .when(form == 1, F.date_format("ts", dense))
        .when(form == 2, F.concat(F.date_format("ts", dense), F.lit("Z")))
        .otherwise(east)
    )
    wanted = [Column("event_id", T.LongType()), Column("ts", T.TimestampType())]
    read = read_changes(spark, write_csv(events.select("event_id", text.alias("ts")), "moments"), wanted, OPTIONS)
    return read.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("""
    SELECT doc_id, CASE WHEN doc_id = (SELECT MIN(doc_id) FROM documents) THEN 26214400 ELSE length(text) END AS letters
    FROM documents""")
def csv_record_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record of 25 MiB, which a limit of 28 MiB lets pass."""
    documents = load(spark, sf_dir, "documents").select("doc_id", "text")
    first = documents.agg(F.min("doc_id").alias("first_id"))
    long = documents.join(F.broadcast(first)).withColumn(
        "text", F.when(F.col("doc_id") == F.col("first_id"), F.rpad(F.coalesce("text", F.lit("")), 25 << 20, ".")).otherwise(F.col("text"))
    )
    wanted = [Column("doc_id", T.LongType()), Column("text", T.StringType())]
    options = ReadOptions(null_value=TOKEN, max_record_mib=28)
    read = read_changes(spark, write_csv(long.drop("first_id"), "long"), wanted, options)
    return read.select("doc_id", F.length("text").cast("long").alias("letters"))


_NULLS = """
    SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN {0} ELSE event_type END AS event_type,
           CASE WHEN event_type <> 'error' THEN user_id END AS user_id, ts FROM events"""


def _with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return load(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "click", "").when(kind != "view", kind).alias("event_type"),
        F.when(kind != "error", F.col("user_id")).alias("user_id"),
        "ts",
    )


@query(_NULLS.format("''"))
def csv_null_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a NULL token, empty text stays empty text."""
    events = _with_nulls(spark, sf_dir)
    return read_changes(spark, write_csv(events, "nulls"), _columns(events), OPTIONS).select(*events.columns)


@query(_NULLS.format("NULL"))
def csv_no_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without one, every empty cell is NULL."""
    events = _with_nulls(spark, sf_dir)
    return read_changes(spark, write_csv(events, "empties", null=""), _columns(events)).select(*events.columns)


@query("SELECT conv_id, turn, text FROM conversations")
def csv_base64(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = load(spark, sf_dir, "conversations")
    coded = conversations.select("conv_id", "turn", F.base64(F.encode("text", "utf-8")).alias("body"))
    wanted = [Column("conv_id", T.LongType()), Column("turn", T.LongType()), Column("body", T.BinaryType())]
    decoded = read_changes(spark, write_csv(coded, "binary"), wanted, OPTIONS)
    return decoded.select("conv_id", "turn", F.decode("body", "utf-8").alias("text"))


@query("""
    SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber, CAST(l_quantity AS FLOAT) AS l_quantity,
           CAST(l_extendedprice AS DECIMAL(14,1)) AS l_extendedprice, CAST(l_discount AS DECIMAL(4,2)) AS l_discount,
           l_tax, l_returnflag = 'R' AS returned, CAST(l_shipdate AS DATE) AS l_shipdate FROM (
        SELECT * REPLACE (CAST(l_extendedprice AS DECIMAL(14,2)) AS l_extendedprice) FROM lineitem)""")
def csv_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_returnflag") == "R").alias("returned"), F.to_date("l_shipdate").alias("l_shipdate"),
    )
    wanted = [
        Column("l_orderkey", spark_type("LONG")),
        Column("l_linenumber", spark_type("SHORT")),
        Column("l_quantity", spark_type("FLOAT")),
        Column("l_extendedprice", spark_type("DECIMAL", 14, 1)),
        Column("l_discount", spark_type("DECIMAL", 4, 2)),
        Column("l_tax", spark_type("DOUBLE")),
        Column("returned", spark_type("BOOLEAN")),
        Column("l_shipdate", spark_type("NAIVE_DATE")),
    ]
    return read_changes(spark, write_csv(lineitem, "types"), wanted, OPTIONS).select(*[c.name for c in wanted])


@query("SELECT event_id, user_id, value, ts, event_type, event_type = 'error' AS failed FROM events")
def csv_detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No types given: they are found in the data."""
    events = load(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", "ts", "event_type", (F.col("event_type") == "error").alias("failed")
    )
    return read_changes(spark, write_csv(events, "detected"), (), OPTIONS).select(*events.columns)


def _table_of(spark: SparkSession, state: KeyedTable, buckets: int) -> VersionedTable:
    table = VersionedTable.create(spark, scratch_path(spark, "table"), state.spec, buckets=buckets)
    load_table(table, state.df)
    return table


def order_files(spark: SparkSession, sf_dir: str) -> tuple[KeyedTable, BatchFiles]:
    target, (recent, urgent), update, gone = order_batch(spark, sf_dir)
    untouched = [F.lit(MARK).alias(c) for c in ORDERS if c not in update.columns]
    return target, BatchFiles(
        replace=(*write_csv(recent, "recent"), *write_csv(urgent, "urgent")),
        update=tuple(write_csv(update.select("*", *untouched), "update")),
        delete=tuple(write_csv(gone, "gone")),
    )


@query(MERGE_SQL["apply_batch"])
def table_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of files applied to a published table."""
    target, files = order_files(spark, sf_dir)
    table = _table_of(spark, target, buckets=1)
    write_batch(table, files, OPTIONS)
    return table.read().df


@query(MERGE_SQL["apply_batch"])
def table_batch_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a bucketed table, of which only the touched buckets are rewritten."""
    target, files = order_files(spark, sf_dir)
    table = _table_of(spark, target, buckets=16)
    write_batch(table, files, OPTIONS)
    return table.read().df


@query(HISTORY_SQL["hist_batch"])
def table_history_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table_of(spark, loaded_table(spark, sf_dir), buckets=8)
    files = BatchFiles(
        earliest=tuple(write_csv(earliest(spark, sf_dir), "earliest")),
        update=tuple(write_csv(updates(spark, sf_dir), "update")),
        replace=tuple(write_csv(new_versions(spark, sf_dir), "replace")),
        delete=tuple(write_csv(deletions(spark, sf_dir), "delete")),
    )
    write_history_batch(table, files, OPTIONS)
    return table.read().df


@query("""
    SELECT *, TIMESTAMP '2024-06-01 12:00:00' AS valid_from, TIMESTAMP '9999-12-31 23:59:59.999' AS valid_to,
           TRUE AS is_current FROM customer""")
def table_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published live table copied into a published history table."""
    table = _table_of(spark, keyed(load(spark, sf_dir, "customer"), "c_custkey"), buckets=4)
    copy = VersionedTable(spark, scratch_path(spark, "copy"), SYS)
    migrate(table, "copy_table_to_history_mode", into=copy, now="2024-06-01 12:00:00")
    return copy.read().df


@query("SELECT * FROM orders")
def copy_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published table copied into another one."""
    table = _table_of(spark, keyed(load(spark, sf_dir, "orders"), "o_orderkey"), buckets=4)
    copy = VersionedTable(spark, scratch_path(spark, "copy"), SYS)
    migrate(table, "copy_table", into=copy)
    return copy.read().df


@query("SELECT * FROM events WHERE ts IS NULL OR ts >= TIMESTAMP '2024-01-10'")
def table_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded before a moment leave a published table; only buckets that hold some are written anew."""
    table = _table_of(spark, keyed(load(spark, sf_dir, "events"), "event_id"), buckets=8)
    truncate(table, "ts", 1_704_844_800 * 10**9)  # 2024-01-10
    return table.read().df


@query("SELECT c_custkey, c_name AS full_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def table_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table_of(spark, keyed(load(spark, sf_dir, "customer"), "c_custkey"), buckets=4)
    migrate(table, "rename_column", from_column="c_name", to_column="full_name")
    return table.read().df


@query("""
    SELECT * EXCLUDE (n) REPLACE (CASE n WHEN 1 THEN 'first' ELSE 'second' END AS o_orderstatus) FROM (
        SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS n FROM orders)""")
def stream_of_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that Structured Streaming picks up and applies in order."""
    orders = load(spark, sf_dir, "orders").select(*ORDERS)
    table = VersionedTable.create(spark, scratch_path(spark, "table"), keyed(orders, "o_orderkey").spec, buckets=4)
    first = write_csv(orders.withColumn("o_orderstatus", F.lit("first")), "first")
    urgent = orders.filter("o_orderpriority = '1-URGENT'")
    second = write_csv(urgent.withColumn("o_orderstatus", F.lit("second")), "second")
    requests = scratch_path(spark, "requests")
    lines = [(json.dumps({"sequence": i, "replace": paths}),) for i, paths in enumerate((first, second))]
    spark.createDataFrame(lines, "value string").write.text(requests)
    follow(
        spark, requests, table, scratch_path(spark, "checkpoint"), options=OPTIONS, available_now=True
    ).awaitTermination()
    return table.read().df
