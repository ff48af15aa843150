"""Loading, history tables made from events, and writing change files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom import KeyedTable, SystemColumns, configure
from changeloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

#: The driver tables hold timestamps without zone, so versions do as well.
SYS = SystemColumns(
    start="valid_from",
    end="valid_to",
    active="is_current",
    deleted="is_deleted",
    synced="synced_at",
    time_type=T.TimestampNTZType(),
)
MARK = "~unmodified~"
TOKEN = "~null~"

ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
VERSIONS = ["user_id", "valid_from", "valid_to", "is_current", "event_id", "event_type", "props"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(df: DataFrame, *keys: str, **kwargs) -> KeyedTable:
    return KeyedTable.of(df, keys, system=SYS, **kwargs)


def at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def versions_of(events: DataFrame) -> DataFrame:
    """Each event of a user is a version that lasts until the user's next one."""
    following = F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts"))
    return events.select(
        "user_id",
        F.col("ts").alias("valid_from"),
        F.coalesce(following - F.expr("INTERVAL '0.001' SECOND"), at("9999-12-31 23:59:59.999")).alias("valid_to"),
        following.isNull().alias("is_current"),
        "event_id",
        "event_type",
        "props",
    )


def versions_sql(where: str = "TRUE") -> str:
    return f"""
        SELECT user_id, ts AS valid_from,
               COALESCE(LEAD(ts) OVER w - INTERVAL '1 millisecond', TIMESTAMP '9999-12-31 23:59:59.999') AS valid_to,
               LEAD(ts) OVER w IS NULL AS is_current, event_id, event_type, props
        FROM events WHERE {where} WINDOW w AS (PARTITION BY user_id ORDER BY ts)"""


def staged(df: DataFrame, label: str) -> DataFrame:
    """Change data kept in the shared scratch folder, as it is when it comes from files."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, label: str, *, null: str = TOKEN) -> list[str]:
    """Change files in the shared scratch folder, one per task, and their paths."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    # As text: the CSV writer would cut timestamps to milliseconds. Several files, as a source would send.
    spread = df.repartition(spark.sparkContext.defaultParallelism)
    text = spread.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    text.write.options(header="true", quote='"', escape='"', lineSep="\n", nullValue=null, emptyValue="").csv(path)
    return parts(spark, path)


def parts(spark: SparkSession, path: str) -> list[str]:
    """The files of a folder that Spark wrote."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(status.getPath().getName() for status in fs.listStatus(hadoop))
    return [f"{path}/{n}" for n in names if n.startswith("part-")]
