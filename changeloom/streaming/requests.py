"""Batches that arrive one after the other: a stream of requests, each naming its change files.

A request is one JSON line in a folder that Structured Streaming watches. The change data itself is read by
the batch plans; only the file names pass the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..errors import ChangeError
from ..model import BatchFiles, ReadOptions
from ..plans.batches import write_batch, write_history_batch
from ..sources.tables import VersionedTable

REQUEST_SCHEMA = (
    "sequence bigint, replace array<string>, update array<string>, delete array<string>, earliest array<string>"
)


def follow(
    spark: SparkSession,
    requests: str,
    table: VersionedTable,
    checkpoint: str,
    *,
    name: str = "requests",
    history: bool = False,
    options: ReadOptions | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Apply requests in the order of their sequence numbers, each exactly once.

    The sequence number and the micro-batch are published with the table version they led to, so a micro-batch
    that is repeated after a failure skips what is already in force. A request that comes in a later micro-batch
    than one with a higher number fails the stream: it can neither be applied in order nor be left out.
    """
    apply = write_history_batch if history else write_batch

    def run(batch: DataFrame, number: int) -> None:
        for request in batch.orderBy("sequence").toLocalIterator():
            done = table.head().stream
            if request["sequence"] <= done.get(name, -1):
                if number > done.get(f"{name}/batch", number):
                    raise ChangeError(f"Request {request['sequence']} came after request {done[name]} was applied")
                continue
            files = BatchFiles(*[tuple(request[k] or ()) for k in ("replace", "update", "delete", "earliest")])
            apply(table, files, options, stream={name: request["sequence"], f"{name}/batch": number})

    stream = spark.readStream.schema(REQUEST_SCHEMA).json(requests)
    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
