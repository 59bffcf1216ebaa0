"""Where a stream may go. Every query has its own checkpoint."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from barlake.sources.warehouse import Warehouse

# Seconds between micro-batches per sink.
TRIGGERS = {"console": "10 seconds", "parquet": "30 seconds", "memory": "5 seconds"}


def _trigger(writer: DataStreamWriter, sink: str, drain: bool) -> DataStreamWriter:
    """``drain`` reads what is there and stops; otherwise the sink's own pace."""
    return writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=TRIGGERS[sink])


def write_console(
    rows: DataFrame, output_mode: str = "append", checkpoint: str | None = None, drain: bool = False
) -> StreamingQuery:
    writer = rows.writeStream.outputMode(output_mode).format("console").option("truncate", "false")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return _trigger(writer, "console", drain).start()


def write_parquet(
    rows: DataFrame, path: str, checkpoint: str, drain: bool = False, partition: str | None = "symbol"
) -> StreamingQuery:
    """Append files, one folder per symbol. Read back with a schema: folder names alone
    would turn a symbol like 0700 into a number. Rows of a folder meet in one task, so a
    trigger adds a file to each, not one for each task."""
    dealt = rows.repartition(partition) if partition else rows
    writer = (
        dealt.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition:
        writer = writer.partitionBy(partition)
    return _trigger(writer, "parquet", drain).start()


def write_memory(
    rows: DataFrame, name: str = "stock_prices", output_mode: str = "append", drain: bool = False
) -> StreamingQuery:
    """A table on the driver, for tests only."""
    writer = rows.writeStream.outputMode(output_mode).format("memory").queryName(name)
    return _trigger(writer, "memory", drain).start()


def write_batches(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Hand each micro-batch to ``write``, which must give the same result if a batch is
    sent again."""
    writer = (
        rows.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if drain:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


class EnoughSeen(Exception):
    """Raised in a micro-batch to end the query before that batch is recorded: the next
    start reads it again."""


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives its query: the same when the query is started again,
    another one for another checkpoint. Known once the query has started."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def append_to_warehouse(
    quotes: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    on_written: Callable[[int], None] | None = None,
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Append every micro-batch to the price table. The table records it with its rows: one
    that is sent again adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sent = run_id(warehouse.spark, checkpoint), batch_id
        written = warehouse.append_prices(batch, on_duplicate="skip", source="kafka", batch=sent)
        if on_batch:
            on_batch(batch, batch_id)
        if on_written:
            on_written(written)

    return write_batches(quotes, write, checkpoint, every=every, drain=drain)
