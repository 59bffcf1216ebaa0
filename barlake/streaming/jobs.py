"""The streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from barlake.operators.messages import check_messages, decode_permissive
from barlake.operators.quarantine import accepted, rejected
from barlake.operators.sliding import flat_windows, sliding_stats
from barlake.sources.topics import publish
from barlake.sources.warehouse import Warehouse
from barlake.streaming import sinks
from barlake.streaming.states import WindowStates

SINKS = ("console", "parquet", "memory")


def _wait(query: StreamingQuery, await_termination: bool) -> StreamingQuery:
    if await_termination:
        query.awaitTermination()
    return query


def _need(sink: str, path: str | None, checkpoint: str | None) -> None:
    if sink not in SINKS:
        raise ValueError(f"unknown sink: {sink}")
    if sink == "parquet" and not (path and checkpoint):
        raise ValueError("the parquet sink needs a path and a checkpoint")


def run_streaming_job(
    records: DataFrame,
    sink: str = "console",
    path: str | None = None,
    checkpoint: str | None = None,
    name: str = "stock_prices",
    await_termination: bool = True,
    drain: bool = False,
) -> StreamingQuery:
    """Decode the topic and write the rows to a sink."""
    _need(sink, path, checkpoint)
    rows = decode_permissive(records)
    if sink == "console":
        query = sinks.write_console(rows, checkpoint=checkpoint, drain=drain)
    elif sink == "parquet":
        query = sinks.write_parquet(rows, path, checkpoint, drain)
    else:
        query = sinks.write_memory(rows, name, drain=drain)
    return _wait(query, await_termination)


def run_aggregation_job(
    records: DataFrame,
    sink: str = "console",
    path: str | None = None,
    checkpoint: str | None = None,
    name: str = "price_windows",
    await_termination: bool = True,
    drain: bool = False,
) -> StreamingQuery:
    """Decode the topic and keep sliding-window statistics.

    Console and memory show every changed window (``update``). Files cannot be updated,
    so the Parquet sink gets each window once, when the watermark has passed its end.
    """
    _need(sink, path, checkpoint)
    stats = flat_windows(sliding_stats(decode_permissive(records)))
    if sink == "console":
        query = sinks.write_console(stats, "update", checkpoint, drain)
    elif sink == "parquet":
        # No folder per symbol: the files of one trigger stay as few as its tasks.
        query = sinks.write_parquet(stats, path, checkpoint, drain, partition=None)
    else:
        query = sinks.write_memory(stats, name, "update", drain)
    return _wait(query, await_termination)


def without_resent(quotes: DataFrame, horizon: str) -> DataFrame:
    """Drop copies of a quote id that arrive within the horizon; state stays bounded.

    Also drops quotes later than the horizon, so it suits a display, not a table.
    """
    watched = quotes.withWatermark("timestamp", horizon)
    return watched.dropDuplicatesWithinWatermark(["stock_price_id"])


def run_consumer_pipeline(
    records: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    max_messages: int | None = None,
    on_process: Callable[[DataFrame, int], None] | None = None,
    quarantine: str | None = None,
    every: str | None = None,
    drain: bool = True,
) -> int:
    """Topic to price table: strict decode, no copies, append. Returns the rows written.

    Copies are found against the table itself, so a late quote is still stored.
    ``drain`` handles what the source holds and stops. ``max_messages`` (none or 0: no
    limit) is never exceeded: the job ends before the micro-batch that would, and the next
    start reads that one first. It counts the messages seen, good or not, in whole
    micro-batches, so it needs a source limited per trigger: a first micro-batch that alone
    exceeds it is an error. ``quarantine`` is a folder for the unusable messages and why
    they are; each micro-batch of each checkpoint has its own subfolder, replaced if it is
    sent again. ``on_process`` sees the quotes of each micro-batch.
    """
    warehouse.create_missing()
    written: list[int] = []
    stop = _Stop()
    seen = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal seen
        # Decoded once for both outputs; a lost block is decoded again to the same rows.
        checked = batch.persist()
        try:
            if max_messages:
                messages = checked.count()
                if messages > max_messages:
                    raise ValueError(
                        f"a micro-batch has {messages} messages, max_messages is {max_messages}: limit the source per trigger"
                    )
                if seen + messages > max_messages:
                    stop.now()
                seen += messages
            quotes = accepted(checked).drop("value", "record_timestamp")
            run = sinks.run_id(warehouse.spark, checkpoint)
            written.append(warehouse.append_prices(quotes, "skip", source="kafka", batch=(run, batch_id)))
            bad = rejected(checked).select("value", "record_timestamp", "reasons")
            if quarantine and not bad.isEmpty():
                bad.write.mode("overwrite").parquet(f"{quarantine}/run={run}/batch_id={batch_id}")
            if on_process:
                on_process(quotes, batch_id)
        finally:
            checked.unpersist()

    checked = check_messages(records)
    stop.wait(sinks.write_batches(checked, write, checkpoint, every=every, drain=drain))
    return sum(written)


class _Stop:
    """Ends a query from within a micro-batch; every other error is the caller's."""

    def __init__(self) -> None:
        self.raised = False

    def now(self) -> None:
        self.raised = True
        raise sinks.EnoughSeen

    def wait(self, query: StreamingQuery) -> None:
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if not self.raised:
                raise


def publish_continuously(
    quotes: DataFrame,
    checkpoint: str,
    options: dict[str, str] | None = None,
    fmt: str = "kafka",
    path: str | None = None,
    interval: str = "60 seconds",
    max_rounds: int | None = None,
    on_round: Callable[[DataFrame, int], None] | None = None,
    drain: bool = False,
) -> list[int]:
    """Publish each micro-batch of a quote stream; returns the messages per round.

    The round after the last allowed one stops the query unrecorded, so its quotes are
    published when the job is started again.
    """
    sent: list[int] = []
    stop = _Stop()

    def round_(batch: DataFrame, batch_id: int) -> None:
        if max_rounds is not None and len(sent) >= max_rounds:
            stop.now()
        sent.append(publish(batch, options, fmt, path))
        if on_round:
            on_round(batch, batch_id)

    stop.wait(sinks.write_batches(quotes, round_, checkpoint, every=interval, drain=drain))
    return sent


def keep_latest_windows(
    records: DataFrame, path: str, checkpoint: str, drain: bool = True
) -> StreamingQuery:
    """Sliding statistics as one row per symbol and window, updated as quotes arrive.

    Each micro-batch's changed windows are added to the states at ``path`` once, however
    often it is sent; :func:`latest_windows` reads the newest state of each window. A run
    with a new checkpoint starts its windows anew, and its states are the newer ones.
    """
    stats = flat_windows(sliding_stats(decode_permissive(records)))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        WindowStates(spark, path).add(batch, sinks.run_id(spark, checkpoint), batch_id)

    return sinks.write_batches(stats, write, checkpoint, "update", drain=drain)


def latest_windows(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of each window."""
    return WindowStates(spark, path).read()
