"""The quote topic as source and sink.

``fmt`` names the connector: ``kafka`` in production, a file format with the same
record columns where no broker is at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barlake.operators.messages import encode_quotes
from barlake.schemas import TOPIC, TOPIC_RECORDS

FILE_FORMATS = ("parquet", "json", "orc")
# Bytes of a row group of a topic's Parquet file. A task reads whole row groups, so that a
# micro-batch of one large file still keeps many tasks busy.
ROW_GROUP = 4 << 20


def source_options(
    servers: str, topic: str = TOPIC, starting: str = "earliest", max_per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def consumer_options(
    servers: str,
    topic: str = TOPIC,
    group_id: str = "stock-price-consumer",
    starting: str = "earliest",
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """The same source under a named group. Progress lives in the query's checkpoint and
    is recorded after the rows are written, so a crash between the two loses nothing."""
    return source_options(servers, topic, starting, max_per_trigger) | {"kafka.group.id": group_id}


def sink_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.client.id": "stock-price-producer",
    }


def read_topic(
    spark: SparkSession,
    options: dict[str, str] | None = None,
    fmt: str = "kafka",
    path: str | None = None,
) -> DataFrame:
    """A stream of key, value and timestamp."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt in FILE_FORMATS:
        return reader.schema(TOPIC_RECORDS).load(path)
    return reader.load().select("key", "value", "timestamp")


def publish(
    quotes: DataFrame,
    options: dict[str, str] | None = None,
    fmt: str = "kafka",
    path: str | None = None,
) -> int:
    """Write one snapshot to the topic and return how many messages were sent.

    The count is taken in the writing stage itself, where each partition reports once.
    """
    sent = Observation("published")
    records = encode_quotes(quotes)
    if fmt in FILE_FORMATS:
        records = records.withColumn("timestamp", F.current_timestamp())
    records = records.observe(sent, F.count(F.lit(1)).alias("messages"))
    if fmt == "parquet":
        options = {"parquet.block.size": str(ROW_GROUP)} | (options or {})
    writer = records.write.format(fmt).mode("append").options(**(options or {}))
    writer.save(path) if path else writer.save()
    return sent.get["messages"]
