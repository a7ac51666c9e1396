"""JSON messages, and starting the queries that write them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from trackmill.operators.trajectory import pair_speed
from trackmill.schemas import PAIR_MESSAGE, PERSON_MESSAGE


def parse_messages(messages: DataFrame, schema: StructType) -> DataFrame:
    """The fields of JSON in ``value``, binary or text. A malformed message gives nulls."""
    data = F.from_json(F.col("value").cast("string"), schema).alias("data")
    return messages.select(data).select("data.*")


def person_messages(messages: DataFrame) -> DataFrame:
    return parse_messages(messages, PERSON_MESSAGE)


def pair_speeds(messages: DataFrame) -> DataFrame:
    """Distance, time difference and speed of paired-point messages, row by row."""
    numbers = [F.col(c).try_cast("double").alias(c) for c in PAIR_MESSAGE.names]
    return pair_speed(parse_messages(messages, PAIR_MESSAGE).select(*numbers))


def start_append(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    sink: str = "parquet",
    every: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Start an append query. Without ``every`` it takes all there is and ends."""
    writer = stream.writeStream.format(sink).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.options(**options)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path) if path else writer.start()


def start_continuous(stream: DataFrame, checkpoint: str, sink: str = "noop", commit_every: str = "1 second", **options: str) -> StreamingQuery:
    """Start an append query without micro-batches: each row goes on as it comes, positions are kept at intervals.

    For sources and sinks that can do so (rates and topics), and for row-by-row work. After a
    restart rows since the last kept position come again.
    """
    writer = stream.writeStream.format(sink).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.options(**options).trigger(continuous=commit_every).start()


def show_console(stream: DataFrame, every: str | None = None) -> StreamingQuery:
    """Print a stream, appended rows only."""
    writer = stream.writeStream.format("console").outputMode("append")
    return (writer.trigger(processingTime=every) if every else writer).start()


def publish_stream(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, every: str, mode: str = "append"
) -> StreamingQuery:
    """Send message rows to a topic as they come. The session needs Spark's Kafka connector."""
    writer = messages.writeStream.format("kafka").outputMode(mode).trigger(processingTime=every)
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).start()
