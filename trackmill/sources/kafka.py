"""Streams from Kafka topics and from folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def kafka_options(servers: str, topic: str, per_trigger: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_topic(
    spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None
) -> DataFrame:
    """Messages of a topic. The session needs Spark's Kafka connector."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, per_trigger)).load()


def read_table_stream(
    spark: SparkSession, folder: str, schema: StructType, files: str = "*.parquet", per_trigger: int = 1000
) -> DataFrame:
    """Parquet files of a folder as a stream, ``per_trigger`` files at a time."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", files)
        .option("maxFilesPerTrigger", per_trigger)
        .parquet(folder)
    )
