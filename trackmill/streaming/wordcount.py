"""Running word frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trackmill.functions.texts import split_on
from trackmill.session import remove_dir
from trackmill.streaming.messages import publish_stream

REPORT_EVERY = "8 seconds"
#: Batches after which all counts are written together.
COMPACT_EVERY = 50


def split_words(texts: DataFrame, column: str) -> DataFrame:
    """The words between blanks, one per row."""
    return texts.select(F.explode(split_on(F.col(column), " ")).alias("word")).filter(F.col("word") != "")


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """Occurrences of every word so far."""
    return split_words(texts, column).groupBy("word").count()


def publish_word_counts(
    texts: DataFrame, column: str, servers: str, topic: str, checkpoint: str, every: str = REPORT_EVERY
) -> StreamingQuery:
    """Send every changed count to a result topic, by default every 8 seconds."""
    counts = result_messages(word_counts(texts, column))
    return publish_stream(counts, servers, topic, checkpoint, every, mode="update")


def start_word_counts(
    texts: DataFrame,
    column: str,
    path: str,
    checkpoint: str,
    every: str | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Write the counts that changed in each batch to ``path``, one folder per batch.

    Every ``compact_every``-th folder holds the counts of all words, and older folders are
    removed, so what is kept and read grows with the words and not with time. A repeated
    batch replaces its own folder. Without ``every`` the query takes all there is and ends.
    """

    def folder(batch_id: int) -> str:
        return f"{path}/batch_id={batch_id}"

    def write(changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        if (batch_id + 1) % compact_every == 0 and batch_id > 0:
            earlier = range(max(0, batch_id - compact_every), batch_id)
            held = spark.read.schema(changed.schema).parquet(*[folder(b) for b in earlier])
            changed = held.unionByName(changed).groupBy("word").agg(F.max("count").alias("count"))
        changed.write.mode("overwrite").parquet(folder(batch_id))
        if batch_id % compact_every == 1:
            # The whole counts before this batch are safe, and no batch before it runs again.
            for old in range(max(0, batch_id - 1 - 2 * compact_every), batch_id - 2):
                remove_dir(spark, folder(old))

    writer = (
        word_counts(texts, column)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def current_counts(spark: SparkSession, path: str) -> DataFrame:
    """The latest count of every word. Counts only grow, so the latest is the largest."""
    return spark.read.parquet(path).groupBy("word").agg(F.max("count").alias("count"))


def result_messages(counts: DataFrame) -> DataFrame:
    """Counts as messages for a result topic: the word is the key, the count the value."""
    return counts.select(F.col("word").alias("key"), F.col("count").cast("string").alias("value"))
