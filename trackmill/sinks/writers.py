"""Delimited files, database tables, messages and report lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmill.functions.texts import NULL_MARK, coded

#: Blanks are kept, quotes doubled, and empty texts quoted, which tells them from nothing.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "nullValue": NULL_MARK,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
BUCKET = "bucket"
#: The six header lines of a track; the fifth one names it.
PLT_HEADER = ("Track file", "WGS 84", "Altitude in feet", "Reserved", "0,2,255,%s,0,0,2,8421376", "0")
#: A header's line with a name. It has a field more than a point.
PLT_NAME_LINE = r"(?s)^0,2,255,(.*),0,0,2,8421376$"


def as_text(df: DataFrame) -> DataFrame:
    """Every column as coded text, null as its mark; ``sources.files.typed`` gives the values back."""
    return df.select(*_coded_columns(df))


def _coded_columns(df: DataFrame, but: Sequence[str] = ()) -> list[Column]:
    return [F.coalesce(coded(F.col(c).cast("string")), F.lit(NULL_MARK)).alias(c) for c in df.columns if c not in but]


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """Comma-separated values with header, quoted where needed. Every line is a row.

    Line feeds, tabs and backslashes are coded, so files can be split at any line and
    ``read_written_csv`` gives back the same values, blanks, empty texts and nulls too.
    """
    as_text(df).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_tsv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Tab-separated values without header or quoting, coded like ``write_csv``."""
    line = F.concat_ws("\t", *as_text(df).columns)
    as_text(df).select(line.alias("value")).write.mode(mode).text(path)


def write_intervals(df: DataFrame, path: str, key: str, direction: str = "direction", buckets: int = 64, mode: str = "error") -> None:
    """All intervals as one table of CSV files, partitioned by direction and a hash bucket of the key.

    The number of folders does not grow with the number of intervals.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    rows = df.withColumn(BUCKET, bucket).select(*_coded_columns(df, [direction]), direction, BUCKET)
    writer = rows.hint("rebalance", direction, BUCKET).write.mode(mode).partitionBy(direction, BUCKET)
    writer.options(**CSV_OPTIONS).csv(path)


def write_by_interval(df: DataFrame, path: str, keys: list[str], mode: str = "error") -> None:
    """One folder of CSV files per interval: for chosen intervals, not for whole collections.

    Rows of an interval are brought together first, so that few files are
    written; rebalancing splits an interval that is too large for one task.
    """
    rows = df.select(*_coded_columns(df, keys), *keys)
    rows.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).options(**CSV_OPTIONS).csv(path)


def write_plt_tracks(points: DataFrame, path: str, mode: str = "error") -> None:
    """Tracks as PLT text, many in a file, each below six header lines of which the fifth names it.

    Points carry ``name``, ``ts``, ``seq``, ``lat``, ``lon``, ``altitude`` and ``day_serial``. The number of
    files follows from the rows, not from the tracks. Rows are cut into ranges of name and time, so a
    long track goes on, below a header of its own, in the next file; points of one second stay in one.
    ``read_plt_tracks`` gives them back in whole seconds.
    """
    ranged = points.withColumn("_second", F.date_trunc("second", "ts")).repartitionByRange("name", "_second")
    ranged = ranged.withColumn("_part", F.spark_partition_id())
    of_track = Window.partitionBy("_part", "name").orderBy("ts", "seq")
    line = F.concat_ws(
        ",", F.col("lat").cast("string"), F.col("lon").cast("string"), F.lit("0"), F.coalesce(F.col("altitude").cast("string"), F.lit("-777")),
        F.col("day_serial").cast("string"), F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss"),
    )
    name = F.coalesce(coded(F.col("name")), F.lit(NULL_MARK))
    header = F.format_string("\n".join(PLT_HEADER), name)
    begins = F.row_number().over(of_track) == 1
    lines = ranged.withColumn("value", F.when(begins, F.concat_ws("\n", header, line)).otherwise(line))
    lines.sortWithinPartitions("_part", "name", "ts", "seq").select("value").write.mode(mode).text(path)


def append_table(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_rows: int = 10_000, writers: int = 16
) -> None:
    """Append rows to a database table over ``writers`` connections.

    The rows are dealt out to the connections, so the plan behind them keeps its own tasks.
    """
    df.repartition(writers).write.option("batchsize", batch_rows).option("numPartitions", writers).jdbc(
        url, table, mode="append", properties=dict(properties)
    )


def rows_not_yet_in(df: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key the target does not hold, so that a repeated append adds nothing."""
    return df.join(existing.select(*key), key, "left_anti")


def as_messages(df: DataFrame, key: Column | None = None) -> DataFrame:
    """Rows as JSON messages: ``value``, and ``key`` when one is given."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(value) if key is None else df.select(key.cast("string").alias("key"), value)


def publish(df: DataFrame, servers: str, topic: str) -> None:
    """Send message rows to a topic. The session needs Spark's Kafka connector."""
    df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def report_line(template: str, *columns) -> Column:
    """One line of text per row; ``template`` is a format string."""
    return F.format_string(template, *columns)


def write_loads(df: DataFrame, path: str, load: str) -> None:
    """Append whole loads to a Parquet table, a folder per value of ``load``.

    Files are staged and put in place when the job is done. A load that is written again, after
    a failure or by mistake, replaces its own folder and no other, so a repeated run adds
    nothing. All rows of a load have to be in one frame; their number of files follows from it.
    """
    writer = df.hint("rebalance", load).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(load).parquet(path)
