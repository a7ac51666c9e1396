"""Database tables through JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def subquery(sql: str, alias: str = "q") -> str:
    """A query in the place of a table, so that the database computes it."""
    return f"({sql}) {alias}"


def aggregate_sql(table: str, **aggregates: str) -> str:
    """``aggregate_sql("t", age_max="max(age)")`` as query text."""
    columns = ", ".join(f"{text} AS {name}" for name, text in aggregates.items())
    return f"SELECT {columns} FROM {table}"


def read_query(
    spark: SparkSession,
    url: str,
    sql: str,
    properties: Mapping[str, str],
    fetch_rows: int = 10_000,
    partition: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Rows of a query. ``partition`` is column, lower bound, upper bound and number of reads.

    Without it one connection and one task read all rows: for small results only.
    """
    reader = spark.read.format("jdbc").options(**properties)
    reader = reader.option("url", url).option("dbtable", subquery(sql)).option("fetchsize", fetch_rows)
    if partition:
        column, lower, upper, reads = partition
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", reads)
        )
    return reader.load()


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partition: tuple[str, int, int, int],
    columns: str = "*",
) -> DataFrame:
    """Rows of a table, which may be large and so is never read over one connection only."""
    return read_query(spark, url, f"SELECT {columns} FROM {table}", properties, partition=partition)


def read_aggregates(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], **aggregates: str
) -> DataFrame:
    """One row of aggregates that the database computes."""
    return read_query(spark, url, aggregate_sql(table, **aggregates), properties)
