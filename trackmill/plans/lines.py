"""Counts and rankings over plain lines, and the two smoke queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.functions.texts import has_fields, split_on
from trackmill.operators.relational import count_lines_with


def hello(spark: SparkSession) -> DataFrame:
    return spark.sql("select 'spark' as hello")


def sum_of_ids(spark: SparkSession, n: int = 10) -> DataFrame:
    """The sum of 0 .. n-1."""
    return spark.range(n).agg(F.sum("id").alias("total"))


def lines_with_a_and_b(lines: DataFrame) -> DataFrame:
    return count_lines_with(lines, "value", {"lines_with_a": "a", "lines_with_b": "b"})


def largest_numbers(lines: DataFrame, n: int = 5, field: int = 2, n_fields: int = 4) -> DataFrame:
    """The ``n`` largest whole numbers in one field of the well-formed comma lines."""
    line = F.col("value")
    number = split_on(line, ",")[field].try_cast("bigint").alias("number")
    numbers = lines.filter(has_fields(line, n_fields)).select(number).dropna()
    return numbers.orderBy(F.col("number").desc()).limit(n)
