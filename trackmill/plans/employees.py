"""Employee queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.operators.relational import first_n, keep_first, rename


def all_rows(df: DataFrame) -> DataFrame:
    return df.select("*")


def one_per_id(df: DataFrame) -> DataFrame:
    return keep_first(df, ["id"], ["name", "age"])


def without_id(df: DataFrame) -> DataFrame:
    return df.select("name", "age")


def older_than(df: DataFrame, age: int = 30) -> DataFrame:
    return df.filter(F.col("age") > age)


def count_by_age(df: DataFrame) -> DataFrame:
    """Rows per age; a missing age is a group of its own."""
    return df.groupBy("age").count()


def by_name(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("name").asc())


def first_rows(df: DataFrame, n: int = 3) -> DataFrame:
    return first_n(df, n, ["id"])


def user_names(df: DataFrame) -> DataFrame:
    return rename(df.select("name"), name="username")


def mean_age(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("age").alias("mean_age"))


def least_age(df: DataFrame) -> DataFrame:
    return df.agg(F.min("age").alias("min_age"))



def report(df: DataFrame) -> DataFrame:
    """Lines such as ``id:1,name:Ella,age:36``."""
    return df.select(F.format_string("id:%s,name:%s,age:%s", "id", "name", "age").alias("line"))


def query_view(df: DataFrame, view: str, sql: str) -> DataFrame:
    """The result of SQL text over the frame, registered as a view."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)
