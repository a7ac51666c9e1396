"""Projection, duplicate removal, ranking, growth and splitting."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_lines_with(lines: DataFrame, column: str, parts: dict[str, str]) -> DataFrame:
    """Lines that contain each substring, counted in one pass. ``parts`` maps names to substrings."""
    return lines.agg(*[F.count_if(F.col(column).contains(part)).alias(name) for name, part in parts.items()])


def rename(df: DataFrame, **names: str) -> DataFrame:
    """Rename columns, old name to new name."""
    return df.withColumnsRenamed(names)


def fill_zero(df: DataFrame, *columns: str) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, which should be total.

    Spark cuts each key to one row before the shuffle, so a frequent key costs no more.
    """
    in_order = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(in_order)).filter("_place = 1").drop("_place")


def top_n(df: DataFrame, n: int, by: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the largest ``by``, without a full sort."""
    return df.orderBy(F.col(by).desc(), *tie_break).limit(n)


def first_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def after_first_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """All rows but the first ``n`` by ``order``, which should be total and without nulls.

    The last of the first ``n`` is found as in ``first_n`` and the rest is a filter,
    so the rows stay where they are; an offset would bring them all to one task.
    """
    place = F.struct(*order)
    last = first_n(df, n, order).agg(F.max(place)).scalar()
    return df.filter(F.coalesce(place > last, F.lit(True)))


def sum_by(df: DataFrame, key: Sequence[str], **sums: Column) -> DataFrame:
    """Sums per key."""
    return df.groupBy(*key).agg(*[F.sum(value).alias(name) for name, value in sums.items()])


def ranked(df: DataFrame, n: int, by: str, tie_break: Sequence[str]) -> DataFrame:
    """``top_n`` with its place 1..n as ``place``."""
    order = Window.orderBy(F.col(by).desc(), *tie_break)
    return top_n(df, n, by, tie_break).withColumn("place", F.row_number().over(order))


def growth_by(
    df: DataFrame, key: Sequence[str], now: Column, before: Column, least_before: float = 0
) -> DataFrame:
    """``growth`` = (sum of now - sum of before) / sum of before, where before is at least the bound."""
    sums = df.groupBy(*key).agg(F.sum(now - before).alias("gained"), F.sum(before).alias("before"))
    large = sums.filter(F.col("before") >= least_before)
    return large.withColumn("growth", F.try_divide("gained", "before"))


def fastest_growth(growth: DataFrame, tie_break: Sequence[str]) -> DataFrame:
    return top_n(growth, 1, "growth", tie_break)


def stack(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked


def hash_split(df: DataFrame, key: str, share: float) -> tuple[DataFrame, DataFrame]:
    """A random split by key that stays the same whatever the partitions.

    The first part holds the keys whose MD5, read as a number, is below ``share`` of the range.
    """
    bound = ceil(share * 16**8)
    head = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 8)
    below = F.lit(share >= 1) | (head < f"{bound:08x}")
    return df.filter(below), df.filter(~below)


def random_split(df: DataFrame, shares: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    """A split by random numbers; ``hash_split`` is the one that outlives a change of partitions."""
    return df.randomSplit(list(shares), seed)


def lookup(df: DataFrame, codes: DataFrame, on: str) -> DataFrame:
    """Codes from a table; rows without one keep null. Spark broadcasts the table when it is small."""
    return df.join(codes, on, "left")
