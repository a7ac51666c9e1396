"""Row rules, reports of the rows that break them, and clean rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from trackmill.functions.categories import CENSUS_CATEGORIES, UNKNOWN
from trackmill.functions.texts import is_number
from trackmill.schemas import CENSUS_ATTRIBUTES, CENSUS_NUMBERS


def incomplete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with a null in any column."""
    missing = [F.col(c).isNull() for c in columns or df.columns]
    any_missing = missing[0]
    for one in missing[1:]:
        any_missing = any_missing | one
    return df.filter(any_missing)


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(columns) if columns else None)


def in_domain(value: Column, domain: Sequence[str]) -> Column:
    return value.isin(*domain)


def with_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``violations``, the names of the rules that a row breaks. A rule that is null is broken."""
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def invalid_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return with_violations(df, rules).filter(F.size("violations") > 0)


def valid_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return with_violations(df, rules).filter(F.size("violations") == 0).drop("violations")


def census_rules() -> dict[str, Column]:
    """Numbers must be numbers and categories known; ``?`` is a known category."""
    rules = {}
    for name in CENSUS_ATTRIBUTES:
        value = F.col(name)
        if name in CENSUS_NUMBERS:
            rules[name] = is_number(value)
        else:
            rules[name] = in_domain(value, [*CENSUS_CATEGORIES[name], UNKNOWN])
    return rules


OK = "ok"


def write_quarantined(df: DataFrame, rules: Mapping[str, Column], path: str) -> dict[str, int]:
    """Write rows that keep all rules and rows that break some side by side, in one pass; rows broken by rule.

    ``path`` gets a folder for each, with ``violations`` (empty for good rows). The counts are metrics that the
    tasks observe while they write, so nothing is read twice; ``rows`` and ``bad_rows`` are among them. Of a stage that
    runs again after a lost executor each partition counts once.
    """
    marked = with_violations(df, rules)
    bad = F.size("violations") > 0
    counts = [F.count_if(F.array_contains("violations", name)).alias(name) for name in rules]
    seen = Observation()
    observed = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad_rows"), *counts)
    observed.withColumn(OK, ~bad).write.mode("overwrite").partitionBy(OK).parquet(path)
    return seen.get


def read_quarantined(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows written, with ``violations`` and ``ok``; a filter on ``ok`` reads one folder only."""
    more = [StructField("violations", ArrayType(StringType())), StructField(OK, BooleanType())]
    return spark.read.schema(StructType([*schema.fields, *more])).parquet(path)
