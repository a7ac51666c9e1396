"""Census income and iris: validation, encoding and a decision tree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.functions.categories import CENSUS_CATEGORIES, codes_of, encode
from trackmill.functions.texts import split_on, without_trailing_dot
from trackmill.operators.quality import census_rules, invalid_rows
from trackmill.operators.trees import assemble, tree_pipeline
from trackmill.schemas import CENSUS, CENSUS_ATTRIBUTES, CENSUS_NUMBERS, IRIS_FEATURES
from trackmill.sources.files import number_lines


def faulty_rows(census: DataFrame) -> DataFrame:
    """Rows that break a rule, with the names of the rules."""
    return invalid_rows(census, census_rules())


def faulty_lines(spark: SparkSession, path) -> DataFrame:
    """File and 1-based line number of the census lines that break a rule."""
    fields = split_on(F.col("value"), ", ")
    columns = [F.try_element_at(fields, F.lit(i)).alias(name) for i, name in enumerate(CENSUS.names, 1)]
    rows = number_lines(spark, path).select("file", "line_no", *columns)
    return faulty_rows(rows).select("file", "line_no", "violations")


def encoded(census: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every attribute as a number and the label without a trailing dot.

    A category outside the tables, or a number that is none, becomes null; such rows
    are the ones that ``faulty_rows`` reports.
    """
    columns = [
        F.col(name).try_cast("double").alias(name)
        if name in CENSUS_NUMBERS
        else encode(F.col(name), codes_of(CENSUS_CATEGORIES[name])).cast("double").alias(name)
        for name in CENSUS_ATTRIBUTES
    ]
    return census.select(*keep, *columns, without_trailing_dot(F.col("label")).alias("label"))


def features(census: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 14 attributes as one vector, with the label and the columns to keep."""
    return assemble(encoded(census, keep), CENSUS_ATTRIBUTES)


def fit(census: DataFrame, **options) -> PipelineModel:
    return tree_pipeline(features(census), **options)


def iris_features(iris: DataFrame) -> DataFrame:
    return assemble(iris, IRIS_FEATURES).select("features", "label")
