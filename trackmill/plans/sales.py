"""Beer sales: cleaning, totals, rankings and growth by region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.functions.texts import grouped_number
from trackmill.operators.relational import fastest_growth, growth_by, ranked, sum_by
from trackmill.schemas import SALES_TEXT

# Last year's sum that a region needs to be compared.
LEAST_LAST_YEAR = 500


def clean(sales: DataFrame) -> DataFrame:
    """Rows with sales or forecast whose weeks agree with their rounded mean."""
    weeks = F.col("w1") + F.col("w2") + F.col("w3")
    sold = F.col("avg3") * 3 + F.col("forecast") != 0
    return sales.filter(sold & (F.abs(weeks - 3 * F.col("avg3")) < 3))


def numbers_from_text(sales_text: DataFrame) -> DataFrame:
    """Quoted thousands as numbers in every column but product and region."""
    kept = ("product", "region")
    return sales_text.select(
        *[F.col(c) if c in kept else grouped_number(F.col(c)).alias(c) for c in SALES_TEXT.names]
    )


def product_count(sales: DataFrame) -> DataFrame:
    return sales.agg(F.countDistinct("product").alias("products"))


def totals_by(sales: DataFrame, key: str) -> DataFrame:
    """Sales of the three weeks per product or region."""
    return sum_by(sales, [key], total=F.col("w1") + F.col("w2") + F.col("w3"))


def best_sellers(sales: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` largest totals with their place."""
    return ranked(totals_by(sales, key), n, "total", [key])


def growth_by_region(sales: DataFrame) -> DataFrame:
    """Growth of the month, taken as four times the weekly mean, over last year's month."""
    return growth_by(sales, ["region"], 4 * F.col("avg3"), F.col("last_year"), LEAST_LAST_YEAR)


def fastest_growing_region(sales: DataFrame) -> DataFrame:
    return fastest_growth(growth_by_region(sales), ["region"])


def report(sales: DataFrame, names: list[str]) -> DataFrame:
    """Rows as comma-separated text."""
    return sales.select(F.concat_ws(",", *[F.col(c).cast("string") for c in names]).alias("line"))
