"""Encoded features, label indexes and decision trees."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trackmill.functions.categories import CENSUS_CATEGORIES, codes_of, encode
from trackmill.operators import relational, trees
from trackmill.plans import census
from trackmill.plans.queries.base import query, table
from trackmill.schemas import CENSUS_ATTRIBUTES, CENSUS_NUMBERS

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
INPUTS = ("price", "priority", "year", "month")
_CODE = """CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
       WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 4 WHEN '5-LOW' THEN 5 WHEN '?' THEN -1 END"""
#: The label follows from the features, so that the right tree is known.
_LABEL = f"CASE WHEN {_CODE} <= 2 THEN 'soon' WHEN month(o_orderdate) <= 6 THEN 'spring' ELSE 'autumn' END"


def _encoded(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("price"),
        encode(F.col("o_orderpriority"), codes_of(PRIORITIES)).alias("priority"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.col("o_orderstatus").alias("status"),
    )


def _predicted(spark, folder):
    """All orders, by a tree learned on seven tenths of them."""
    label = F.when(F.col("priority") <= 2, "soon").when(F.col("month") <= 6, "spring").otherwise("autumn")
    orders = trees.assemble(_encoded(spark, folder).withColumn("label", label), INPUTS)
    train, _ = relational.hash_split(orders, "o_orderkey", 0.7)
    return trees.predict(trees.tree_pipeline(train, unseen="keep"), orders)


@query(f"""
SELECT o_orderkey, o_totalprice AS price, {_CODE} AS priority,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       o_orderstatus AS status FROM orders""")
def encoded_features(spark, folder):
    return _encoded(spark, folder)


def _slot_sql(place, name):
    """A number from the key, or the code of the category that the key picks."""
    if name in CENSUS_NUMBERS:
        return f"o_orderkey % {place + 50}"
    return f"o_orderkey % {len(CENSUS_CATEGORIES[name])} + 1"


@query(f"""
SELECT o_orderkey, array_to_string([{', '.join(_slot_sql(i, c) for i, c in enumerate(CENSUS_ATTRIBUTES))}], ',') AS slots,
       CASE WHEN o_orderkey % 2 = 0 THEN '<=50K' ELSE '>50K' END AS label FROM orders""")
def census_features(spark, folder):
    """The census vector of 14 slots, from rows whose categories are picked by the order's key."""

    def value(place, name):
        key = F.col("o_orderkey")
        if name in CENSUS_NUMBERS:
            return (key % (place + 50)).cast("string")
        names = CENSUS_CATEGORIES[name]
        return F.element_at(F.array(*map(F.lit, names)), (key % len(names) + 1).cast("int"))

    orders = table(spark, folder, "orders").select("o_orderkey")
    label = F.when(F.col("o_orderkey") % 2 == 0, "<=50K.").otherwise(">50K.")
    rows = orders.select("o_orderkey", *[value(i, c).alias(c) for i, c in enumerate(CENSUS_ATTRIBUTES)], label.alias("label"))
    made = census.features(rows, keep=["o_orderkey"])
    slots = F.transform(vector_to_array("features"), lambda x: x.cast("bigint").cast("string"))
    return made.select("o_orderkey", F.array_join(slots, ",").alias("slots"), "label")


@query("""
SELECT o_orderkey, CAST(place - 1 AS DOUBLE) AS label_index FROM orders JOIN (
  SELECT o_orderstatus, row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) AS place
  FROM orders GROUP BY o_orderstatus) USING (o_orderstatus)""")
def label_index(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    indexer = StringIndexer(inputCol="o_orderstatus", outputCol="label_index")
    return indexer.fit(orders).transform(orders).select("o_orderkey", "label_index")


@query(f"SELECT o_orderkey, {_LABEL} AS predicted_label FROM orders")
def tree_predict(spark, folder):
    return _predicted(spark, folder).select("o_orderkey", "predicted_label")


@query("""
SELECT unnest(['f1', 'accuracy']) AS metric, CAST(count(*) AS DOUBLE) / count(*) AS value FROM orders""")
def tree_metrics(spark, folder):
    """Scores of a tree that is right on every order."""
    values = trees.scores(_predicted(spark, folder).select("prediction", "indexed_label"))
    return spark.createDataFrame(list(values.items()), "metric string, value double")
