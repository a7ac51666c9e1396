"""The jobs' own functions over the given tables, their columns mapped onto the jobs' names."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackmill.operators import trajectory as tr
from trackmill.plans import employees, sales
from trackmill.plans.queries.base import query, table
from trackmill.plans.queries.tracks import _FLAGS, _INTERVALS, _ROUND_5, _analysed
from trackmill.schemas import SALES

_SALES = """
raw AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS q, 'P' || l_partkey % 40 AS product,
               'R' || l_suppkey % 7 AS region FROM lineitem),
sales AS (SELECT CAST(l_linenumber AS INTEGER) AS code, product, region, q // 3 AS avg3, q % 7 AS w1, q % 11 AS w2, q % 5 AS w3,
                 q % 2 AS forecast, q + 5 AS last_year FROM raw),
clean AS (SELECT * FROM sales WHERE avg3 * 3 + forecast <> 0 AND abs(w1 + w2 + w3 - 3 * avg3) < 3),
growth AS (SELECT region, CAST(sum(4 * avg3 - last_year) AS BIGINT) AS gained, CAST(sum(last_year) AS BIGINT) AS before,
                  sum(4 * avg3 - last_year) / sum(last_year) AS growth FROM sales GROUP BY region HAVING sum(last_year) >= 500)"""


def _sales(spark, folder):
    quantity = F.col("l_quantity").cast("int")
    columns = {
        "code": F.col("l_linenumber"),
        "product": F.concat(F.lit("P"), (F.col("l_partkey") % 40).cast("string")),
        "region": F.concat(F.lit("R"), (F.col("l_suppkey") % 7).cast("string")),
        "avg3": F.floor(quantity / 3),
        "w1": quantity % 7,
        "w2": quantity % 11,
        "w3": quantity % 5,
        "forecast": quantity % 2,
        "last_year": quantity + 5,
    }
    return table(spark, folder, "lineitem").select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in SALES])


@query(f"WITH {_SALES} SELECT * FROM clean")
def sales_clean(spark, folder):
    return sales.clean(_sales(spark, folder))


@query(f"WITH {_SALES} SELECT count(DISTINCT product) AS products FROM clean")
def sales_products(spark, folder):
    return sales.product_count(sales.clean(_sales(spark, folder)))


@query(f"""
WITH {_SALES}, t AS (SELECT product, CAST(sum(w1 + w2 + w3) AS BIGINT) AS total FROM clean GROUP BY product)
SELECT product || ',' || total || ',' || row_number() OVER (ORDER BY total DESC, product) AS line FROM t
QUALIFY row_number() OVER (ORDER BY total DESC, product) <= 5""")
def sales_best_products(spark, folder):
    """Report lines of the best sellers: product, total and place."""
    best = sales.best_sellers(sales.clean(_sales(spark, folder)), "product", 5)
    return sales.report(best, ["product", "total", "place"])


@query(f"""
WITH {_SALES}, t AS (SELECT region, CAST(sum(w1 + w2 + w3) AS BIGINT) AS total FROM clean GROUP BY region)
SELECT region || ',' || total AS line FROM t""")
def sales_by_region(spark, folder):
    return sales.report(sales.totals_by(sales.clean(_sales(spark, folder)), "region"), ["region", "total"])


@query(f"WITH {_SALES} SELECT * FROM growth")
def sales_growth(spark, folder):
    return sales.growth_by_region(_sales(spark, folder))


@query(f"WITH {_SALES} SELECT * FROM growth ORDER BY growth DESC, region LIMIT 1")
def sales_fastest_region(spark, folder):
    return sales.fastest_growing_region(_sales(spark, folder))


@query(f"WITH {_SALES} SELECT * FROM sales")
def sales_from_text(spark, folder):
    """Numbers written with quotes and thousands marks, read back as numbers."""
    numbers = _sales(spark, folder)
    text = numbers.select(
        *[c if c in ("product", "region") else F.concat(F.lit('"'), F.format_number(c, 0), F.lit('"')).alias(c) for c in numbers.columns]
    )
    made = sales.numbers_from_text(text)
    return made.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SALES])


_EMPLOYEES = """
emp AS (SELECT c_custkey // 2 AS id, c_name AS name, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) + 20 END AS age FROM customer)"""


def _employees(spark, folder):
    age = F.when(F.col("c_custkey") % 11 != 0, F.col("c_nationkey").cast("bigint") + 20)
    key = F.floor(F.col("c_custkey") / 2)
    return table(spark, folder, "customer").select(key.alias("id"), F.col("c_name").alias("name"), age.alias("age"))


@query(f"WITH {_EMPLOYEES} SELECT id, name, CAST(age AS VARCHAR) AS age FROM emp QUALIFY row_number() OVER (PARTITION BY id ORDER BY name, age NULLS FIRST) = 1")
def employees_one_per_id(spark, folder):
    return employees.one_per_id(_employees(spark, folder)).withColumn("age", F.col("age").cast("string"))


@query(f"WITH {_EMPLOYEES} SELECT name, age FROM emp WHERE age > 30")
def employees_older(spark, folder):
    return employees.without_id(employees.older_than(_employees(spark, folder)))


@query(f"WITH {_EMPLOYEES} SELECT CAST(age AS VARCHAR) AS age, count(*) AS \"count\" FROM emp GROUP BY ALL")
def employees_by_age(spark, folder):
    counts = employees.count_by_age(_employees(spark, folder))
    return counts.withColumn("age", F.col("age").cast("string"))


@query(f"WITH {_EMPLOYEES} SELECT name AS username FROM emp ORDER BY name")
def employees_user_names(spark, folder):
    return employees.user_names(employees.by_name(_employees(spark, folder)))


@query(f"WITH {_EMPLOYEES} SELECT round(avg(age), 6) AS mean_age FROM emp")
def employees_mean_age(spark, folder):
    return employees.mean_age(_employees(spark, folder)).select(F.round("mean_age", 6).alias("mean_age"))


@query(f"WITH {_EMPLOYEES} SELECT min(age) AS min_age FROM emp")
def employees_least_age(spark, folder):
    return employees.least_age(_employees(spark, folder))


@query(f"WITH {_EMPLOYEES} SELECT 'id:' || id || ',name:' || name || ',age:' || coalesce(CAST(age AS VARCHAR), 'null') AS line FROM emp")
def employees_report(spark, folder):
    return employees.report(_employees(spark, folder))


@query(f"""
WITH {_EMPLOYEES} SELECT id, name, CAST(age AS VARCHAR) AS age FROM (
  SELECT * FROM emp QUALIFY row_number() OVER (PARTITION BY id ORDER BY name, age NULLS FIRST) = 1) ORDER BY id LIMIT 3""")
def employees_first_rows(spark, folder):
    first = employees.first_rows(employees.one_per_id(_employees(spark, folder)))
    return first.withColumn("age", F.col("age").cast("string"))


# The speed at the end of a line is compared as a number: engines write small ones differently.
def _head():
    return F.regexp_replace("line", ",速度为[^,]*m/s$", "").alias("head")


@query(f"""
WITH {_FLAGS} SELECT traj_id, id, '第' || id || '个轨迹点,为车辆停留点,时刻为' || CAST(ts AS VARCHAR) AS head, {_ROUND_5} AS speed
FROM stp WHERE stop = 1""")
def traj_stop_lines(spark, folder):
    return tr.stop_list(_analysed(spark, folder)).select("traj_id", "id", _head(), "speed")


@query(f"""
WITH {_INTERVALS} SELECT traj_id, id, '第' || id || '个轨迹点,处于第' || range_index || '个区间,该区间为'
       || CASE WHEN speed_up THEN '加速' ELSE '减速' END || '区间,时刻为' || CAST(ts AS VARCHAR) AS head, {_ROUND_5} AS speed
FROM itv WHERE range_index <> 0 AND (speed_up OR speed_down)""")
def traj_interval_lines(spark, folder):
    rows = tr.interval_list(tr.intervals(_analysed(spark, folder)))
    return rows.select("traj_id", "id", _head(), "speed")
