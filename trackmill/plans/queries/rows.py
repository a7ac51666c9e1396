"""Projections, filters, aggregates, rankings, cleaning and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from trackmill.functions.categories import codes_of, encode
from trackmill.functions.geo import haversine_m
from trackmill.functions.texts import grouped_number, is_number, split_on
from trackmill.operators import quality, relational
from trackmill.plans import employees
from trackmill.plans import lines as line_plans
from trackmill.plans.queries.base import query, table
from trackmill.sinks.writers import as_messages, report_line
from trackmill.streaming.messages import parse_messages

CENTRE_LAT, CENTRE_LON = 39.9, 116.3
EVENT_TYPES = ("click", "view", "purchase", "signup")


@query("SELECT 'spark' AS hello, c_custkey FROM customer")
def literal_hello(spark, folder):
    customers = table(spark, folder, "customer")
    return spark.sql("select 'spark' as hello, c_custkey from {customers}", customers=customers)


@query("SELECT CAST(sum(event_id) AS BIGINT) AS total FROM events")
def events_sum(spark, folder):
    return table(spark, folder, "events").agg(F.sum("event_id").alias("total"))


@query("""
SELECT round(avg(value), 6) AS mean_value, min(value) AS min_value, max(value) AS max_value, count(*) AS n
FROM events""")
def events_mean_min_max(spark, folder):
    return table(spark, folder, "events").agg(
        F.round(F.avg("value"), 6).alias("mean_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count("*").alias("n"),
    )


@query("""
SELECT count(*) FILTER (WHERE contains(line, 'a')) AS lines_with_a,
       count(*) FILTER (WHERE contains(line, 'b')) AS lines_with_b
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""")
def lines_containing(spark, folder):
    documents = table(spark, folder, "documents")
    lines = documents.select(F.explode(split_on(F.col("text"), "\n")).alias("value"))
    return line_plans.lines_with_a_and_b(lines)


@query("""
SELECT CAST(floor(o_totalprice) AS BIGINT) AS number FROM orders
WHERE o_orderstatus <> 'P' ORDER BY number DESC LIMIT 5""")
def wellformed_top5(spark, folder):
    # Orders in status P get a fifth field and so are not well-formed.
    extra = F.when(F.col("o_orderstatus") == "P", F.lit("pending"))
    fields = ["o_orderkey", "o_orderpriority", F.floor("o_totalprice"), "o_orderstatus", extra]
    lines = table(spark, folder, "orders").select(F.concat_ws(",", *fields).alias("value"))
    return line_plans.largest_numbers(lines)


@query("SELECT * FROM nation")
def select_all(spark, folder):
    return employees.all_rows(table(spark, folder, "nation"))


@query("SELECT c_name AS username, c_acctbal FROM customer")
def select_rename_subset(spark, folder):
    customers = table(spark, folder, "customer").select("c_name", "c_acctbal")
    return relational.rename(customers, c_name="username")


@query("SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 30")
def filter_compare(spark, folder):
    return table(spark, folder, "part").filter(F.col("p_size") > 30).select("p_partkey", "p_name", "p_size")


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def group_count(spark, folder):
    return table(spark, folder, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("""
SELECT CAST(quality AS VARCHAR) AS quality, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality""")
def group_count_with_null(spark, folder):
    labelled = relational.lookup(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id")
    return labelled.groupBy(F.col("quality").cast("string").alias("quality")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey")
def sort_asc(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    return customers.orderBy(F.col("c_acctbal").asc(), "c_custkey")


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 3")
def first_n(spark, folder):
    return relational.first_n(table(spark, folder, "customer"), 3, ["c_custkey"]).select("c_custkey", "c_name")


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey OFFSET 1008")
def after_first_n(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return relational.after_first_n(customers, 1008, ["c_acctbal", "c_custkey"])


@query("SELECT c_custkey, c_acctbal FROM customer")
def union_of_parts(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    order = ["c_acctbal", "c_custkey"]
    rest = relational.after_first_n(customers, 1008, order)
    return relational.stack(rest, relational.first_n(customers, 1008, order))


@query("SELECT event_id, user_id FROM events UNION ALL SELECT event_id, user_id FROM events WHERE value > 10")
def union_all(spark, folder):
    events = table(spark, folder, "events")
    large = events.filter(F.col("value") > 10)
    return relational.stack(*[df.select("event_id", "user_id") for df in (events, large)])


@query("""
SELECT event_id, substr(md5(CAST(event_id AS VARCHAR)), 1, 8) <= 'b3333333' AS in_train FROM events""")
def hash_split(spark, folder):
    train, test = relational.hash_split(table(spark, folder, "events").select("event_id"), "event_id", 0.7)
    return relational.stack(
        train.withColumn("in_train", F.lit(True)), test.withColumn("in_train", F.lit(False))
    )


@query("""
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events)
WHERE place = 1""")
def dedup_by_key(spark, folder):
    first = relational.keep_first(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"])
    return first.select("event_id", "user_id", "event_type", "value")


@query("SELECT count(DISTINCT l_partkey) AS parts FROM lineitem")
def distinct_count(spark, folder):
    return table(spark, folder, "lineitem").agg(F.countDistinct("l_partkey").alias("parts"))


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_values(spark, folder):
    return table(spark, folder, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE l_quantity * 3 + l_tax <> 0 AND abs(l_extendedprice - 3000 * l_quantity) < 3000""")
def clean_consistent(spark, folder):
    sold = F.col("l_quantity") * 3 + F.col("l_tax") != 0
    agrees = F.abs(F.col("l_extendedprice") - 3000 * F.col("l_quantity")) < 3000
    lines = table(spark, folder, "lineitem").filter(sold & agrees)
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


def _sold_by(spark, folder, key):
    # Summed per key before any join, so that the join sees one row per key.
    return relational.sum_by(table(spark, folder, "lineitem"), [key], quantity=F.col("l_quantity"))


def _sales_by_brand(spark, folder):
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    sold = _sold_by(spark, folder, "l_partkey").join(parts, "l_partkey")
    return relational.sum_by(sold, ["p_brand"], total=F.col("quantity"))


@query("""
SELECT p_brand, sum(l_quantity) AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def sales_by_key(spark, folder):
    return _sales_by_brand(spark, folder)


@query("""
SELECT *, CAST(row_number() OVER (ORDER BY total DESC, p_brand) AS INTEGER) AS place FROM (
  SELECT p_brand, sum(l_quantity) AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)
ORDER BY place LIMIT 5""")
def top_products(spark, folder):
    return relational.ranked(_sales_by_brand(spark, folder), 5, "total", ["p_brand"])


@query("""
SELECT *, CAST(row_number() OVER (ORDER BY total DESC, r_name) AS INTEGER) AS place FROM (
  SELECT r_name, sum(l_quantity) AS total FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)
ORDER BY place LIMIT 3""")
def top_regions(spark, folder):
    suppliers = table(spark, folder, "supplier")
    nations, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    sold = _sold_by(spark, folder, "l_suppkey")
    sold = sold.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    sold = sold.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    sold = sold.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    totals = relational.sum_by(sold, ["r_name"], total=F.col("quantity"))
    return relational.ranked(totals, 3, "total", ["r_name"])


def _growth(spark, folder):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    in_year = {y: F.when(F.year("o_orderdate") == y, cents).otherwise(0) for y in (1996, 1997)}
    # Bounds on the column itself, unlike its year, reach the scan.
    from_1996, to_1997 = (F.lit(f"{day} 00:00:00").cast("timestamp_ntz") for day in ("1996-01-01", "1998-01-01"))
    date = F.col("o_orderdate")
    spent = relational.sum_by(
        table(spark, folder, "orders").filter((date >= from_1996) & (date < to_1997)),
        ["o_custkey"],
        now=in_year[1997],
        last=in_year[1996],
    )
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    of_nation = spent.join(customers, "o_custkey")
    growth = relational.growth_by(of_nation, ["c_nationkey"], F.col("now"), F.col("last"), 500)
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return growth.join(nations, "c_nationkey").select("n_name", "gained", "before", "growth")


_GROWTH_SQL = """
SELECT n_name, gained, before, CAST(gained AS DOUBLE) / before AS growth FROM (
  SELECT n_name, CAST(sum(CASE WHEN year(o_orderdate) = 1997 THEN cents ELSE -cents END) AS BIGINT) AS gained,
         CAST(sum(CASE WHEN year(o_orderdate) = 1996 THEN cents ELSE 0 END) AS BIGINT) AS before
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE year(o_orderdate) IN (1996, 1997) GROUP BY n_name)
WHERE before >= 500"""


@query(_GROWTH_SQL)
def growth_by_region(spark, folder):
    return _growth(spark, folder)


@query(f"SELECT * FROM ({_GROWTH_SQL}) ORDER BY growth DESC, n_name LIMIT 1")
def fastest_growth(spark, folder):
    return relational.fastest_growth(_growth(spark, folder), ["n_name"])


@query("SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders")
def grouped_number_text(spark, folder):
    text = F.concat(F.lit('"'), F.format_number(F.floor("o_totalprice"), 0), F.lit('"'))
    orders = table(spark, folder, "orders").select("o_orderkey", text.alias("price_text"))
    return orders.select("o_orderkey", grouped_number(F.col("price_text")).alias("price"))


@query("""
SELECT event_id, CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
       WHEN 'signup' THEN 4 WHEN '?' THEN -1 END AS DOUBLE) AS code FROM events""")
def category_encode(spark, folder):
    code = encode(F.col("event_type"), codes_of(EVENT_TYPES))
    return table(spark, folder, "events").select("event_id", code.cast("double").alias("code"))


@query("""
SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def category_lookup(spark, folder):
    codes = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return relational.lookup(customers, codes, "c_nationkey").select("c_custkey", "n_name")


@query("""
SELECT doc_id, concat_ws(',', CASE WHEN lang IN ('en', 'fr', 'de') THEN NULL ELSE 'lang' END,
       CASE WHEN n_chars >= 200 THEN NULL ELSE 'length' END,
       CASE WHEN quality IS NOT NULL THEN NULL ELSE 'quality' END,
       CASE WHEN TRY_CAST(substr(source, 4) AS DOUBLE) IS NOT NULL THEN NULL ELSE 'source' END) AS violations
FROM documents LEFT JOIN labels USING (doc_id)
WHERE lang NOT IN ('en', 'fr', 'de') OR n_chars < 200 OR quality IS NULL
   OR TRY_CAST(substr(source, 4) AS DOUBLE) IS NULL""")
def dq_violations(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    labelled = relational.lookup(documents, table(spark, folder, "labels"), "doc_id")
    rules = {
        "lang": quality.in_domain(F.col("lang"), ["en", "fr", "de"]),
        "length": F.col("n_chars") >= 200,
        "quality": F.col("quality").isNotNull(),
        "source": is_number(F.expr("substr(source, 4)")),
    }
    faulty = quality.invalid_rows(labelled, rules)
    return faulty.select("doc_id", F.concat_ws(",", "violations").alias("violations"))


@query("SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR toxic IS NULL")
def dq_incomplete(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id")
    labelled = relational.lookup(documents, table(spark, folder, "labels"), "doc_id")
    return quality.incomplete_rows(labelled).select("doc_id")


@query("""
SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)
WHERE quality IS NOT NULL AND toxic IS NOT NULL AND lang IS NOT NULL""")
def dq_complete(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    return quality.complete_rows(relational.lookup(documents, table(spark, folder, "labels"), "doc_id"))


@query("""
SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
FROM documents LEFT JOIN labels USING (doc_id)""")
def fill_nulls(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id")
    labelled = relational.lookup(documents, table(spark, folder, "labels"), "doc_id")
    return relational.fill_zero(labelled, "quality", "toxic")


@query("""
SELECT c_custkey, 'id:' || c_custkey || ',name:' || c_name || ',nation:' || c_nationkey AS line FROM customer""")
def report_lines(spark, folder):
    line = report_line("id:%d,name:%s,nation:%d", "c_custkey", "c_name", "c_nationkey")
    return table(spark, folder, "customer").select("c_custkey", line.alias("line"))


@query("SELECT event_id, CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS BIGINT) AS k FROM events")
def json_parse(spark, folder):
    schema = StructType([StructField("k", LongType())])
    events = table(spark, folder, "events").select("event_id", F.from_json("props", schema).alias("data"))
    return events.select("event_id", "data.*")


@query("""
SELECT CAST(event_id AS VARCHAR) AS key, '{"event_id":' || event_id || ',"user_id":' || user_id
       || ',"event_type":"' || event_type || '"}' AS value FROM events""")
def json_emit(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return as_messages(events, F.col("event_id"))


@query("""
SELECT event_id, user_id, event_type FROM events""")
def json_messages(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return parse_messages(as_messages(events), events.schema)


_HERE = "39.9 + value / 10000"
_THERE = "116.3 + CAST(event_id % 100 AS DOUBLE) / 10000"


def _distance(spark, folder, mode):
    lat = F.lit(CENTRE_LAT) + F.col("value") / 10000
    lon = F.lit(CENTRE_LON) + (F.col("event_id") % 100).cast("double") / 10000
    metres = haversine_m(F.lit(CENTRE_LAT), F.lit(CENTRE_LON), lat, lon, mode)
    return table(spark, folder, "events").select("event_id", F.round(metres, 6).alias("metres"))


@query(f"""
SELECT event_id, round(2 * asin(sqrt(pow(sin(abs(lat2 - lat1) / 2), 2)
       + cos(lat1) * cos(lat2) * pow(sin(abs(lon2 - lon1) / 2), 2))) * 6371393, 6) AS metres
FROM (SELECT event_id, 39.9::DOUBLE * 3.1415926 / 180 AS lat1, 116.3::DOUBLE * 3.1415926 / 180 AS lon1,
             ({_HERE}) * 3.1415926 / 180 AS lat2, ({_THERE}) * 3.1415926 / 180 AS lon2 FROM events)""")
def haversine_asin(spark, folder):
    return _distance(spark, folder, "asin")


@query(f"""
SELECT event_id, round(6371 * 2 * atan2(sqrt(a), sqrt(1 - a)) * 1000, 6) AS metres
FROM (SELECT event_id, pow(sin((lat2 - 39.9) * pi() / 360), 2) + cos(39.9 * pi() / 180)
             * cos(lat2 * pi() / 180) * pow(sin((lon2 - 116.3) * pi() / 360), 2) AS a
      FROM (SELECT event_id, {_HERE} AS lat2, {_THERE} AS lon2 FROM events))""")
def haversine_atan2(spark, folder):
    return _distance(spark, folder, "atan2")


@query("""
SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def sql_view(spark, folder):
    table(spark, folder, "region").createOrReplaceTempView("region_view")
    return employees.query_view(
        table(spark, folder, "nation"),
        "nation_view",
        "select r_name, count(*) as nations from nation_view join region_view"
        " on n_regionkey = r_regionkey group by r_name",
    )
