import math
import random

import brute
import pytest
from pyspark.sql import functions as F

from trackmill.functions.categories import CENSUS_CATEGORIES, codes_of, encode
from trackmill.functions.geo import haversine_m
from trackmill.functions.texts import grouped_number, has_fields, is_number, without_trailing_dot
from trackmill.functions.times import day_serial, day_serial_gap, seconds_between, timestamp_from


def column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def atan2_metres(lat1, lon1, lat2, lon2):
    d_lat, d_lon = math.radians(lat2 - lat1), math.radians(lon2 - lon1)
    a = math.sin(d_lat / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(d_lon / 2) ** 2
    return 6371 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a)) * 1000


@pytest.mark.parametrize("mode, plain", [("asin", brute.metres), ("atan2", atan2_metres)])
def test_haversine(spark, mode, plain):
    rng = random.Random(5)
    pairs = [tuple(rng.uniform(-80, 80) for _ in range(4)) for _ in range(200)] + [(1.0, 2.0, 1.0, 2.0)]
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    metres = haversine_m(F.col("a"), F.col("b"), F.col("c"), F.col("d"), mode)
    for row in df.withColumn("m", metres).collect():
        assert row.m == pytest.approx(plain(*row[:4]), rel=1e-9, abs=1e-6)
    missing = spark.createDataFrame([(None, 1.0, 1.0, 1.0)], df.schema)
    assert missing.select(metres).first()[0] is None


def test_haversine_mode(spark):
    with pytest.raises(ValueError):
        haversine_m(F.lit(0), F.lit(0), F.lit(0), F.lit(0), "flat")


def test_times(spark):
    df = spark.createDataFrame([("2008-10-23", "02:53:10", "02:53:16.5"), ("x", "", "")], "d string, a string, b string")
    good = df.select(timestamp_from(F.col("d"), F.col("a")).alias("a"), F.col("b")).orderBy(F.col("a").desc_nulls_last())
    assert [r.a is None for r in good.collect()] == [False, True]
    pair = spark.sql("select timestamp'2024-01-01 00:00:00.000001' a, timestamp'2024-01-01 00:00:02.5' b")
    assert pair.select(seconds_between(F.col("b"), F.col("a"))).first()[0] == 2.499999
    noon = spark.sql("select timestamp'1899-12-30 12:00:00' t")
    assert noon.select(day_serial(F.col("t"))).first()[0] == 0.5
    assert pair.select(day_serial_gap(F.lit("2.5"), F.lit("2"))).first()[0] == 43200
    assert pair.select(day_serial_gap(F.lit("x"), F.lit("2"))).first()[0] is None


def test_grouped_number(spark):
    texts = ['"1,170"', "12", "1,234,567", "-5", "", "a", "1.5", None, '"2,600"']
    assert column(spark, texts, "string", grouped_number) == [1170, 12, 1234567, -5, None, None, None, None, 2600]


def test_is_number(spark):
    texts = ["1", "1.5", "1e3", "nan", "inf", " 7 ", "?", "", "1d", "2.0f", "0x1p3", "1_000", "½", None]
    found = column(spark, texts, "string", is_number)
    assert [bool(v) for v in found] == [True] * 6 + [False] * 8


def test_lines(spark):
    lines = ["a,b,c,d", "a,b,c", "a,b,c,d,e", "   ", "", ",,,", None]
    assert [bool(v) for v in column(spark, lines, "string", lambda c: has_fields(c, 4))] == [
        True, False, False, False, False, True, False,
    ]
    assert column(spark, [">50K.", ">50K", "."], "string", without_trailing_dot) == [">50K", ">50K", ""]


def test_codes(spark):
    codes = codes_of(CENSUS_CATEGORIES["sex"])
    assert codes == {"Female": 1, "Male": 2, "?": -1}
    assert column(spark, ["Male", "?", "male", None], "string", lambda c: encode(c, codes)) == [2, -1, None, None]
    sizes = {name: len(values) for name, values in CENSUS_CATEGORIES.items()}
    assert sizes == {
        "workclass": 8, "education": 16, "marital_status": 7, "occupation": 14,
        "relationship": 6, "race": 5, "sex": 2, "native_country": 41,
    }
