"""Aggregates in the reader, JSON of unknown shape, repeated loads, observed metrics and the continuous trigger."""

import json
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trackmill.operators.quality import read_quarantined, write_quarantined
from trackmill.sinks.writers import write_loads
from trackmill.sources import files
from trackmill.streaming.messages import start_continuous


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_aggregates_come_from_the_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2.5, "a"), (None, -1.0, "b"), (7, None, None)], "k long, v double, s string").repartition(2).write.parquet(path)
    found = files.source_aggregates(spark, path, ["k", "v"])
    assert rows(found) == [(3, 2, 1, 7, 2, -1.0, 2.5)]
    plan = plan_of(found)
    assert "PushedAggregation: [COUNT(*), COUNT(k), MIN(k), MAX(k), COUNT(v), MIN(v), MAX(v)]" in plan
    assert "ReadSchema: struct<count(*)" in plan  # no column of the table
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_aggregates_of_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([], "k long").write.parquet(path)
    assert rows(files.source_aggregates(spark, path, ["k"])) == [(0, 0, None, None)]


def test_variant(spark):
    texts = ['{"a": 1, "b": "x"}', '{"a": 2.5, "c": [1, "y"]}', '{"b": {"deep": true}}', "not json", None, "7", '{"a": "text"}']
    df = files.parse_variant(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), "t")
    objects = df.filter("i < 2")
    assert files.variant_schema(objects) == "OBJECT<a: DECIMAL(21,1), b: STRING, c: ARRAY<VARIANT>>"
    found = {r.i: (r.a, r.b) for r in files.variant_columns(df, {"a": "double", "b": "string"}).collect()}
    assert found[0] == (1.0, "x") and found[1] == (2.5, None) and found[3] == found[4] == found[5] == (None, None)
    assert found[6][0] is None
    assert files.variant_schema(df.limit(0)) == "VOID"


def test_repeated_loads_add_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "load int, v string"
    first = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], schema)
    write_loads(first, path, "load")
    write_loads(first.filter("load = 1"), path, "load")
    write_loads(spark.createDataFrame([(3, "d"), (None, "e")], schema), path, "load")
    write_loads(spark.createDataFrame([(2, "C"), (2, "cc")], schema), path, "load")
    write_loads(first.limit(0), path, "load")
    found = rows(spark.read.schema(first.schema).parquet(path).select("load", "v"))
    assert found == [(None, "e"), (1, "a"), (1, "b"), (2, "C"), (2, "cc"), (3, "d")]


def test_failed_load_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_loads(spark.createDataFrame([(1, "a")], "load int, v string"), path, "load")
    broken = spark.createDataFrame([(1, "x"), (1, "y")], "load int, v string").withColumn("v", F.when(F.col("v") == "y", F.raise_error(F.lit("no"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no"):
        write_loads(broken, path, "load")
    assert [r.v for r in spark.read.parquet(path).collect()] == ["a"]


def test_quarantine_counts_equal_what_is_written(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (200, "zz"), (5, None)], "n int, s string")
    rules = {"n": F.col("n") < 100, "s": F.length("s") == 1}
    seen = write_quarantined(df, rules, str(tmp_path / "q"))
    assert seen == {"rows": 4, "bad_rows": 3, "n": 2, "s": 2}
    back = read_quarantined(spark, str(tmp_path / "q"), df.schema)
    assert rows(back.filter("ok").select("n", "s")) == [(1, "a")]
    assert {(r.n, tuple(r.violations)) for r in back.filter("NOT ok").collect()} == {(None, ("n",)), (200, ("n", "s")), (5, ("s",))}
    assert "PartitionFilters: [isnotnull(ok" in plan_of(back.filter("ok"))
    assert write_quarantined(df.limit(0), rules, str(tmp_path / "none")) == {"rows": 0, "bad_rows": 0, "n": 0, "s": 0}


def test_continuous_trigger_goes_on_after_a_restart(spark, tmp_path):
    checkpoint = tmp_path / "cp"

    def kept():
        offsets = checkpoint / "offsets"
        found = sorted((int(p.name) for p in offsets.glob("[0-9]*")), reverse=True) if offsets.exists() else []
        commits = {p.name for p in (checkpoint / "commits").glob("[0-9]*")}
        done = [n for n in found if str(n) in commits]
        return (done[0], json.loads((offsets / str(done[0])).read_text().splitlines()[-1])) if done else (-1, None)

    def run(least):
        stream = spark.readStream.format("rate").option("rowsPerSecond", 20).option("numPartitions", 2).load()
        query = start_continuous(stream.filter("value >= 0"), str(checkpoint), commit_every="200 milliseconds")
        deadline = time.monotonic() + 40
        while kept()[0] < least and time.monotonic() < deadline:
            time.sleep(0.2)
        query.stop()
        assert query.exception() is None
        return kept()

    first, at = run(2)
    second, later = run(first + 2)
    assert first >= 2 and second > first
    assert sum(v["value"] for v in later.values()) > sum(v["value"] for v in at.values())
