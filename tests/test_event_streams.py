"""Streams in event time: what is emitted, what is late, and that state stays bounded."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trackmill.streaming.events import distinct_messages, live_pairs, stop_episodes, word_windows
from trackmill.streaming.messages import start_append

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def run(spark, tmp_path, schema, batches, work):
    """One run of the query per batch; the rows written and the progress of all runs."""
    progress = []
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = work(spark.readStream.schema(spark.createDataFrame([], schema).schema).parquet(str(tmp_path / "in")))
        query = start_append(stream, str(tmp_path / "cp"), str(tmp_path / "out"))
        query.awaitTermination()
        progress += query.recentProgress
    return spark.read.parquet(str(tmp_path / "out")), progress


def dropped(progress):
    return sum(int(o.numRowsDroppedByWatermark) for p in progress for o in p.stateOperators)


def test_word_windows(spark, tmp_path):
    batches = [
        [(at(1), "a b a"), (at(9), "a"), (None, "nowhere"), (at(2), None)],
        [(at(3), "b  b"), (at(100), "far")],  # late, but in time: nothing was closed by 9 - 10 s
        [(at(4), "too late"), (at(101), "x"), (at(300), "end")],
    ]
    found, progress = run(spark, tmp_path, "ts timestamp, text string", batches, lambda s: word_windows(s, "text", "ts", "8 seconds", "10 seconds"))
    got = {(r.start, r.word): r["count"] for r in found.collect()}
    assert got == {(at(0), "a"): 2, (at(0), "b"): 3, (at(8), "a"): 1, (at(96), "far"): 1, (at(96), "x"): 1}
    assert all(r.end - r.start == timedelta(seconds=8) for r in found.collect())
    assert dropped(progress) > 0
    # only the windows that may still change are held
    assert progress[-1].stateOperators[0].numRowsTotal in (1, 0, -1)


def test_distinct_messages(spark, tmp_path):
    first = [(1, at(0), "x"), (2, at(5), "y"), (1, at(0), "x")]
    batches = [first, [*first, (3, at(20), "z")], [(2, at(5), "y"), (4, at(21), "x"), (5, None, "no time")]]
    found, _ = run(spark, tmp_path, "id long, ts timestamp, body string", batches, lambda s: distinct_messages(s, ["id"], "ts", "30 seconds"))
    assert rows(found.select("id", "body")) == [(1, "x"), (2, "y"), (3, "z"), (4, "x")]


@pytest.mark.parametrize("key", ["v", None])
def test_live_pairs(spark, tmp_path, key):
    schema = "traj_id string, id long, ts timestamp, lat double, lon double"
    batches = [
        [(key, 0, at(0), 1.0, 2.0), ("w", 0, at(0), 1.0, 2.0)],
        [(key, 2, at(20), 1.0, 2.0)],  # its older neighbour comes a batch later
        [(key, 1, at(10), 1.0, 2.0), (key, 3, at(20), 1.0, 2.0), ("w", 1, at(5000), 1.0, 2.0)],
    ]
    found, _ = run(spark, tmp_path, schema, batches, lambda s: live_pairs(s, "1 HOUR", "1 hour"))
    got = {(r.traj_id, r.id): (r.time_diff, r.dist, r.speed) for r in found.collect()}
    assert got == {(key, 1): (10.0, 0.0, 0.0), (key, 2): (10.0, 0.0, 0.0), (key, 3): (0.0, 0.0, None)}


def test_live_pairs_state_is_bounded(spark, tmp_path):
    schema = "traj_id string, id long, ts timestamp, lat double, lon double"
    batches = [[("v", i, at(60 * i), 1.0, 2.0) for i in range(n, n + 50)] for n in (0, 50, 100)]
    found, progress = run(spark, tmp_path, schema, batches, lambda s: live_pairs(s, "2 MINUTES", "1 minute"))
    assert found.count() == 149
    states = [o for p in progress for o in p.stateOperators]
    assert states and sum(int(o.numRowsRemoved) for o in states) > 200


def test_stop_episodes(spark, tmp_path):
    schema = "traj_id string, ts timestamp, speed double"
    batches = [
        [("v", at(0), 0.1), ("v", at(50), 0.3), ("v", at(60), 9.0), ("v", at(140), 0.0), ("w", at(0), None)],
        [("v", at(95), 0.2), ("w", at(150), 0.1)],  # late: makes one episode of two
        [("v", at(1000), 0.1), ("w", at(1000), 0.4)],
    ]
    found, _ = run(spark, tmp_path, schema, batches, lambda s: stop_episodes(s, "60 seconds", late="5 minutes"))
    assert rows(found.select("traj_id", "first", "last", "points", "top_speed")) == [
        ("v", at(0), at(140), 4, 0.3),
        ("w", at(150), at(150), 1, 0.1),
    ]
    assert [r.closed for r in found.filter("traj_id = 'v'").collect()] == [at(200)]


def test_plans_keep_state_by_event_time(spark):
    stream = spark.readStream.format("rate").load().select(F.col("timestamp").alias("ts"), F.lit("a b").alias("text"), F.lit("v").alias("traj_id"), F.col("value").cast("double").alias("speed"))
    for made in (word_windows(stream, "text", "ts"), stop_episodes(stream, "1 minute")):
        assert "EventTimeWatermark" in made._jdf.queryExecution().analyzed().toString()
