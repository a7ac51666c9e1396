import time
from datetime import timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

import test_trajectory as tt
from trackmill.operators.ordered import plain
from trackmill.operators import trajectory as tr
from trackmill.streaming.messages import pair_speeds, person_messages, show_console, start_append
from trackmill.streaming import vehicles
from trackmill.streaming.vehicles import catch_up, last_places, read_vehicle_speeds, start_known_before, with_previous
from trackmill.streaming.wordcount import REPORT_EVERY, current_counts, result_messages, split_words, start_word_counts


def in_files(spark, folder, frames):
    """One file per frame, in order of time."""
    import os

    schema = frames[0].schema
    for i, frame in enumerate(frames):
        frame.coalesce(1).write.mode("append").parquet(str(folder))
        for path in folder.glob("*.parquet"):
            if not (folder / f"{path.name}.seen").exists() and path.stat().st_mtime > 1_700_000_100:
                os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_person_messages(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text('{"name":"Ada","age":"41","sex":"female"}\n{"name":"x"}\nnot json\n')
    stream = person_messages(spark.readStream.text(str(tmp_path / "in")))
    query = start_append(stream, str(tmp_path / "cp"), sink="memory", queryName="people")
    query.awaitTermination()
    assert set(rows(spark.table("people"))) == {("Ada", "41", "female"), ("x", None, None), (None, None, None)}


def test_binary_messages(spark):
    raw = spark.createDataFrame([(bytearray(b'{"name":"a","age":"1","sex":"f"}'),)], "value binary")
    assert rows(person_messages(raw)) == [("a", "1", "f")]


def test_console(spark, tmp_path, capfd):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text('{"name":"shown"}\n')
    query = show_console(person_messages(spark.readStream.text(str(tmp_path / "in"))))
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None


def test_pair_speeds(spark):
    good = '{"lat1":"1","lon1":"2","lat2":1,"lon2":2.001,"time1":2.0001,"time2":2,"dist":86.4}'
    still = '{"lat1":1,"lon1":2,"lat2":1,"lon2":2,"time1":2,"time2":2,"dist":0}'
    df = pair_speeds(spark.createDataFrame([(good,), (still,), ("{}",)], "value string"))
    found = {r.dist: r for r in df.collect()}
    assert found[86.4].speed == pytest.approx(86.4 / 8.64) and found[86.4].distance == pytest.approx(111.178, abs=1e-2)
    assert found[0.0].speed is None and found[0.0].distance == 0
    assert found[None].speed is None


def batches(points, n):
    points = sorted(points, key=lambda p: (p[1], p[2]))
    size = -(-len(points) // n)
    return [points[i : i + size] for i in range(0, len(points), size)]


def speeds_of(spark, tmp_path, frames, **options):
    stream = in_files(spark, tmp_path / "in", frames)
    catch_up(stream, str(tmp_path / "out"), str(tmp_path / "cp"), **options)
    return read_vehicle_speeds(spark, str(tmp_path / "out"))


@pytest.mark.parametrize("n, max_rows", [(1, None), (4, 20), (7, None)])
def test_stream_equals_batch(spark, tmp_path, n, max_rows):
    points = tt.walk({"hot": 90, "a": 20, "b": 1, None: 12}, ties=0.2)
    found = speeds_of(spark, tmp_path, [spark.createDataFrame(part, tt.SCHEMA) for part in batches(points, n)], max_rows=max_rows)
    assert found.select("batch_id").distinct().count() == n
    df = tr.distance(tr.time_gap(tr.number_points(spark.createDataFrame(points, tt.SCHEMA))), "atan2")
    speed = F.when(F.col("id") > 0, F.try_divide("dist_m", "gap_s")).otherwise(0.0)
    want = plain(df).select("traj_id", "seq", "gap_s", "dist_m", speed.alias("speed"), F.lit(False).alias("late"))
    assert rows(found.select(want.columns)) == rows(want)


def test_late_points_are_kept_apart(spark, tmp_path):
    t = tt.START
    second = [
        ("a", t - timedelta(seconds=9), 1, 0.0, 0.0),
        ("a", t - timedelta(seconds=8), 2, 0.0, 0.0),
        ("a", t + timedelta(seconds=2), 6, 1.0, 2.0),
        ("a", t + timedelta(seconds=3), 8, 1.0, 2.0),
        ("b", t, 7, 3.0, 4.0),
    ]
    parts = [[("a", t, 5, 1.0, 2.0)], second, [("b", t - timedelta(seconds=1), 9, 3.0, 4.0)], [("b", t + timedelta(seconds=4), 10, 3.0, 4.0)]]
    found = {r.seq: r for r in speeds_of(spark, tmp_path, [spark.createDataFrame(p, tt.SCHEMA) for p in parts]).collect()}
    assert len(found) == 8
    assert all(found[i].late and found[i].speed is None and found[i].gap_s is None for i in (1, 2, 9))
    # the first point after late ones goes back to the last point known before
    assert (found[6].late, found[6].gap_s, found[6].speed) == (False, 2.0, 0.0)
    assert (found[8].gap_s, found[7].gap_s, found[7].speed, found[10].gap_s) == (1.0, 0.0, 0.0, 4.0)


def test_last_places_and_previous(spark):
    t = tt.START
    points = [("a", t, 1, 0.0, 0.0), ("a", t + timedelta(seconds=5), 2, 1.0, 1.0), ("b", t + timedelta(days=9), 3, 0.0, 0.0)]
    df = spark.createDataFrame(points, tt.SCHEMA)
    assert {(r.traj_id, r.last.seq) for r in last_places(df).collect()} == {("a", 2), ("b", 3)}
    assert {r.seq: r.previous and r.previous.seq for r in with_previous(df).collect()} == {1: None, 2: 1, 3: None}


@pytest.mark.parametrize("forget_after_s, gap", [(3600, 10.0), (0.001, 0.0), (None, 10.0)])
def test_idle_vehicles_are_forgotten_by_arrival(spark, tmp_path, forget_after_s, gap):
    t = tt.START
    # one vehicle's clock is a century ahead; the others are not forgotten for it
    parts = [[("a", t, 1, 0.0, 0.0), ("x", t + timedelta(days=36500), 2, 0.0, 0.0)], [("b", t, 3, 0.0, 0.0)], [("a", t + timedelta(seconds=10), 4, 0.0, 0.0)]]
    for part in parts:
        spark.createDataFrame(part, tt.SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(tt.SCHEMA).parquet(str(tmp_path / "in"))
        catch_up(stream, str(tmp_path / "out"), str(tmp_path / "cp"), forget_after_s=forget_after_s)
    last = {r.seq: r for r in read_vehicle_speeds(spark, str(tmp_path / "out")).collect()}[4]
    assert last.gap_s == gap and last.speed == 0.0


def test_repeated_batch_changes_nothing(spark, tmp_path):
    """The ends of a batch that is written again are seen a second time by the state."""
    t, out = tt.START, tmp_path / "out"
    parts = [[("a", t, 1, 0.0, 0.0)], [("a", t + timedelta(seconds=4), 2, 0.0, 0.0)]]
    speeds_of(spark, tmp_path, [spark.createDataFrame(p, tt.SCHEMA) for p in parts])
    ends = spark.read.parquet(str(out / "ends" / "batch_id=1"))
    ends.write.mode("append").parquet(str(out / "ends" / "batch_id=1"))
    stream = spark.readStream.schema(tt.SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    catch_up(stream, str(out), str(tmp_path / "cp"))
    assert {(r.seq, r.gap_s) for r in read_vehicle_speeds(spark, str(out)).collect()} == {(1, 0.0), (2, 4.0)}


def test_state_takes_rows_in_any_session(spark, tmp_path):
    """No pandas frames per vehicle; a session with another state store is left as it is."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    session, t = spark.newSession(), tt.START
    session.conf.set(provider, other)
    for i in range(2):
        part = [(f"v{v}", t + timedelta(seconds=5 * i), v, 0.0, None if v == 3 else 0.0) for v in range(50)]
        session.createDataFrame(part, tt.SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        catch_up(session.readStream.schema(tt.SCHEMA).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r.gap_s for r in read_vehicle_speeds(session, str(tmp_path / "out")).collect()) == [0.0] * 50 + [5.0] * 50
    assert session.conf.get(provider) == other
    query = start_known_before(session, str(tmp_path / "out"), str(tmp_path / "again"), T.StringType())
    query.awaitTermination()
    assert "transformWithState" in query.lastProgress["stateOperators"][0]["operatorName"]


def test_timer_lets_state_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vehicles, "ARRIVAL_DELAY", "0 seconds")
    for v in ("a", "b", "c"):
        spark.createDataFrame([(v, tt.START, 1, 0.0, 0.0)], tt.SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        catch_up(spark.readStream.schema(tt.SCHEMA).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"), forget_after_s=0.5)
        time.sleep(1)
    held = spark.read.format("statestore").option("stateVarName", "last").load(str(tmp_path / "cp" / "before"))
    assert [r.key.key for r in held.collect()] == ["c"]


def test_split_words(spark):
    df = spark.createDataFrame([("a  b ",), ("",), (None,)], "text string")
    assert rows(split_words(df, "text")) == [("a",), ("b",)]


@pytest.mark.parametrize("compact", [50, 2, 1])
def test_word_counts_over_batches(spark, tmp_path, compact):
    texts = ["a b a", "b  c", "", "a"]
    frames = [spark.createDataFrame([(t,)], "text string") for t in texts]
    stream = in_files(spark, tmp_path / "in", frames)
    out = str(tmp_path / "out")
    start_word_counts(stream, "text", out, str(tmp_path / "cp"), compact_every=compact).awaitTermination()
    counts = current_counts(spark, out)
    assert set(rows(counts)) == {("a", 3), ("b", 2), ("c", 1)}
    assert set(rows(result_messages(counts))) == {("a", "3"), ("b", "2"), ("c", "1")}
    assert REPORT_EVERY == "8 seconds"
