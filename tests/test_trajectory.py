import random
from datetime import datetime, timedelta

import brute
import pytest
from conftest import rows
from pyspark.sql import functions as F

from trackmill.operators import trajectory as tr
from trackmill.operators.ordered import is_cut, number_rows, plain, running_sum
from trackmill.plans.traffic import pair_messages
from trackmill.plans.trajectories import analyse_files
from trackmill.sources.files import read_plt
from trackmill.streaming.messages import pair_speeds

SCHEMA = "traj_id string, ts timestamp, seq long, lat double, lon double"
START = datetime(2024, 1, 1)


def walk(sizes, seed=1, ties=0.2):
    """Random walks with equal timestamps, standstills and equal steps among them."""
    rng, made, seq = random.Random(seed), [], 0
    for key, n in sizes.items():
        ts, lat, lon = START, 39.9, 116.3
        for _ in range(n):
            seq += 1
            ts += timedelta(seconds=0 if rng.random() < ties else rng.choice([1, 2, 5]))
            step = rng.choice([0, 0, 1e-5, 1e-4, 3e-4])
            lat, lon = lat + step, lon + rng.choice([0, step])
            made.append((key, ts, seq, lat, lon))
    rng.shuffle(made)
    return made


def expected(points, digits=6, swap=False):
    by_key = {}
    for key, *rest in points:
        by_key.setdefault(key, []).append(tuple(rest))
    return {key: brute.analyse(group, digits, swap) for key, group in by_key.items()}


# One trajectory holds most rows; some are too short to have an inner point.
SIZES = {"hot": 150, "a": 40, "b": 2, "c": 1, "d": 3, None: 25}


@pytest.mark.parametrize("max_rows, ties", [(None, 0.3), (1000, 0.9), (40, 0.3), (9, 0.9)])
def test_same_as_plain_python(spark, max_rows, ties):
    points = walk(SIZES, ties=ties)
    df = tr.analyse(spark.createDataFrame(points, SCHEMA), digits=6, max_rows=max_rows)
    assert is_cut(df) == (max_rows is not None and max_rows < 150)
    want = expected(points)
    flat = [(k, r) for k, group in want.items() for r in group]
    found = plain(df)
    names = ["traj_id", "seq", "id", "gap_s", "speed", "stop", "direct", "is_change", "in_range"]
    names += ["speed_up", "speed_down", "is_last"]
    got = {(r.traj_id, r.seq): r for r in found.select(*names, "acceleration").collect()}
    assert len(got) == len(flat)
    for key, r in flat:
        row = got[key, r["seq"]]
        assert row.id == r["id"] and row.gap_s == r["gap"] and row.stop == r["stop"]
        assert row.speed == pytest.approx(r["speed"], abs=2e-6) if r["speed"] is not None else row.speed is None
        assert (row.acceleration is None) == (r["acc"] is None)
        assert (row.speed_up or False, row.speed_down or False) == (r["up"], r["down"])
        assert (row.direct, row.is_change, row.in_range) == (r["direct"], r["change"], r["in_range"])
        assert row.is_last == (r["id"] == len(want[key]) - 1)
    listed = rows(tr.intervals(df).select("traj_id", "seq", "range_index"))
    assert listed == sorted(
        ((k, *pair) for k, group in want.items() for pair in brute.intervals(group)),
        key=lambda r: [(v is not None, str(type(v)), v) for v in r],
    )
    for least in (2, 3):
        members = tr.runs(df, min_len=least).select("traj_id", "seq", "run_value", "run_no", "run_len", "member_no")
        want_runs = [(k, *m) for k, group in want.items() for m in brute.runs(group, least)]
        assert rows(members) == sorted(want_runs, key=lambda r: [(v is not None, str(type(v)), v) for v in r])


@pytest.mark.parametrize("max_rows", [None, 10])
def test_swapped_axes(spark, max_rows):
    points = walk({"a": 50}, ties=0)
    df = tr.analyse(spark.createDataFrame(points, SCHEMA), digits=6, swap_axes=True, max_rows=max_rows)
    want = {r["seq"]: r["speed"] for r in expected(points, swap=True)["a"]}
    assert {r.seq: r.speed for r in plain(df).collect()} == pytest.approx(want, abs=2e-6)


def test_all_points_at_one_time(spark):
    points = [("a", START, i, 39.9, 116.3) for i in range(60)] + [("b", START, 99, 1.0, 1.0)]
    df = tr.analyse(spark.createDataFrame(points, SCHEMA), max_rows=8)
    found = plain(df)
    assert found.filter("traj_id = 'a'").count() == 60
    assert found.filter("speed is null").count() == 58
    assert tr.runs(df).count() == 0


def test_empty(spark):
    df = tr.analyse(spark.createDataFrame([], SCHEMA))
    assert plain(df).count() == tr.intervals(df).count() == tr.runs(df).count() == 0


def test_partitions_do_not_matter(spark):
    points = spark.createDataFrame(walk(SIZES), SCHEMA)
    once = rows(tr.runs(tr.analyse(points, digits=6)).select("seq", "run_no", "run_len"))
    again = tr.analyse(points.repartition(13), digits=6, max_rows=20)
    assert rows(tr.runs(again).select("seq", "run_no", "run_len")) == once


def test_a_trajectory_alone(spark):
    points = spark.createDataFrame(walk(SIZES), SCHEMA)
    together = plain(tr.analyse(points, digits=6)).filter("traj_id = 'a'")
    alone = plain(tr.analyse(points.filter("traj_id = 'a'"), digits=6))
    names = ["seq", "id", "speed", "in_range"]
    assert rows(together.select(names)) == rows(alone.select(names))
    assert together.filter("speed_up and speed_down").count() == 0


@pytest.mark.parametrize("max_rows", [None, 4])
def test_running_sum_takes_ties_together(spark, max_rows):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.choice([1, 2, 2, 2, 2, 3, 9]), i, rng.randint(0, 1)) for i in range(120)]
    df = number_rows(spark.createDataFrame(data, "k string, t int, s int, v int"), "k", ["t", "s"], max_rows=max_rows)
    got = plain(running_sum(df, "total", F.col("v"), "k", "t")).select("s", "total")
    want = [(s, sum(v2 for k2, t2, _, v2 in data if k2 == k and t2 <= t)) for k, t, s, _ in data]
    assert rows(got) == sorted(want)


def test_summary_and_reports(spark):
    points = spark.createDataFrame(walk({"a": 80}, ties=0), SCHEMA)
    df = tr.analyse(points, digits=6)
    members = tr.runs(df)
    summary = tr.run_summary(members)
    assert summary.agg(F.sum("n_points")).first()[0] == members.count()
    row = summary.orderBy("run_start").first()
    of_run = members.filter((F.col("run_start") == row.run_start)).agg(F.min("ts"), F.max("ts"), F.max("speed")).first()
    assert (row.start_ts, row.end_ts, row.max_speed) == tuple(of_run)
    stop = tr.stop_list(df).orderBy("id").first()
    assert stop.line == f"第{stop.id}个轨迹点,为车辆停留点,时刻为{stop.ts},速度为{stop.speed}m/s"
    listed = tr.interval_list(tr.intervals(df))
    assert {r.label for r in listed.select("label").distinct().collect()} <= {tr.UP_LABEL, tr.DOWN_LABEL}
    one = listed.orderBy("id").first()
    assert one.line.startswith(f"第{one.id}个轨迹点,处于第{one.range_index}个区间,该区间为{one.label}区间")


def test_slow_points(spark):
    points = spark.createDataFrame(walk({"a": 20}, ties=0), SCHEMA)
    df = plain(tr.slow_points(tr.analyse(points)))
    assert df.filter("slow != (speed < 0.4)").count() == 0


# rows, stops, changes, in range, up, down, max speed, mean speed, interval points, intervals,
# accelerating runs and the longest, decelerating runs and the longest
@pytest.fixture(scope="module")
def tracks(tmp_path_factory):
    """PLT files of made-up walks, and their points by path."""
    folder, by_path = tmp_path_factory.mktemp("tracks"), {}
    points = walk({"u1/a": 150, "u1/b": 40, "u2/a": 90, "u3/only": 1}, seed=5)
    for key in sorted({p[0] for p in points}):
        path = folder / f"{key}.plt"
        path.parent.mkdir(exist_ok=True)
        own = sorted(p[1:] for p in points if p[0] == key)
        lines = ["Track file", "WGS 84", "Altitude in feet", "Reserved", "0,2,255,track,0,0,2,8421376", "0"]
        for ts, _, lat, lon in own:
            serial = (ts - datetime(1899, 12, 30)) / timedelta(days=1)
            lines.append(f"{lat!r},{lon!r},0,-777,{serial!r},{ts:%Y-%m-%d},{ts:%H:%M:%S}")
        path.write_text("\n".join(lines) + "\n")
        by_path[f"file:{path}"] = own
    return str(folder / "*"), by_path


def counted(points, swap=False):
    """What the golden test counts, by plain Python."""
    made = brute.analyse(points, 6, swap)
    flags = [sum(r[name] for r in made) for name in ("stop", "change", "in_range", "up", "down")]
    speeds = [r["speed"] for r in made if r["speed"] is not None]
    return (len(made), *flags, round(max(speeds), 6), round(sum(speeds) / len(speeds), 6))


@pytest.mark.parametrize("max_rows", [None, 40])
def test_golden_files(spark, tracks, max_rows):
    folder, by_path = tracks
    df = tr.analyse(read_plt(spark, folder), max_rows=max_rows, digits=6)
    found = plain(df).groupBy("traj_id").agg(
        F.count("*"), F.sum("stop"), F.sum("is_change"), F.count_if("in_range"), F.count_if("speed_up"),
        F.count_if("speed_down"), F.round(F.max("speed"), 6), F.round(F.avg("speed"), 6),
    )
    assert {r[0].replace("file://", "file:"): pytest.approx(tuple(r)[1:], abs=1e-5) for r in found.collect()} == {
        path: counted(points) for path, points in by_path.items()
    }


def test_whole_job(spark, tracks, tmp_path):
    folder, by_path = tracks
    analyse_files(spark, folder, str(tmp_path / "out"), max_rows=40)
    n_points = sum(map(len, by_path.values()))

    def read(name):
        return spark.read.option("header", True).csv(str(tmp_path / "out" / name))

    assert read("points").count() == n_points
    assert read("stops").count() == sum(counted(p)[1] for p in by_path.values())
    runs, members = read("runs"), read("run_members")
    assert members.select("traj_id", "direction", "interval_id").distinct().count() == runs.count() > 10
    assert members.count() == runs.agg(F.sum(F.col("n_points").cast("int"))).first()[0]
    assert read("intervals").count() > 0


def test_golden_pairs(spark, tracks):
    folder, by_path = tracks
    speeds = pair_speeds(pair_messages(read_plt(spark, folder).filter(F.col("name") == "b")))
    points = next(p for path, p in by_path.items() if path.endswith("u1/b.plt"))
    pairs = list(zip(points, points[1:-1], strict=False))
    gaps = [(b[0] - a[0]).total_seconds() for a, b in pairs]
    # the two formulas differ by their values of pi and radius
    dist = [brute.metres(*a[2:], *b[2:]) for a, b in pairs]
    found = speeds.orderBy("time1").collect()
    assert len(found) == len(pairs)
    assert sum(r.dist for r in found) == pytest.approx(sum(dist), rel=1e-3)
    assert sorted(r.speed for r in found if r.speed) == pytest.approx(sorted(d / g for d, g in zip(dist, gaps, strict=True) if g and d), rel=1e-3)


def test_day_serial_speed(spark, tracks):
    folder, by_path = tracks
    found = plain(tr.day_serial_speed(tr.number_points(read_plt(spark, folder).filter(F.col("name") == "only"))))
    assert found.count() == 1
    found = plain(tr.day_serial_speed(tr.number_points(read_plt(spark, folder).filter(F.col("name") == "b"))))
    points = next(p for path, p in by_path.items() if path.endswith("u1/b.plt"))
    own = [r["speed"] for r in brute.analyse(points)][1:-1]
    speeds = [r.speed for r in found.filter("id > 0 and not is_last").orderBy("id").collect()]
    assert [s for s in speeds if s is not None] == pytest.approx([s for s in own if s is not None], rel=1e-3, abs=1e-4)


def test_summaries_read_large_keys_only(spark, tmp_path):
    spark.createDataFrame(walk({"hot": 60, "a": 9}), SCHEMA).write.parquet(str(tmp_path / "points"))
    df = tr.analyse(spark.read.parquet(str(tmp_path / "points")), max_rows=20)
    plan = tr.runs(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_one_shuffle(spark, tmp_path):
    points = spark.createDataFrame(walk({"a": 30}), SCHEMA)
    points.write.parquet(str(tmp_path / "points"))
    df = tr.runs(tr.analyse(spark.read.parquet(str(tmp_path / "points")), max_rows=None))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_summaries_do_not_double_the_plan(spark, tmp_path):
    spark.createDataFrame(walk({"hot": 60, "a": 9}), SCHEMA).write.parquet(str(tmp_path / "points"))
    points = spark.read.parquet(str(tmp_path / "points"))

    def windows(max_rows):
        df = tr.runs(tr.analyse(points, max_rows=max_rows))
        return df._jdf.queryExecution().optimizedPlan().toString().count("Window [")

    assert windows(20) <= 2 * windows(None)


def test_pieces_equal_plain_rows_with_null_times(spark):
    points = walk({"hot": 60, "a": 12, "b": 1})
    points = [(k, None if i % 7 == 0 else ts, seq, lat, lon) for i, (k, ts, seq, lat, lon) in enumerate(points)]
    df = spark.createDataFrame(points, SCHEMA)
    plain_rows, cut_rows = (rows(plain(tr.analyse(df, digits=6, max_rows=n))) for n in (None, 9))
    assert plain_rows == cut_rows
    plain_runs, cut_runs = (rows(tr.runs(tr.analyse(df, digits=6, max_rows=n)).select("traj_id", "id", "run_value", "run_no", "run_len")) for n in (None, 9))
    assert plain_runs == cut_runs
