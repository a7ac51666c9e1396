from pyspark.sql import functions as F

import pytest
from conftest import rows

from trackmill.session import new_shared_dir, renewed_dir, shared_root
from trackmill.schemas import EMPLOYEE_TABLE, SALES
from trackmill.sinks.writers import as_messages, write_by_interval, write_csv, write_intervals, write_plt_tracks, write_tsv
from trackmill.sources.files import (
    frame_of,
    number_lines,
    read_employees_csv,
    read_iris,
    read_lines,
    read_plt,
    read_plt_tracks,
    read_sales,
    read_written_csv,
    read_written_tsv,
    skip_lines,
)
from trackmill.sources.jdbc import aggregate_sql, subquery
from trackmill.sources.kafka import kafka_options

HEADER = "Geo\nWGS\nFeet\nReserved 3\n0,2,255,My Track,0,0,2,8421376\n0\n"


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of a few lines."""
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def test_plt(spark, tmp_path):
    (tmp_path / "one.plt").write_text(HEADER + "39.9,116.3,0,170,39566.5,2008-04-28,12:00:00\nx,1,0,1,1,2008-04-28,12:00:00\n")
    (tmp_path / "two.plt").write_text(HEADER + "1,2,0,-777,2.0,2008-04-28,12:00:01\n1,2,0,0,3,2008-13-28,12:00:01\n")
    found = read_plt(spark, str(tmp_path)).orderBy("name").collect()
    assert [(r.name, r.lat, r.lon, r.altitude, r.day_serial) for r in found] == [
        ("one", 39.9, 116.3, 170.0, 39566.5), ("two", 1.0, 2.0, -777.0, 2.0),
    ]
    assert found[0].ts.isoformat() == "2008-04-28T12:00:00"


def test_equal_file_names_stay_apart(spark, tmp_path):
    for folder in ("2007/000/Trajectory", "2008/000/Trajectory", "2008/170/Trajectory"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "a.b.plt").write_text(HEADER + "1,2,0,0,3,2008-10-13,12:00:01\n")
    points = read_plt(spark, str(tmp_path / "*" / "*" / "Trajectory")).collect()
    assert len({r.traj_id for r in points}) == 3 and {r.name for r in points} == {"a.b"}


def test_plt_in_small_blocks(spark, tmp_path, small_blocks):
    lines = "".join(f"{i / 100},{i / 50},0,0,{i},2008-10-13,12:{i // 60:02}:{i % 60:02}\n" for i in range(500))
    (tmp_path / "a.plt").write_text(HEADER + lines)
    assert read_plt(spark, str(tmp_path)).agg(F.count("*"), F.sum("day_serial")).first()[:] == (500, sum(range(500)))


@pytest.mark.parametrize("block", [1 << 27, 300, 64])
def test_many_tracks_share_files(spark, tmp_path, block):
    """The number of files doesn't grow with that of tracks, and every point finds its track and its place in it."""
    users = [f"u{i}" for i in range(60)] + [None, "", "a,b\n\\N", "\u2028%s"]
    sent = [(u, f"2024-01-01 {i // 540:02}:{i // 9 % 60:02}:{i % 9 // 3:02}.{9 - i % 3}", i, i / 10, float(k)) for k, u in enumerate(users) for i in range(700 if u == "u7" else 5)]
    points = spark.createDataFrame(sent, "name string, ts string, seq int, lat double, lon double")
    points = points.withColumns({"ts": F.col("ts").cast("timestamp"), "altitude": F.lit(None).cast("double"), "day_serial": F.lit(1.5)})
    write_plt_tracks(points, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").rglob("*.txt"))) <= 4
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = read_plt_tracks(spark, str(tmp_path / "out")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {r.altitude for r in found} == {-777.0} and len(found) == len(sent)
    # in order of time, then of place, the points are where they were
    want = sorted(((r[0] is not None, r[0] or "", r[1], r[2], r[3], r[4]) for r in sent))
    got = sorted(found, key=lambda r: (r.traj_id is not None, r.traj_id or "", r.ts, r.seq))
    assert [(r.traj_id, r.lat, r.lon) for r in got] == [(w[1] if w[0] else None, w[4], w[5]) for w in want]


@pytest.mark.parametrize("n", [0, 1, 3, 5])
def test_skip_lines(spark, tmp_path, small_blocks, n):
    want = []
    for name, count in (("a", 100), ("b", 30), ("c", 0), ("d", 2)):
        lines = [f"{name} line {i}" for i in range(count)]
        (tmp_path / name).write_text("".join(f"{line}\n" for line in lines))
        want += lines[n:]
    assert sorted(r.value for r in skip_lines(spark, str(tmp_path), n).collect()) == sorted(want)


@pytest.mark.parametrize("block", ["64", "1000", "100000"])
def test_skip_lines_beyond_first_block(spark, tmp_path, small_blocks, block):
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    (tmp_path / "a").write_text("".join(f"line {i}\n" for i in range(100)))
    assert sorted(r.value for r in skip_lines(spark, str(tmp_path), 40).collect()) == sorted(f"line {i}" for i in range(40, 100))


def test_number_lines(spark, tmp_path, small_blocks):
    for name in "ab":
        (tmp_path / name).write_text("".join(f"{name} line {i}\n" for i in range(1, 90)))
    found = number_lines(spark, str(tmp_path))
    assert found.count() == 178
    assert found.filter("value != substring(file, -1) || ' line ' || line_no").count() == 0


def test_delimited(spark, tmp_path):
    df = frame_of(spark, [(1, "酒 a", 'b"c', 1, 2, 3, 4, 5, 6), (2, "x", "y", 0, 0, 0, 0, 0, 0)], SALES)
    write_tsv(df, str(tmp_path / "tsv"))
    assert rows(read_sales(spark, str(tmp_path / "tsv"))) == rows(df)
    (tmp_path / "emp").write_text("1,Ella,36\n2,Bob,29\n")
    assert rows(read_employees_csv(spark, str(tmp_path / "emp"))) == [(1, "Ella", 36), (2, "Bob", 29)]
    (tmp_path / "iris").write_text("5.1,3.5,1.4,0.2,Iris-setosa\n")
    assert rows(read_iris(spark, str(tmp_path / "iris"))) == [(5.1, 3.5, 1.4, 0.2, "Iris-setosa")]
    (tmp_path / "lines").write_text("a\n\nb\n")
    assert [r.value for r in read_lines(spark, str(tmp_path / "lines")).collect()] == ["a", "", "b"]


ODD = ["l1\nl2", "\r", "\ttab\t", '"q" "', "\\", "\\N", "\\n", " lead ", "", None, "a,b", "\0", "\\\\t", '"', "é 酒", "\\-", "#x"]


@pytest.mark.parametrize("write, read", [(write_csv, read_written_csv), (write_tsv, read_written_tsv)])
def test_values_come_back(spark, tmp_path, write, read):
    df = spark.createDataFrame([(i, v, w, i / 3) for i, v in enumerate(ODD) for w in ODD], "k int, v string, w string, x double")
    write(df, str(tmp_path / "out"))
    assert rows(read(spark, str(tmp_path / "out"), df.schema)) == rows(df)
    one = df.select("v").distinct()
    write(one, str(tmp_path / "one"))
    assert rows(read(spark, str(tmp_path / "one"), one.schema)) == rows(one)


def test_csv_appends_with_header(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    for _ in range(2):
        write_csv(df, str(tmp_path / "out"))
    back = read_written_csv(spark, str(tmp_path / "out"), df.schema)
    assert back.count() == 4 and back.filter("v is null").count() == 2


def test_intervals_as_one_table(spark, tmp_path):
    df = spark.createDataFrame([(f"t{i}", "up" if i % 2 else "down", i, "x\ny") for i in range(50)], "traj_id string, direction string, interval_id int, v string")
    write_intervals(df, str(tmp_path / "out"), "traj_id", buckets=4)
    assert {p.parent.name for p in (tmp_path / "out").rglob("*.csv")} == {f"bucket={b}" for b in range(4)}
    names = df.select("traj_id", "interval_id", "v", "direction")
    assert rows(read_written_csv(spark, str(tmp_path / "out"), names.schema)) == rows(names)


def test_a_folder_per_interval(spark, tmp_path):
    df = spark.createDataFrame([("t", "up", 1, 5.0), ("t", "up", 2, 6.0), ("t", "down", 1, 7.0)], "traj_id string, direction string, interval_id int, v double")
    write_by_interval(df, str(tmp_path / "out"), ["traj_id", "direction", "interval_id"])
    folders = {str(p.parent.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*.csv")}
    assert folders == {f"traj_id=t/direction={d}/interval_id={i}" for d, i in (("up", 1), ("up", 2), ("down", 1))}


def test_messages(spark):
    df = frame_of(spark, [("Mary", "F", 26)], EMPLOYEE_TABLE)
    row = as_messages(df, F.col("name")).first()
    assert (row.key, row.value) == ("Mary", '{"name":"Mary","gender":"F","Age":26}')
    assert as_messages(df).columns == ["value"]


def test_options():
    assert kafka_options("h:9092", "t") == {"kafka.bootstrap.servers": "h:9092", "subscribe": "t"}
    assert kafka_options("h:9092", "t", 10)["maxOffsetsPerTrigger"] == "10"
    assert subquery(aggregate_sql("employee", top="max(Age)", total="sum(Age)")) == (
        "(SELECT max(Age) AS top, sum(Age) AS total FROM employee) q"
    )


def test_a_renewed_folder_replaces_the_one_before(spark, tmp_path):
    first = renewed_dir(spark, "twice")
    spark.range(3).write.parquet(first)
    second = renewed_dir(spark, "twice")
    assert first != second
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(first)


def test_shared_folder_is_the_sessions(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_shared_dir(spark, "x") != new_shared_dir(spark, "x")


def test_a_cluster_must_name_a_shared_folder():
    from types import SimpleNamespace

    conf = SimpleNamespace(get=lambda name, default: default)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn", applicationId="a"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(cluster)
    local = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="local[2]", applicationId="test-app"))
    assert shared_root(local) == shared_root(local)
