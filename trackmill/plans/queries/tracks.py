"""Trajectory queries. Users stand for vehicles, and events for their points."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackmill.functions.times import day_serial
from trackmill.operators import trajectory as tr
from trackmill.operators.ordered import plain
from trackmill.plans.queries.base import query, table

DIGITS = 6

# Steps of the SQL twins, from points to flags.
_POINTS = """
pts AS (SELECT user_id AS traj_id, event_id AS seq, ts, 39.9 + value / 10000 AS lat,
               116.3 + CAST(event_id % 100 AS DOUBLE) / 10000 AS lon,
               epoch_us(ts) / 1e6 / 86400 + 25569 AS day_serial FROM events),
num AS (SELECT *, row_number() OVER w - 1 AS id, lead(seq) OVER w IS NULL AS is_last,
               coalesce((epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6, 0) AS gap_s,
               lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0, lag(day_serial) OVER w AS day0
        FROM pts WINDOW w AS (PARTITION BY traj_id ORDER BY ts, seq)),
rad AS (SELECT *, lat * 3.1415926 / 180 AS b, lat0 * 3.1415926 / 180 AS a,
               lon * 3.1415926 / 180 AS d, lon0 * 3.1415926 / 180 AS c FROM num),
dst AS (SELECT *, 2 * asin(sqrt(pow(sin(abs(b - a) / 2), 2)
               + cos(a) * cos(b) * pow(sin(abs(d - c) / 2), 2))) * 6371393 AS dist_m,
               pow(sin((lat - lat0) * pi() / 360), 2) + cos(lat0 * pi() / 180) * cos(lat * pi() / 180)
               * pow(sin((lon - lon0) * pi() / 360), 2) AS h FROM rad),
spd AS (SELECT *, CASE WHEN id = 0 OR is_last THEN 0
                       WHEN gap_s <> 0 THEN round(dist_m / gap_s, 6) END AS speed FROM dst)"""
_FLAGS = f"""{_POINTS},
stp AS (SELECT *, CASE WHEN speed < 0.4 OR lead(speed) OVER w < 0.4 THEN 1 ELSE 0 END AS stop,
               CASE WHEN id = 0 THEN 0 WHEN gap_s <> 0 THEN (speed - lag(speed) OVER w) / gap_s END AS acceleration
        FROM spd WINDOW w AS (PARTITION BY traj_id ORDER BY ts, seq)),
dir AS (SELECT *, CASE WHEN acceleration > 0 THEN 1 ELSE -1 END AS direct FROM stp),
chg AS (SELECT *, coalesce(CAST(direct <> lag(direct) OVER (PARTITION BY traj_id ORDER BY ts, seq) AS INTEGER), 0)
               AS is_change FROM dir),
rng AS (SELECT *, CASE WHEN is_last THEN false ELSE NOT (is_change = 1 AND
               lead(is_change) OVER (PARTITION BY traj_id ORDER BY ts, seq) = 1) END AS in_range FROM chg),
flg AS (SELECT *, acceleration > 0 AND in_range AS speed_up, acceleration < 0 AND in_range AS speed_down FROM rng)"""
_INTERVALS = f"""{_FLAGS},
cnt AS (SELECT *, CAST(sum(is_change) OVER (PARTITION BY traj_id ORDER BY ts
               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS changes,
               lag(direct) OVER w AS before, lead(direct) OVER w AS after
        FROM flg WHERE in_range WINDOW w AS (PARTITION BY traj_id ORDER BY ts, seq)),
itv AS (SELECT *, CASE WHEN direct = before OR direct = after THEN changes ELSE 0 END AS range_index FROM cnt)"""


def _runs_sql(value: str, least: int) -> str:
    """Islands of equal values, found by numbering the changes."""
    return f"""{_FLAGS},
val AS (SELECT *, {value} AS run_value FROM flg),
brk AS (SELECT *, CASE WHEN run_value IS NOT DISTINCT FROM lag(run_value) OVER w AND id > 0 THEN 0 ELSE 1 END AS brk
        FROM val WINDOW w AS (PARTITION BY traj_id ORDER BY ts, seq)),
grp AS (SELECT *, sum(brk) OVER (PARTITION BY traj_id ORDER BY id) AS grp FROM brk),
big AS (SELECT traj_id, grp, min(id) AS run_start, count(*) AS run_len,
               row_number() OVER (PARTITION BY traj_id, min(run_value) ORDER BY min(id)) AS run_no
        FROM grp WHERE run_value IS NOT NULL GROUP BY traj_id, grp HAVING count(*) >= {least}),
mem AS (SELECT grp.traj_id, run_value, run_no, run_start, run_len, id - run_start + 1 AS member_no, id, ts,
               speed, acceleration FROM grp JOIN big ON grp.traj_id = big.traj_id AND grp.grp = big.grp)"""


_SIGN = "CASE WHEN id > 0 AND NOT is_last AND acceleration <> 0 THEN CAST(sign(acceleration) AS INTEGER) END"
_IN_RANGE = "CASE WHEN speed_up THEN 1 WHEN speed_down THEN -1 END"
_STOPPED = "CASE WHEN stop = 1 THEN 1 END"
# Half up in decimals, as Spark rounds; adding 0 above turns -0.0 into 0.0.
_ROUND_5 = "CAST(round(CAST(speed AS DECIMAL(18, 6)), 5) AS DOUBLE)"
_MEMBERS = "traj_id, run_value, run_no, run_start, run_len, member_no, id, speed, round(acceleration, 6) + 0 AS acceleration"


def points_of(events):
    """Events as trajectory points: a stand-in, since the tables hold no coordinates."""
    return events.select(
        F.col("user_id").alias("traj_id"),
        F.col("event_id").alias("seq"),
        "ts",
        (39.9 + F.col("value") / 10000).alias("lat"),
        (116.3 + (F.col("event_id") % 100).cast("double") / 10000).alias("lon"),
    )


def _points(spark, folder):
    return points_of(table(spark, folder, "events"))


def _analysed(spark, folder):
    return tr.analyse(_points(spark, folder), digits=DIGITS)


@query(f"WITH {_POINTS} SELECT traj_id, seq, id, gap_s FROM num")
def traj_gap(spark, folder):
    df = tr.time_gap(tr.number_points(_points(spark, folder)))
    return plain(df).select("traj_id", "seq", "id", "gap_s")


@query(f"WITH {_POINTS} SELECT traj_id, seq, id, round(dist_m, 6) AS dist_m, speed FROM spd")
def traj_speed(spark, folder):
    df = tr.speed(tr.time_gap(tr.number_points(_points(spark, folder))), digits=DIGITS)
    return plain(df).select("traj_id", "seq", "id", F.round("dist_m", 6).alias("dist_m"), "speed")


@query(f"""
WITH {_POINTS}
SELECT traj_id, seq, CASE WHEN id = 0 OR is_last THEN 0 WHEN gap_s <> 0 THEN
       round(2 * asin(sqrt(pow(sin(abs(d - c) / 2), 2) + cos(c) * cos(d) * pow(sin(abs(b - a) / 2), 2)))
             * 6371393 / gap_s, 6) END AS speed
FROM rad""")
def traj_speed_swapped(spark, folder):
    df = tr.speed(tr.time_gap(tr.number_points(_points(spark, folder))), digits=DIGITS, swap_axes=True)
    return plain(df).select("traj_id", "seq", "speed")


@query(f"WITH {_FLAGS} SELECT traj_id, seq, id, speed, stop FROM stp")
def traj_stops(spark, folder):
    df = tr.speed(tr.time_gap(tr.number_points(_points(spark, folder))), digits=DIGITS)
    return plain(tr.stop_points(df)).select("traj_id", "seq", "id", "speed", "stop")


@query(f"WITH {_POINTS} SELECT traj_id, seq, speed < 0.4 AS slow FROM spd")
def traj_slow(spark, folder):
    df = tr.speed(tr.time_gap(tr.number_points(_points(spark, folder))), digits=DIGITS)
    return plain(tr.slow_points(df)).select("traj_id", "seq", "slow")


@query(f"WITH {_FLAGS} SELECT traj_id, id, {_ROUND_5} AS speed FROM stp WHERE stop = 1")
def traj_stop_list(spark, folder):
    return tr.stop_list(_analysed(spark, folder)).select("traj_id", "id", "speed")


@query(f"WITH {_FLAGS} SELECT traj_id, seq, speed, round(acceleration, 6) + 0 AS acceleration, direct FROM dir")
def traj_accel(spark, folder):
    df = plain(_analysed(spark, folder))
    return df.select("traj_id", "seq", "speed", F.round("acceleration", 6).alias("acceleration"), "direct")


@query(f"WITH {_FLAGS} SELECT traj_id, seq, is_change, in_range, speed_up, speed_down FROM flg")
def traj_flags(spark, folder):
    df = plain(_analysed(spark, folder))
    return df.select("traj_id", "seq", "is_change", "in_range", "speed_up", "speed_down")


@query(f"""
WITH {_FLAGS} SELECT traj_id, count(*) AS points, round(max(speed), 6) AS max_speed,
       CAST(sum(stop) AS BIGINT) AS stops, CAST(sum(is_change) AS BIGINT) AS changes,
       count(*) FILTER (WHERE in_range) AS in_range, count(*) FILTER (WHERE speed_up) AS speed_up,
       count(*) FILTER (WHERE speed_down) AS speed_down
FROM flg GROUP BY traj_id""")
def traj_report(spark, folder):
    return plain(_analysed(spark, folder)).groupBy("traj_id").agg(
        F.count("*").alias("points"),
        F.round(F.max("speed"), 6).alias("max_speed"),
        F.sum("stop").alias("stops"),
        F.sum("is_change").alias("changes"),
        F.count_if("in_range").alias("in_range"),
        F.count_if("speed_up").alias("speed_up"),
        F.count_if("speed_down").alias("speed_down"),
    )


@query(f"WITH {_INTERVALS} SELECT traj_id, seq, id, range_index, speed_up, speed_down FROM itv WHERE range_index <> 0")
def traj_intervals(spark, folder):
    rows = tr.intervals(_analysed(spark, folder))
    return rows.select("traj_id", "seq", "id", "range_index", "speed_up", "speed_down")


@query(f"""
WITH {_INTERVALS} SELECT traj_id, id, range_index, CASE WHEN speed_up THEN '加速' ELSE '减速' END AS label,
       {_ROUND_5} AS speed FROM itv WHERE range_index <> 0 AND (speed_up OR speed_down)""")
def traj_interval_list(spark, folder):
    rows = tr.interval_list(tr.intervals(_analysed(spark, folder)))
    return rows.select("traj_id", "id", "range_index", "label", "speed")


def _members(rows):
    return rows.select(
        "traj_id", "run_value", "run_no", "run_start", "run_len", "member_no", "id", "speed",
        F.round("acceleration", 6).alias("acceleration"),
    )


@query(f"WITH {_runs_sql(_SIGN, 2)} SELECT {_MEMBERS} FROM mem")
def traj_runs(spark, folder):
    return _members(tr.runs(_analysed(spark, folder)))


@query(f"WITH {_runs_sql(_IN_RANGE, 3)} SELECT {_MEMBERS} FROM mem")
def traj_flag_runs(spark, folder):
    return _members(tr.runs(_analysed(spark, folder), tr.sign_in_range(), min_len=3))


@query(f"WITH {_runs_sql(_STOPPED, 3)} SELECT {_MEMBERS} FROM mem")
def traj_stop_runs(spark, folder):
    stopped = F.when(F.col("stop") == 1, 1)
    return _members(tr.runs(_analysed(spark, folder), stopped, min_len=3, values=(1,)))


@query(f"""
WITH {_runs_sql(_SIGN, 2)}
SELECT traj_id, run_value, run_no, run_start, count(*) AS n_points, min(id) AS first_id, max(id) AS last_id,
       epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, min(speed) AS min_speed, max(speed) AS max_speed,
       round(min(acceleration), 6) + 0 AS min_acceleration, round(max(acceleration), 6) + 0 AS max_acceleration
FROM mem GROUP BY traj_id, run_value, run_no, run_start""")
def traj_run_summary(spark, folder):
    summary = tr.run_summary(tr.runs(_analysed(spark, folder)))
    micros = {c: F.unix_micros(F.col(t).cast("timestamp")) for c, t in (("start_us", "start_ts"), ("end_us", "end_ts"))}
    return summary.select(
        "traj_id", "run_value", "run_no", "run_start", "n_points",
        F.col("run_start").alias("first_id"),
        (F.col("run_start") + F.col("n_points") - 1).alias("last_id"),
        *[value.alias(name) for name, value in micros.items()],
        "min_speed", "max_speed",
        F.round("min_acceleration", 6).alias("min_acceleration"),
        F.round("max_acceleration", 6).alias("max_acceleration"),
    )


_HAVERSINE = "6371 * 2 * atan2(sqrt(h), sqrt(1 - h)) * 1000"


@query(f"""
WITH {_POINTS} SELECT traj_id, id, lat AS lat1, lon AS lon1, lat0 AS lat2, lon0 AS lon2, day_serial AS time1,
       day0 AS time2, round({_HAVERSINE}, 6) AS dist FROM dst WHERE id > 0 AND NOT is_last""")
def traj_pairs(spark, folder):
    points = _points(spark, folder).withColumn("day_serial", day_serial(F.col("ts")))
    pairs = tr.pair_points(tr.number_points(points))
    return pairs.withColumn("dist", F.round("dist", 6))


@query(f"""
WITH {_POINTS} SELECT traj_id, seq, id + 1 AS id, CASE WHEN id = 0 OR is_last THEN 0
       WHEN day_serial <> day0 THEN round({_HAVERSINE} / (86400 * (day_serial - day0)), 6) END AS speed FROM dst""")
def traj_dayserial_speed(spark, folder):
    points = _points(spark, folder).withColumn("day_serial", day_serial(F.col("ts")))
    df = tr.day_serial_speed(tr.number_points(points), digits=DIGITS)
    return plain(df).select("traj_id", "seq", (F.col("id") + 1).alias("id"), "speed")
