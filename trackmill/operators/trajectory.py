"""Speed, stops, acceleration and accelerate/decelerate intervals per trajectory.

Points need ``traj_id``, ``ts``, ``lat``, ``lon`` and ``seq``, a number that breaks
ties between equal timestamps. ``number_points`` comes first; the other
operators add columns, and all of them share one shuffle and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmill.functions.geo import haversine_m
from trackmill.functions.times import day_serial_gap, seconds_between
from trackmill.operators.ordered import (
    MAX_ROWS_PER_TASK,
    beyond_piece,
    number_rows,
    order_window,
    own_rows,
    plain,
    running_sum,
)

KEY, ORDER = "traj_id", ("ts", "seq")
UP, DOWN = 1, -1
# The speed in m/s below which a vehicle stands, and the report texts.
STOP_SPEED = 0.4
UP_LABEL, DOWN_LABEL = "加速", "减速"
STOP_LINE = "第%d个轨迹点,为车辆停留点,时刻为%s,速度为%sm/s"
INTERVAL_LINE = "第%d个轨迹点,处于第%d个区间,该区间为%s区间,时刻为%s,速度为%sm/s"
# The run markers of a point look at four points before it and two after it.
_BEFORE, _AFTER = 4, 2


def _window(df: DataFrame, descending: bool = False):
    return order_window(df, KEY, ORDER, descending)


def number_points(points: DataFrame, max_rows: int | None = MAX_ROWS_PER_TASK) -> DataFrame:
    """Add ``id`` from 0 and ``is_last`` per trajectory; see ``ordered.number_rows``."""
    return number_rows(points, KEY, ORDER, _BEFORE, _AFTER, max_rows)


def time_gap(df: DataFrame) -> DataFrame:
    """Add ``gap_s``, seconds since the previous point, 0 for the first."""
    passed = seconds_between(F.col("ts"), F.lag("ts").over(_window(df)))
    return df.withColumn("gap_s", F.coalesce(passed, F.lit(0.0)))


def _inner_point() -> Column:
    return (F.col("id") > 0) & ~F.col("is_last")


def distance(df: DataFrame, mode: str = "asin", swap_axes: bool = False) -> DataFrame:
    """Add ``dist_m``, metres from the previous point, null for the first."""
    lat, lon = (F.col("lon"), F.col("lat")) if swap_axes else (F.col("lat"), F.col("lon"))
    w = _window(df)
    # Columns of their own: the formula names them several times.
    before = df.withColumns({"_lat": F.lag(lat).over(w), "_lon": F.lag(lon).over(w)})
    metres = haversine_m(F.col("_lat"), F.col("_lon"), lat, lon, mode)
    return before.select(*df.columns, metres.alias("dist_m"))


def speed(
    df: DataFrame, mode: str = "asin", digits: int | None = None, swap_axes: bool = False
) -> DataFrame:
    """Add ``dist_m`` and ``speed`` in m/s: 0 at both ends, null where no time has passed.

    ``digits`` rounds the speed before anything is derived from it. ``swap_axes`` takes
    latitude for longitude and the reverse, for results equal to those of a caller
    that passes them in that order.
    """
    value = F.try_divide("dist_m", "gap_s")
    if digits is not None:
        value = F.round(value, digits)
    df = distance(df, mode, swap_axes)
    return df.withColumn("speed", F.when(_inner_point(), value).otherwise(0.0))


def day_serial_speed(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Like ``speed``, with the atan2 distance and the gap between day serials."""
    before = F.lag("day_serial").over(_window(df))
    value = F.try_divide("dist_m", day_serial_gap(F.col("day_serial"), before))
    if digits is not None:
        value = F.round(value, digits)
    df = distance(df, "atan2")
    return df.withColumn("speed", F.when(_inner_point(), value).otherwise(0.0))


def stop_points(df: DataFrame, limit: float = STOP_SPEED) -> DataFrame:
    """Add ``stop``: 1 if the own or the next speed is below the limit."""
    slow = (F.col("speed") < limit) | (F.lead("speed").over(_window(df)) < limit)
    return df.withColumn("stop", F.when(slow, 1).otherwise(0))


def slow_points(df: DataFrame, limit: float = STOP_SPEED) -> DataFrame:
    """Add ``slow``: whether the own speed is below the limit."""
    return df.withColumn("slow", F.col("speed") < limit)


def acceleration(df: DataFrame) -> DataFrame:
    """Add ``acceleration`` and the flags that lead to intervals.

    ``direct`` is 1 for a positive acceleration and -1 otherwise; ``is_change``
    marks a new direction; ``in_range`` is false where this and the next point both
    change, and at the last point.
    """
    w = _window(df)
    gained = F.try_divide(F.col("speed") - F.lag("speed").over(w), F.col("gap_s"))
    df = df.withColumn("acceleration", F.when(F.col("id") > 0, gained).otherwise(0.0))
    df = df.withColumn("direct", F.when(F.col("acceleration") > 0, UP).otherwise(DOWN))
    changes = F.coalesce(F.col("direct") != F.lag("direct").over(w), F.lit(False))
    next_changes = F.col("direct") != F.lead("direct").over(w)
    flagged = df.withColumns({"_changes": changes, "_next_changes": next_changes})
    in_range = F.when(~F.col("is_last"), ~(F.col("_changes") & F.col("_next_changes"))).otherwise(False)
    return flagged.select(
        *df.columns,
        F.col("_changes").cast("int").alias("is_change"),
        in_range.alias("in_range"),
        ((F.col("acceleration") > 0) & in_range).alias("speed_up"),
        ((F.col("acceleration") < 0) & in_range).alias("speed_down"),
    )


def analyse(
    points: DataFrame,
    stop_limit: float = STOP_SPEED,
    digits: int | None = None,
    swap_axes: bool = False,
    max_rows: int | None = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """All point columns. The frame still suits ``intervals`` and ``runs``; ``plain`` ends it."""
    df = speed(time_gap(number_points(points, max_rows)), digits=digits, swap_axes=swap_axes)
    return acceleration(stop_points(df, stop_limit))


def stop_list(df: DataFrame) -> DataFrame:
    """The stop points with their speed rounded to 5 digits and a line of text."""
    stops = own_rows(df).filter(F.col("stop") == 1)
    return stops.select(KEY, "id", "ts", F.round("speed", 5).alias("speed")).withColumn(
        "line", F.format_string(STOP_LINE, "id", F.col("ts").cast("string"), "speed")
    )


def intervals(df: DataFrame) -> DataFrame:
    """Points of accelerate/decelerate intervals with ``range_index``, by change flags.

    Among the points in range, the index counts the changes so far; points with a
    neighbour of the same direction keep it. Index 0 is left out, and with it the
    first interval of a trajectory.
    """
    rows = own_rows(df).filter("in_range")
    rows = running_sum(rows, "_changes", F.col("is_change"), KEY, "ts")
    rows, beyond = beyond_piece(
        rows,
        earlier={"_direct_before": (F.max_by("direct", "id"), F.last)},
        later={"_direct_after": (F.min_by("direct", "id"), F.last)},
    )
    w = _window(rows)
    before = F.coalesce(F.lag("direct").over(w), beyond["_direct_before"])
    after = F.coalesce(F.lead("direct").over(w), beyond["_direct_after"])
    same = (F.col("direct") == after) | (F.col("direct") == before)
    index = F.when(same, F.col("_changes")).otherwise(0).alias("range_index")
    return rows.select(*plain(df).columns, index).filter(F.col("range_index") != 0)


def interval_list(rows: DataFrame) -> DataFrame:
    """Interval points that speed up or down, with label and a line of text."""
    label = F.when(F.col("speed_up"), UP_LABEL).when(F.col("speed_down"), DOWN_LABEL)
    listed = rows.select(KEY, "id", "range_index", label.alias("label"), "ts", F.round("speed", 5).alias("speed"))
    return listed.filter(F.col("label").isNotNull()).withColumn(
        "line",
        F.format_string(INTERVAL_LINE, "id", "range_index", "label", F.col("ts").cast("string"), "speed"),
    )


def sign_of_acceleration() -> Column:
    """1, -1 or null (no change, or an end of the trajectory)."""
    moving = _inner_point() & (F.col("acceleration") != 0)
    return F.when(moving, F.signum("acceleration").cast("int"))


def sign_in_range() -> Column:
    """1 or -1 at the points flagged ``speed_up`` or ``speed_down``, else null."""
    return F.when(F.col("speed_up"), UP).when(F.col("speed_down"), DOWN)


def runs(
    df: DataFrame, value: Column | None = None, min_len: int = 2, values: tuple[int, ...] = (UP, DOWN)
) -> DataFrame:
    """Points of maximal runs of at least ``min_len`` consecutive points with equal ``value``.

    Points whose value is null belong to no run. Added are ``run_value``,
    ``run_start`` and ``run_len`` (first id and length), ``member_no`` and
    ``run_no``, which counts the runs of a value within the trajectory.
    No group of points is collected: a run may be as long as its trajectory.
    """
    value = sign_of_acceleration() if value is None else value
    w = _window(df)
    columns = plain(df).columns
    df = df.withColumn("run_value", value)
    in_run = F.col("run_value").isNotNull()
    opens = in_run & ~F.col("run_value").eqNullSafe(F.lag("run_value").over(w))
    closes = in_run & ~F.col("run_value").eqNullSafe(F.lead("run_value").over(w))
    df = df.withColumns({"_open": F.when(opens, F.col("id")), "_close": F.when(closes, F.col("id"))})
    rows, beyond = beyond_piece(
        df,
        earlier={"_open_before": (F.max("_open"), F.max)},
        later={"_close_after": (F.min("_close"), F.min)},
    )
    # Looking ahead is a second, descending window: a frame that reaches to the end
    # of its group would be computed anew for every row.
    ahead = _window(rows, descending=True).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind = _window(rows).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns(
        {
            "run_start": F.greatest(F.max("_open").over(behind), beyond["_open_before"]),
            "_run_end": F.least(F.min("_close").over(ahead), beyond["_close_after"]),
        }
    )
    run_len = F.col("_run_end") - F.col("run_start") + 1
    begins = F.col("_open").isNotNull() & (run_len >= min_len)
    starts = {f"_starts_{i}": (v, F.when(begins & (F.col("run_value") == v), 1).otherwise(0)) for i, v in enumerate(values)}
    rows = rows.withColumns({name: flag for name, (_, flag) in starts.items()})
    rows, beyond = beyond_piece(rows, earlier={f"_past{name}": (F.sum(name), F.sum) for name in starts})
    number = F.lit(None).cast("bigint")
    for name, (v, _) in starts.items():
        count = F.sum(name).over(behind) + F.coalesce(beyond[f"_past{name}"], F.lit(0))
        number = F.when(F.col("run_value") == v, count).otherwise(number)
    rows = rows.select(
        *columns,
        "run_value",
        "run_start",
        run_len.alias("run_len"),
        number.alias("run_no"),
        (F.col("id") - F.col("run_start") + 1).alias("member_no"),
    )
    return rows.filter(F.col("run_value").isNotNull() & (F.col("run_len") >= min_len))


def run_summary(members: DataFrame) -> DataFrame:
    """One row per run: size, first and last time, and the range of speed and acceleration.

    The members themselves are the rows of ``members``.
    """
    return members.groupBy(KEY, "run_value", "run_no", "run_start").agg(
        F.count("*").alias("n_points"),
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("end_ts"),
        F.min("speed").alias("min_speed"),
        F.max("speed").alias("max_speed"),
        F.min("acceleration").alias("min_acceleration"),
        F.max("acceleration").alias("max_acceleration"),
    )


def pair_points(df: DataFrame) -> DataFrame:
    """Consecutive points as one message; suffix 1 is the newer. The last pair is left out.

    ``df`` carries ``day_serial``.
    """
    w = _window(df)
    pairs = df.select(
        "*",
        F.col("lat").alias("lat1"),
        F.col("lon").alias("lon1"),
        F.lag("lat").over(w).alias("lat2"),
        F.lag("lon").over(w).alias("lon2"),
        F.col("day_serial").alias("time1"),
        F.lag("day_serial").over(w).alias("time2"),
    ).filter(_inner_point())
    dist = haversine_m(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"), "atan2")
    return own_rows(pairs).select(
        KEY, "id", "lat1", "lon1", "lat2", "lon2", "time1", "time2", dist.alias("dist")
    )


def pair_speed(messages: DataFrame) -> DataFrame:
    """Add ``distance``, ``time_diff`` and ``speed`` to pair messages; works on streams.

    ``dist`` as sent gives the speed; ``distance`` is computed again beside it.
    """
    place = [F.col(c).try_cast("double") for c in ("lat1", "lon1", "lat2", "lon2")]
    return messages.withColumns(
        {
            "distance": haversine_m(*place, "atan2"),
            "time_diff": day_serial_gap(F.col("time1"), F.col("time2")),
        }
    ).withColumn("speed", F.try_divide(F.col("dist").try_cast("double"), "time_diff"))


