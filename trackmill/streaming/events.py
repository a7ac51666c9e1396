"""Streams in event time: bounded state by watermarks, windows, sessions and joins.

``late`` is how far a row may lag behind the newest one. Spark keeps the state that such a
row could still change, and no more; rows that come later than that are dropped, and counted
in the progress of the query (``numRowsDroppedByWatermark``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.functions.geo import haversine_m
from trackmill.functions.texts import split_on
from trackmill.functions.times import seconds_between
from trackmill.operators.trajectory import KEY, STOP_SPEED
from trackmill.streaming.wordcount import REPORT_EVERY

LATE = "10 minutes"


def word_windows(texts: DataFrame, column: str, time: str, width: str = REPORT_EVERY, late: str = LATE) -> DataFrame:
    """Occurrences of every word per window of event time; in append mode a window comes once, when it is over.

    State is the words of open windows. Rows of null time are in no window.
    """
    words = texts.withWatermark(time, late).select(time, F.explode(split_on(F.col(column), " ")).alias("word"))
    counts = words.filter(F.col("word") != "").groupBy(F.window(time, width).alias("w"), "word").count()
    return counts.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "word", "count")


def distinct_messages(messages: DataFrame, keys: list[str], time: str, late: str = LATE) -> DataFrame:
    """Each message once, by ``keys``, however often it is sent.

    A repeat within ``late`` of the newest message meets its key in the state, a later one is dropped for its
    time, so none comes through. State is the keys of that span. Messages of null time are dropped: their age can't be told.
    """
    return messages.filter(F.col(time).isNotNull()).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def live_pairs(points: DataFrame, max_gap: str, late: str = LATE) -> DataFrame:
    """Each point with the one before it, suffix 1 the newer, as soon as both are there.

    Points carry ``id``, their number per vehicle as the vehicle counts them, and join the point
    of the number before by equality of vehicle and number. A pair more than ``max_gap`` apart is
    not made, and so a point waits in the state no longer than that. The last pair is made as all others: a
    stream doesn't know that it is the last.
    """

    def side(suffix: str) -> DataFrame:
        columns = [F.col(c).alias(f"{c}{suffix}") for c in (KEY, "id", "ts", "lat", "lon")]
        return points.withWatermark("ts", late).select(*columns)

    newer, older = side("1"), side("2")
    apart = F.expr(f"ts1 >= ts2 AND ts1 <= ts2 + INTERVAL {max_gap}")
    met = F.col(f"{KEY}1").eqNullSafe(F.col(f"{KEY}2")) & (F.col("id1") == F.col("id2") + 1) & apart
    pairs = newer.join(older, met)
    dist = haversine_m(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"), "atan2")
    gap = seconds_between(F.col("ts1"), F.col("ts2"))
    pairs = pairs.withColumns({"dist": dist, "time_diff": gap})
    return pairs.select(
        F.col(f"{KEY}1").alias(KEY), F.col("id1").alias("id"), "lat1", "lon1", "lat2", "lon2", "ts1", "ts2", "dist", "time_diff",
        F.try_divide("dist", "time_diff").alias("speed"),
    )


def stop_episodes(speeds: DataFrame, gap: str, limit: float = STOP_SPEED, late: str = LATE) -> DataFrame:
    """Times in which a vehicle stands: points slower than ``limit``, no two neighbours ``gap`` or more apart.

    Sessions in event time: a late point joins the episode that it belongs to, or makes two of
    them one. In append mode an episode comes once, when no point can join it any more. Points
    without a speed are left out.
    """
    slow = speeds.filter(F.col("speed") < limit).withWatermark("ts", late)
    sessions = slow.groupBy(KEY, F.session_window("ts", gap).alias("w"))
    found = sessions.agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("points"), F.max("speed").alias("top_speed"))
    return found.select(KEY, "first", "last", "points", "top_speed", F.col("w.end").alias("closed"))
