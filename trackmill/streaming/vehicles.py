"""Live speed per vehicle: distance and time since the vehicle's last point.

Two streaming queries share the work. The first handles every micro-batch as an ordinary
frame: each point gets the point before it in its batch, a vehicle that sends a large part
of a batch is cut into pieces like a long trajectory, and one row per vehicle tells its last
point. The second reads these rows only. It holds the last point of every vehicle in Spark's
state store, keyed by vehicle and let go by a timer, and writes for each batch and vehicle
the point known before it. The speeds are a join of the two: nothing is read that an
earlier batch wrote, however long the stream runs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from trackmill.functions.geo import haversine_m
from trackmill.operators.ordered import MAX_ROWS_PER_TASK, order_window, plain
from trackmill.operators.trajectory import KEY, ORDER, number_points
from trackmill.session import make_dir, state_session

#: How far apart batches may be seen from the order in which they arrived.
ARRIVAL_DELAY = "1 minute"
POINT = (KEY, "ts", "seq", "lat", "lon")
#: A point without its vehicle; times are microseconds.
_PLACE = "us long, seq long, lat double, lon double"
_PLACE_NAMES = ("us", "seq", "lat", "lon")
_TOLD = Row("key", "batch_id", "known", *_PLACE_NAMES)
#: A vehicle's state: its last place, batch and arrival, and the timer that lets it go.
_HELD = f"{_PLACE}, batch_id long, arrived_ms long, timer_ms long"


def _place():
    """The row's own point; places are in order of time, then of number."""
    return F.struct(F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), F.col("seq").cast("long").alias("seq"), "lat", "lon")


def _null_first(place: tuple) -> list[tuple]:
    return [(value is not None, value) for value in place]


def with_previous(batch: DataFrame, max_rows: int | None = MAX_ROWS_PER_TASK) -> DataFrame:
    """The points of a batch with ``previous``, the vehicle's point before it in the batch."""
    df = number_points(batch.select(*POINT), max_rows)
    df = df.withColumn("previous", F.lag(_place()).over(order_window(df, KEY, ORDER)))
    return plain(df).select(*POINT, "previous")


def last_places(batch: DataFrame) -> DataFrame:
    """The newest point of every vehicle of a batch, combined before the shuffle."""
    return batch.groupBy(KEY).agg(F.max(_place()).alias("last"))


def start_batches(
    points: DataFrame, path: str, checkpoint: str, every: str | None = None, max_rows: int | None = MAX_ROWS_PER_TASK
) -> StreamingQuery:
    """Write the points of every batch to ``path/points`` and its vehicles' last ones to ``path/ends``.

    A batch has a folder in each; one that is run again replaces its own. Without ``every``
    the query takes all there is and ends.
    """
    for name in ("points", "ends"):
        make_dir(points.sparkSession, f"{path}/{name}")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select(*POINT).persist()
        with_previous(batch, max_rows).write.mode("overwrite").parquet(f"{path}/points/batch_id={batch_id}")
        ends = last_places(batch).withColumn("arrived", F.current_timestamp())
        ends.write.mode("overwrite").parquet(f"{path}/ends/batch_id={batch_id}")
        batch.unpersist()

    writer = points.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


class _LastPlace(StatefulProcessor):
    """Holds the last place of a vehicle, the batch that it came from and when that arrived, and tells what was held before."""

    def __init__(self, wait_ms: int | None):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _HELD)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        held = first = self.last.get()
        told = []
        for row in sorted(rows, key=lambda r: r.batch_id):
            if held and row.batch_id <= held[4]:
                continue
            if held and self.wait_ms is not None and row.arrived_ms - held[5] >= self.wait_ms:
                held = None
            told.append(_TOLD(*key, row.batch_id, held is not None, *(held[:4] if held else (0, 0, 0.0, 0.0))))
            place = tuple(row[c] for c in _PLACE_NAMES)
            held = (*max(place, held[:4] if held else place, key=_null_first), row.batch_id, row.arrived_ms, None)
        if told:
            self.last.update(self._timed(held, first, timerValues))
        yield from told

    def _timed(self, held: tuple, before: tuple | None, timer_values: TimerValues) -> tuple:
        """What is held, with a timer in place of the one before."""
        if self.wait_ms is None:
            return held
        if before and before[6] is not None:
            self.handle.deleteTimer(before[6])
        at = max(held[5], timer_values.getCurrentWatermarkInMs()) + self.wait_ms
        self.handle.registerTimer(at)
        return (*held[:6], at)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def known_before(ends: DataFrame, forget_after_s: float | None = None) -> DataFrame:
    """For each batch and vehicle the point ``before`` it, null for a vehicle not known; for streams.

    The state of a vehicle is one point and the batch that it came from, so that a batch that is seen again
    changes nothing. It goes when the vehicle has sent nothing for ``forget_after_s`` seconds,
    by the times at which batches ``arrived`` and whatever the clocks of its points say; its
    next point is a first one again. The timer follows a watermark of these times. The session
    keeps its state in RocksDB (``session.state_session``). A vehicle's rows reach its state as
    they are: frames of pandas, one for every vehicle and batch, would take most of the time.
    """
    wait_ms = None if forget_after_s is None else max(1, int(forget_after_s * 1000))
    kind = ends.schema[KEY].dataType.simpleString()
    flat = ends.select(F.col(KEY).alias("key"), F.col("batch_id").cast("long").alias("batch_id"), "arrived", F.unix_millis("arrived").alias("arrived_ms"), "last.*")
    if wait_ms is not None:
        flat = flat.withWatermark("arrived", ARRIVAL_DELAY)
    told = flat.groupBy("key").transformWithState(
        _LastPlace(wait_ms), f"key {kind}, batch_id long, known boolean, {_PLACE}", "append", "none" if wait_ms is None else "eventTime"
    )
    before = F.when(F.col("known"), F.struct(*_PLACE_NAMES)).alias("before")
    return told.select(F.col("key").alias(KEY), "batch_id", before)


def start_known_before(
    spark: SparkSession, path: str, checkpoint: str, key_type: T.DataType, every: str | None = None, forget_after_s: float | None = None
) -> StreamingQuery:
    """Follow ``path/ends`` and write what was known before each batch to ``path/before``."""
    spark = state_session(spark)
    place = T.StructType([T.StructField(n, k) for n, k in zip(_PLACE_NAMES, (T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType()), strict=True)])
    schema = T.StructType([T.StructField(KEY, key_type), T.StructField("last", place), T.StructField("arrived", T.TimestampType()), T.StructField("batch_id", T.LongType())])
    before = known_before(spark.readStream.schema(schema).parquet(f"{path}/ends"), forget_after_s)
    writer = before.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(f"{path}/before")


def catch_up(points: DataFrame, path: str, checkpoint: str, max_rows: int | None = MAX_ROWS_PER_TASK, forget_after_s: float | None = None) -> None:
    """Both queries over all there is."""
    start_batches(points, path, f"{checkpoint}/batches", max_rows=max_rows).awaitTermination()
    key_type = points.schema[KEY].dataType
    start_known_before(points.sparkSession, path, f"{checkpoint}/before", key_type, forget_after_s=forget_after_s).awaitTermination()


def vehicle_speeds(points: DataFrame, before: DataFrame) -> DataFrame:
    """``dist_m``, ``gap_s`` and ``speed`` of the points of the batches for which both queries are through.

    A vehicle's first point ever has speed 0 and no distance. A point that comes ``late``,
    before its vehicle's last point of earlier batches, is kept without values; the first one
    after it goes back to that last point.
    """
    known = before.select(F.col(KEY).alias("_key"), F.col("batch_id").alias("_batch"), "before")
    df = points.join(known, F.col(KEY).eqNullSafe(F.col("_key")) & (F.col("batch_id") == F.col("_batch")))
    df = df.withColumn("late", F.coalesce(_place() < F.col("before"), F.lit(False)))
    own = F.col("previous").isNotNull() & F.coalesce(F.col("previous") >= F.col("before"), F.lit(True))
    df = df.withColumn("since", F.when(own, F.col("previous")).otherwise(F.col("before")))
    gap = (F.unix_micros(F.col("ts").cast("timestamp")) - F.col("since.us")) / 1e6
    metres = haversine_m(F.col("since.lat"), F.col("since.lon"), F.col("lat"), F.col("lon"), "atan2")
    df = df.withColumns({"gap_s": F.coalesce(gap, F.lit(0.0)), "dist_m": metres})
    df = df.withColumn("speed", F.when(F.col("since").isNull(), 0.0).otherwise(F.try_divide("dist_m", "gap_s")))
    values = {name: F.when(~F.col("late"), F.col(name)) for name in ("gap_s", "dist_m", "speed")}
    return df.withColumns(values).select(*POINT, "gap_s", "dist_m", "speed", "late", "batch_id")


def read_vehicle_speeds(spark: SparkSession, path: str) -> DataFrame:
    """The speeds of all that the two queries have written below ``path``."""
    return vehicle_speeds(spark.read.parquet(f"{path}/points"), spark.read.parquet(f"{path}/before"))
