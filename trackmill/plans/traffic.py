"""The vehicle feed: points as paired messages, and their speeds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trackmill.operators.ordered import MAX_ROWS_PER_TASK
from trackmill.operators.trajectory import number_points, pair_points
from trackmill.schemas import PAIR_MESSAGE
from trackmill.sinks.writers import as_messages


def pair_messages(points: DataFrame, max_rows: int | None = MAX_ROWS_PER_TASK) -> DataFrame:
    """One JSON message per pair of consecutive points. ``points`` carry ``day_serial``."""
    pairs = pair_points(number_points(points, max_rows))
    return as_messages(pairs.select(*PAIR_MESSAGE.names))
