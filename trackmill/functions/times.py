"""Seconds, day serials and timestamps from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400
# Fixed value: days from 1899-12-30 to 1970-01-01.
EPOCH_DAY_SERIAL = 25569


def seconds(ts: Column) -> Column:
    """Seconds since 1970 with microseconds kept."""
    return F.unix_micros(ts.cast("timestamp")) / 1e6


def seconds_between(newer: Column, older: Column) -> Column:
    """Seconds between two timestamps, exact to the microsecond."""
    newer, older = newer.cast("timestamp"), older.cast("timestamp")
    return (F.unix_micros(newer) - F.unix_micros(older)) / 1e6


def day_serial(ts: Column) -> Column:
    """Fractional days since 1899-12-30."""
    return seconds(ts) / SECONDS_PER_DAY + EPOCH_DAY_SERIAL


def day_serial_gap(newer: Column, older: Column) -> Column:
    """Seconds between two day serials, given as numbers or as text."""
    return SECONDS_PER_DAY * (newer.try_cast("double") - older.try_cast("double"))


def timestamp_from(date: Column, time: Column) -> Column:
    """A timestamp from ``yyyy-MM-dd`` and ``HH:mm:ss``; null when either is malformed."""
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit("yyyy-MM-dd HH:mm:ss"))
