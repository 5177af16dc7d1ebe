"""Timestamps, days and batch ids. The session time zone is UTC throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorewatch import constants as K


def day(ts: Column) -> Column:
    """Start of the day, as a timestamp."""
    return F.date_trunc("day", ts)


def day_number(ts: Column) -> Column:
    """Days since the epoch, for range frames."""
    return F.unix_date(F.to_date(ts))


def epoch_ms(ts: Column, precise: bool = False) -> Column:
    """Milliseconds since the epoch; whole seconds unless ``precise``."""
    return F.unix_millis(ts) if precise else F.unix_timestamp(ts) * 1000


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def batch_id(ts: Column) -> Column:
    return F.date_format(ts, K.BATCH_ID_FORMAT)


def parse_source_time(text: Column) -> Column:
    """ISO text with a Z suffix -> timestamp; other texts -> NULL."""
    return F.try_to_timestamp(text, F.lit(K.SOURCE_TIME_FORMAT))


def display_time(ts: Column) -> Column:
    return F.date_format(ts, K.DISPLAY_TIME_FORMAT)
