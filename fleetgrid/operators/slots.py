"""The grouping key both products share: cell, date, hour and ten-minute slot.

Keys stay fixed-width (three integers and a date) through the shuffle; the text
labels are built afterwards, once per group.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetgrid.functions.cells import geohash
from fleetgrid.functions.slots import calendar_date, hour_start, interval_label, minute_start

SLOT_KEYS = ["cell", "date", "hour", "minute"]


def time_keys(text: Column, clock: Column) -> list[Column]:
    """Date, hour and minute key columns of a datetime text."""
    return [
        calendar_date(text).alias("date"),
        hour_start(text, clock).alias("hour"),
        minute_start(text, clock).alias("minute"),
    ]


def slot_labels() -> list[Column]:
    """The keys as they appear in the products."""
    return [
        geohash(F.col("cell")).alias("geohash"),
        F.col("date"),
        interval_label(F.col("hour"), 1).alias("hour_interval"),
        interval_label(F.col("minute"), 10).alias("min_interval"),
    ]
