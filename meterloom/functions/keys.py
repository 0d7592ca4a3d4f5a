"""Row keys of the reading tables as text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterloom.functions.timeslots import HOUR_MS, whole


def padded_point(point: Column) -> Column:
    """Point id padded to eight digits; longer ids keep all their digits."""
    text = point.cast("string")
    return F.when(F.length(text) >= 8, text).otherwise(F.lpad(text, 8, "0"))


def iv_row_key(point: Column, ms: Column, suffix: Column) -> Column:
    return F.concat(padded_point(point), F.format_string("%014d", ms), suffix)


def om_row_key(point: Column, interval: Column, day: Column, suffix: Column) -> Column:
    return F.concat(
        padded_point(point),
        interval.cast("string"),
        F.format_string("%010d", whole(day, HOUR_MS)),
        suffix,
    )


def clean_row_key(rowkey: Column) -> Column:
    """The part of a stored key before its first blank."""
    return F.substring_index(rowkey, " ", 1)
