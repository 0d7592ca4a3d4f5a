"""Restriction of reading tables to points and time windows.

All predicates are written on the stored columns, so they reach the Parquet scan.
"""

from collections.abc import Sequence
from datetime import date, timedelta, tzinfo

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from meterloom.functions.timeslots import (
    DAY_MS,
    HOUR_MS,
    date_ms,
    day_start_hours,
    report_date,
    whole,
)
from meterloom.operators.spans import Spans, span_join
from meterloom.operators.spread import BROADCAST_IDS, BROADCAST_ROWS, bounded_join, row_identity
from meterloom.schemas import DAY_COLUMN
from meterloom.sources.tables import point_ids


def keep_points(
    readings: DataFrame, points: DataFrame, max_rows: int = BROADCAST_IDS, id_column: str = "ID"
) -> DataFrame:
    """Readings of the listed points."""
    ids = point_ids(points, id_column).withColumnRenamed("ID", "measuring_point")
    return bounded_join(
        readings, ids, ["measuring_point"], "left_semi", max_rows, row_identity(readings)
    )


def mark_points(
    readings: DataFrame,
    points: DataFrame,
    blanked: Sequence[str],
    max_rows: int = BROADCAST_IDS,
    id_column: str = "ID",
) -> DataFrame:
    """All readings, without point and ``blanked`` columns where the point is not listed.

    For plans that ask something of all readings but go on with those of the points: what is
    left of the others falls into one group, of which an aggregation keeps a row per task.
    """
    ids = point_ids(points, id_column).withColumnRenamed("ID", "measuring_point")
    listed = ids.filter(F.col("measuring_point").isNotNull()).withColumn("__listed", F.lit(True))
    marked = bounded_join(
        readings, listed, ["measuring_point"], "left", max_rows, row_identity(readings)
    )
    blank = {name: F.when(F.col("__listed"), F.col(name)) for name in ("measuring_point", *blanked)}
    return marked.withColumns(blank).select(*readings.columns)


def _utc_day(ms: int) -> date:
    return date(1970, 1, 1) + timedelta(days=ms // DAY_MS)


def day_range(readings: DataFrame, first: int, last: int) -> DataFrame:
    """Where a table is partitioned by day, only the days of ``first <= time <= last``.

    Only prunes: the range of times itself is another predicate.
    """
    if DAY_COLUMN not in readings.columns:
        return readings
    days = F.lit(_utc_day(first)), F.lit(_utc_day(last))
    return readings.filter(F.col(DAY_COLUMN).between(*days))


def time_window(readings: DataFrame, start: int, stop: int) -> DataFrame:
    """Instantaneous readings with ``start <= date <= stop`` (epoch ms)."""
    return day_range(readings, start, stop).filter(F.col("date").between(start, stop))


def points_window(
    readings: DataFrame, points: DataFrame, start: int, stop: int, max_rows: int = BROADCAST_IDS
) -> DataFrame:
    """Instantaneous readings of the points, ``start <= date <= stop`` (epoch ms)."""
    return keep_points(time_window(readings, start, stop), points, max_rows)


def hours_range(readings: DataFrame, start: int, stop: int, interval: int) -> DataFrame:
    """Energy readings of one interval code with ``start <= day <= stop``, cut to whole hours."""
    first = start // HOUR_MS * HOUR_MS
    last = stop // HOUR_MS * HOUR_MS + HOUR_MS - 1
    return day_range(readings, first, last).filter(
        (F.col("measurement_interval") == interval) & F.col("day").between(first, last)
    )


def points_hours(
    readings: DataFrame,
    points: DataFrame,
    start: int,
    stop: int,
    interval: int,
    max_rows: int = BROADCAST_IDS,
) -> DataFrame:
    return keep_points(hours_range(readings, start, stop, interval), points, max_rows)


def inspection_windows(
    inspections: DataFrame,
    id_column: str,
    code_column: str,
    date_column: str = "FECHAI1",
    days: int = 90,
    unreadable: Observation | None = None,
) -> DataFrame:
    """Per-point windows that end on the inspection date and begin ``days`` before it.

    Bounds are day starts in the session zone, as epoch ms.  An unreadable date gives a window of
    nulls that holds nothing; ``unreadable`` observes how many there are, in whatever job reads
    the windows first.
    """
    inspected = report_date(F.col(date_column))
    windows = inspections.select(
        F.col(id_column).cast("bigint").alias("point"),
        F.col(code_column).alias("code"),
        inspected.alias("inspected"),
        date_ms(F.date_sub(inspected, days)).alias("window_start"),
        date_ms(inspected).alias("window_stop"),
    )
    if unreadable is None:
        return windows
    return windows.observe(unreadable, F.count_if(F.col("inspected").isNull()).alias("unreadable"))


def unreadable_dates(inspections: DataFrame, date_column: str = "FECHAI1") -> DataFrame:
    """The inspections whose date can't be read, null dates among them: they have no window."""
    return inspections.filter(report_date(F.col(date_column)).isNull())


def outer_window(windows: DataFrame) -> tuple[int, int]:
    """Earliest start and latest stop of all windows; an empty range without windows."""
    earliest, latest = windows.agg(F.min("window_start"), F.max("window_stop")).first()
    return (0, -1) if earliest is None else (earliest, latest)


def own_window(
    readings: DataFrame,
    windows: DataFrame,
    time: str = "date",
    max_rows: int = BROADCAST_ROWS,
    outer: tuple[int, int] | None = None,
) -> DataFrame:
    """Readings inside a window of their own point, both ends inclusive.

    ``time`` is ``date`` for instantaneous readings; for energy readings (``day``) bounds and
    time are compared in whole hours.  Windows of a point that overlap are one span, so a reading
    meets disjoint spans.  The outermost bounds are also a plain range on the stored
    column, which the scan can skip on; ``outer`` is :func:`outer_window` where that is known.
    """
    unit = HOUR_MS if time == "day" else 1
    earliest, latest = outer or outer_window(windows)
    spans = Spans(
        windows,
        "point",
        whole(F.col("window_start"), unit),
        whole(F.col("window_stop"), unit),
    )
    last = latest + unit - 1
    return span_join(
        day_range(readings, earliest, last).filter(F.col(time).between(earliest, last)),
        "measuring_point",
        whole(F.col(time), unit),
        [spans],
        how="left_semi",
        window=(earliest // unit, latest // unit),
        max_rows=max_rows,
    )


def daily_template(
    readings: DataFrame,
    start: int,
    stop: int,
    interval: int,
    magnitudes: Sequence[int],
    tz: str | tzinfo = "UTC",
) -> DataFrame:
    """Energy readings of any point on the day starts ``start, start + 1 day, ... <= stop``."""
    hours = day_start_hours(start, stop, tz)
    first = start // HOUR_MS * HOUR_MS
    last = stop // HOUR_MS * HOUR_MS + HOUR_MS - 1
    if DAY_COLUMN in readings.columns:
        days = sorted({_utc_day(hour * HOUR_MS) for hour in hours})
        readings = readings.filter(F.col(DAY_COLUMN).isin(*days))
    return readings.filter(
        (F.col("measurement_interval") == interval)
        & F.col("magnitude").isin(*magnitudes)
        & F.col("day").between(first, last)
        & whole(F.col("day"), HOUR_MS).isin(*hours)
    )
