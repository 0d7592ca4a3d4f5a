"""Times of readings: epoch milliseconds, quarter-hour slots, report dates."""

from datetime import datetime, timedelta, tzinfo
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP_MS = 15 * 60 * 1000
HOUR_MS = 60 * 60 * 1000
DAY_MS = 24 * HOUR_MS


def whole(numerator: Column, denominator: int | Column) -> Column:
    """Integer division, truncated, on bigints."""
    divisor = denominator if isinstance(denominator, Column) else F.lit(denominator)
    return F.call_function("div", numerator, divisor)


def epoch_seconds(ms: Column) -> Column:
    """Epoch milliseconds to epoch seconds, kept as bigint so that it does not end in 2038."""
    return whole(ms, 1000)


def second_timestamp(ms: Column) -> Column:
    return F.timestamp_seconds(epoch_seconds(ms))


def day_of(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))


def date_ms(date: Column) -> Column:
    """Start of a date, in the session zone, as epoch milliseconds."""
    return F.unix_millis(date.cast("timestamp"))


def date_hours(date: Column) -> Column:
    return whole(date_ms(date), HOUR_MS)


def snap(ms: Column, step: int = STEP_MS) -> Column:
    """Floor a time to its grid step; an optional step before the exact-match grid join."""
    return ms - F.pmod(ms, F.lit(step))


def slot_ms(day: Column, period: Column) -> Column:
    """Day start plus quarter-hour number; period 96 is midnight of the *next* day."""
    return day + period.cast("bigint") * F.lit(STEP_MS)


def _wrapped_hour(period: Column) -> Column:
    hour = whole(period, 4)
    return F.when(hour == 24, F.lit(0)).otherwise(hour)


def slot_text(date: Column, period: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` of a period; hour 24 is written as 00:00 of the *same* day."""
    return F.format_string(
        "%s %02d:%02d",
        F.substring(date.cast("string"), 1, 10),
        _wrapped_hour(period),
        (period % 4) * 15,
    )


def slot_timestamp(day: Column, period: Column, rollover: bool = False) -> Column:
    """Timestamp of a period, with either convention for period 96.

    The wrapping form has no value past hour 24, as such a text would not parse.
    """
    if rollover:
        return F.timestamp_millis(slot_ms(day, period))
    minutes = _wrapped_hour(period) * 60 + (period % 4) * 15
    instant = date_ms(day_of(day)) + minutes.cast("bigint") * F.lit(60 * 1000)
    return F.when(whole(period, 4) <= 24, F.timestamp_millis(instant))


def slot_text_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm"))


def report_date(text: Column) -> Column:
    """``dd/MM/yyyy`` text to a date; unreadable text gives null."""
    return F.try_to_timestamp(text, F.lit("d/M/yyyy")).cast("date")


def compact_date(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd")


def zone(tz: str | tzinfo) -> tzinfo:
    return ZoneInfo(tz) if isinstance(tz, str) else tz


def argument_ms(text: str, tz: str | tzinfo = "UTC") -> int:
    """A job argument ``yyyyMMddHHmm`` in a stated zone, as epoch milliseconds."""
    moment = datetime.strptime(text, "%Y%m%d%H%M").replace(tzinfo=zone(tz))
    return int(moment.timestamp()) * 1000


def day_start_hours(start: int, stop: int, tz: str | tzinfo = "UTC") -> list[int]:
    """Epoch hours of ``start`` and every following calendar day up to ``stop`` inclusive.

    One element per day of the window, so the list is bounded by the window, not by the data.
    """
    local = datetime.fromtimestamp(start / 1000, zone(tz))
    hours = []
    while local.timestamp() * 1000 <= stop:
        hours.append(int(local.timestamp()) // 3600)
        local += timedelta(days=1)
    return hours
