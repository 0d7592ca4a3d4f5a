"""Point-in-time attributes and dictionary look-ups."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.operators.spans import Spans, span_join
from meterloom.operators.spread import BROADCAST_ROWS, bounded_join


def validity(history: DataFrame, key: str, intervals: Sequence[tuple[str, str]]) -> Spans:
    """History rows valid while all their intervals hold.

    An interval holds after its start, up to and including its end, a null end being open;
    several are one span from the latest start to the earliest end.  In epoch microseconds.
    """
    starts = [F.unix_micros(F.col(begin).cast("timestamp")) for begin, _ in intervals]
    ends = [F.unix_micros(F.col(end).cast("timestamp")) for _, end in intervals]
    known = history.dropna(subset=[begin for begin, _ in intervals])
    return Spans(
        known,
        key,
        F.greatest(*starts) if len(starts) > 1 else starts[0],
        F.least(*ends) if len(ends) > 1 else ends[0],
        low_open=True,
    )


def interval_join(
    readings: DataFrame,
    histories: Sequence[Spans],
    key: str = "measuring_point",
    time: str = "date",
    window: tuple[int, int] | None = None,
    **settings,
) -> DataFrame:
    """Attach to each reading the rows of every history that are valid at its timestamp.

    ``window`` is a known range around the times, in epoch ms.
    """
    micros = None if window is None else (window[0] * 1000, window[1] * 1000)
    return span_join(
        readings, key, F.unix_micros(F.col(time)), histories, window=micros, **settings
    )


def lookup(
    readings: DataFrame,
    dictionary: DataFrame,
    on: dict[str, str],
    max_rows: int = BROADCAST_ROWS,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Inner join to a dictionary; ``on`` maps reading columns to dictionary columns."""
    renamed = dictionary.withColumnsRenamed({theirs: ours for ours, theirs in on.items()})
    return bounded_join(readings, renamed, list(on), "inner", max_rows, salt_by)
