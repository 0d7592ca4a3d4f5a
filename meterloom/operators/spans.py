"""Range joins: a reading's time against the validity spans of its point.

The histories of a point are brought together first: spans of different histories that overlap
become one span with the attributes of all, and for a semi join spans that touch become one.
Then each reading meets the spans of its point once, for all histories.  The readings are read
and moved at most once; no job measures them.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.operators.spread import (
    BROADCAST_ROWS,
    SALT,
    copied,
    fits,
    hot_keys,
    row_identity,
    salted,
)

_TIME, _KEY, _LOW, _HIGH = "__time", "__key", "__low", "__high"
_EVER = (1 << 63) - 1


@dataclass(frozen=True)
class Spans:
    """Rows that are valid from ``low`` to ``high`` (bigint expressions) for one ``key``.

    A null ``high`` is an open span, a null ``low`` matches nothing.  The high end is inclusive,
    the low end too unless ``low_open``.
    """

    rows: DataFrame
    key: str
    low: Column
    high: Column
    low_open: bool = False

    @property
    def attributes(self) -> list[str]:
        return [name for name in self.rows.columns if name != self.key]


def span_join(
    readings: DataFrame,
    key: str,
    time: Column,
    sides: Sequence[Spans],
    how: str = "inner",
    window: tuple[int, int] | None = None,
    max_rows: int = BROADCAST_ROWS,
    salt_by: Sequence[str] | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Join readings to the spans of their key that contain their time, for every side.

    Overlapping spans multiply rows.  ``window`` is a known range around the times; spans outside
    it are dropped and others cut to it.  ``how`` is inner, or left_semi with one side.

    The spans are broadcast if there are at most ``max_rows`` of them, counted before.  Otherwise
    both sides are exchanged on the key, and adaptive execution splits a key with many readings,
    as the spans are exchanged for this join alone.  Where that is off, ``hot_rows`` counts the
    readings of each key and salts those above it, which reads them once more.
    """
    if how not in ("inner", "left_semi") or (how == "left_semi" and len(sides) > 1):
        raise ValueError(f"unsupported join {how!r} with {len(sides)} sides")
    spans = [_half_open(side, how, window) for side in sides]
    together = islands(spans[0], _KEY, _LOW, _HIGH) if how == "left_semi" else reduce(_overlaps, spans)
    timed = readings.withColumns({_TIME: time, _KEY: F.col(key)})
    keys = [_KEY]
    if fits(together, max_rows):
        together = F.broadcast(together)
    elif hot_rows is None:
        together = together.hint("rebalance")
    else:
        hot = hot_keys(timed.select(_KEY), keys, hot_rows)
        timed = salted(timed, hot, keys, salt_by or row_identity(readings))
        together, keys = copied(together, hot, keys), [_KEY, SALT]
    right = together.withColumnsRenamed({name: f"{name}__r" for name in keys})
    condition = (F.col(_TIME) > F.col(_LOW)) & (F.col(_TIME) <= F.col(_HIGH))
    for name in keys:
        condition = condition & (F.col(name) == F.col(f"{name}__r"))
    extra = [] if how == "left_semi" else [name for side in sides for name in side.attributes]
    return timed.join(right, condition, how).select(*readings.columns, *extra)


def islands(spans: DataFrame, key: str, low: str, high: str) -> DataFrame:
    """The union of each key's spans (low exclusive, high inclusive) as spans that don't touch.

    A span opens an island if it begins after the furthest end of those before it.
    """
    longest = spans.groupBy(key, low).agg(F.max(high).alias(high))
    ordered = Window.partitionBy(key).orderBy(low)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.col(low) > F.coalesce(F.max(high).over(before), F.col(low) - 1)
    numbered = longest.withColumn("__opens", opens.cast("bigint")).withColumn(
        "__island", F.sum("__opens").over(ordered)
    )
    merged = numbered.groupBy(key, "__island").agg(F.min(low).alias(low), F.max(high).alias(high))
    return merged.select(key, low, high)


def _half_open(side: Spans, how: str, window: tuple[int, int] | None) -> DataFrame:
    """Key, ends (low exclusive, high inclusive, none null) and attributes, cut to the window."""
    attributes = side.attributes if how == "inner" else []
    low = side.low if side.low_open else side.low - 1
    high = F.coalesce(side.high, F.lit(_EVER))
    if window is not None:
        # greatest and least skip nulls
        low = F.when(low.isNotNull(), F.greatest(low, F.lit(window[0] - 1)))
        high = F.least(high, F.lit(window[1]))
    ends = side.rows.select(F.col(side.key).alias(_KEY), low.alias(_LOW), high.alias(_HIGH), *attributes)
    return ends.filter(F.col(_KEY).isNotNull() & (F.col(_LOW) < F.col(_HIGH)))


def _overlaps(left: DataFrame, right: DataFrame) -> DataFrame:
    """The common parts of both histories' spans of a key, with the attributes of both."""
    other = right.withColumnsRenamed({name: f"{name}__r" for name in (_KEY, _LOW, _HIGH)})
    low, high = F.greatest(_LOW, f"{_LOW}__r"), F.least(_HIGH, f"{_HIGH}__r")
    met = left.join(
        other,
        (F.col(_KEY) == F.col(f"{_KEY}__r"))
        & (F.col(_LOW) < F.col(f"{_HIGH}__r"))
        & (F.col(f"{_LOW}__r") < F.col(_HIGH)),
    )
    attributes = [name for name in (*left.columns, *right.columns) if name not in (_KEY, _LOW, _HIGH)]
    return met.select(_KEY, low.alias(_LOW), high.alias(_HIGH), *attributes)
