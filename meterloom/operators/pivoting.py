"""Magnitudes to columns."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HAS = "__has_"


def pivot_max(
    readings: DataFrame,
    keys: Sequence[str],
    names: Mapping[int, str],
    magnitude: str = "magnitude",
    value: str = "value",
    presence: bool = False,
) -> DataFrame:
    """One column per named magnitude, holding the largest value per key.

    Conditional maxima need one exchange on the keys, with partial aggregation before it; the
    column list is fixed, so no job is spent on finding the magnitudes.  ``presence`` adds a flag
    per magnitude, true where a reading carries it, whatever its value: see :func:`absent_as`.
    """
    carried = {name: F.col(magnitude) == number for number, name in names.items()}
    flags = [F.max(F.when(test, True)).alias(_HAS + name) for name, test in carried.items()]
    return readings.groupBy(*keys).agg(
        *[F.max(F.when(test, F.col(value))).alias(name) for name, test in carried.items()],
        *(flags if presence else []),
    )


def presence_flags(names: Mapping[int, str]) -> list[str]:
    return [_HAS + name for name in names.values()]


def filled_where_absent(
    rows: DataFrame, found: Column, names: Mapping[int, str], fill: float
) -> DataFrame:
    """``fill`` in the columns whose field of ``found``, a struct of booleans, is false."""
    return rows.withColumns(
        {
            name: F.when(found.getField(name), F.col(name)).otherwise(F.lit(fill))
            for name in names.values()
        }
    )


def absent_as(wide: DataFrame, names: Mapping[int, str], fill: float = -1.0) -> DataFrame:
    """Fill a column whose magnitude occurs nowhere; absent cells stay null.

    ``wide`` is pivoted with ``presence``.  The flags are reduced from the pivot's own exchange,
    so the readings are not read again: both branches keep all pivoted columns, as the counts of
    values and the test of flags that are never false can't be optimised away.
    """
    flags = presence_flags(names)
    seen = [F.coalesce(F.max(_HAS + name), F.lit(False)).alias(name) for name in names.values()]
    counts = [F.count(name).alias(f"__n_{name}") for name in names.values()]
    found = wide.agg(F.struct(*seen, *counts).alias("found")).scalar()
    kept = wide
    for flag in flags:
        kept = kept.filter(F.coalesce(flag, F.lit(True)))
    return filled_where_absent(kept, found, names, fill).drop(*flags)
