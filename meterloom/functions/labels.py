"""Text labels and gap marks of the extracts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterloom.schemas import QUARTER_HOUR


def interval_label(interval: Column) -> Column:
    """1 is shown as QH, another code as its number, an unknown one as INSTANTANEO."""
    return (
        F.when(interval.isNull(), F.lit("INSTANTANEO"))
        .when(interval == QUARTER_HOUR, F.lit("QH"))
        .otherwise(interval.cast("string"))
    )


def gap_text(value: Column) -> Column:
    """The value as text, NaN where the slot has no reading."""
    return F.coalesce(value.cast("string"), F.lit("NaN"))
