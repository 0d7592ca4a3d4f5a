"""A bounded sample of labelled rows, to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import checked_broadcast

_RANGE = 1 << 30


def bounded_sample(rows: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """About per_label rows of each label at most, the same in every run: those of least hashed key.

    Labels are counted first (a row per label), so the sample is bounded at every input size."""
    counts = rows.groupBy(label).agg(F.count("*").alias("__n"))
    shares = counts.select(F.col(label).cast("string").alias("__label"), (F.least(F.lit(1.0), per_label / F.col("__n")) * _RANGE).alias("__share"))
    joined = rows.join(checked_broadcast(shares, "__label"), F.col(label).cast("string") == F.col("__label"))
    return joined.filter(F.pmod(F.xxhash64(key, F.lit(11)), F.lit(_RANGE)) < F.col("__share")).drop("__label", "__share")
