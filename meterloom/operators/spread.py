"""Joins that hold when one key carries a large share of the rows.

A small side is broadcast only after its row count was checked.  Otherwise the join shuffles, and
keys with very many rows are split: the big side is divided into salts by a hash of its own
columns and the other side is copied once per salt, for those keys only.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000  # rows of a few columns
BROADCAST_IDS = 2_000_000  # rows of one bigint
HOT_ROWS = 2_000_000
HOT_SHARE = 2_000_000  # a key with more than this share of all rows is hot at any size

NULL_SALTS = 4096

SALT = "__salt"
_SALTS = "__salts"


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame has at most ``max_rows`` rows, by a count that is summed per partition."""
    return max_rows > 0 and df.count() <= max_rows


def row_identity(readings: DataFrame) -> list[str] | None:
    """Columns to salt readings by: their unique row key, where it is carried along."""
    return ["rowkey"] if "rowkey" in readings.columns else None


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every key above ``hot_rows`` rows and above one ``HOT_SHARE``-th of all rows, with the number
    of salts it needs.

    Fewer than ``HOT_SHARE`` keys can exceed that share, so the result may be broadcast and no key
    is left out; an unsplit key has at most ``hot_rows`` rows or that share.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    share = counts.agg(F.floor(F.sum("__rows") / HOT_SHARE)).scalar()
    limit = F.greatest(F.lit(hot_rows), share)
    return counts.filter(F.col("__rows") > limit).select(
        *keys, F.ceil(F.col("__rows") / limit).cast("bigint").alias(_SALTS)
    )


def salted(
    big: DataFrame, hot: DataFrame, keys: Sequence[str], salt_by: Sequence[str] | None = None
) -> DataFrame:
    """Adds the salt of each row of the big side.

    ``salt_by`` should name columns that tell rows of one key apart (the row key of a reading);
    all columns by default.  The salt is a pure function of the row, so a recomputed task sends
    every row to the same place.
    """
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    # a null key meets nothing, so such rows may go anywhere
    salts = F.when(missing, F.lit(NULL_SALTS)).otherwise(F.coalesce(F.col(_SALTS), F.lit(1)))
    return (
        big.join(F.broadcast(hot), list(keys), "left")
        .withColumn(SALT, F.pmod(F.xxhash64(*(salt_by or big.columns)), salts))
        .drop(_SALTS)
    )


def copied(small: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Copies rows of hot keys once per salt."""
    last = F.coalesce(F.col(_SALTS), F.lit(1)) - 1
    return (
        small.join(F.broadcast(hot), list(keys), "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .drop(_SALTS)
    )


def bounded_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    salt_by: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join on common column names: checked broadcast, else a shuffle with hot keys split.

    ``how`` is inner, left or left_semi, the kinds for which copying the small side is exact.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join kind {how!r}")
    if fits(small, max_rows):
        joined = big.join(F.broadcast(small), list(keys), how)
    else:
        hot = hot_keys(big, keys, hot_rows)
        left, right = salted(big, hot, keys, salt_by), copied(small, hot, keys)
        joined = left.join(right, [*keys, SALT], how)
    added = [name for name in small.columns if name not in keys and how != "left_semi"]
    return joined.select(*big.columns, *added)
