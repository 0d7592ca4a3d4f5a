"""Regular time grids per point and their fill with readings."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.functions.timeslots import STEP_MS, whole

PACK = 96  # slots that travel in one row
NOWHERE = -(1 << 63)  # the key of rows without point or time

FIRST, LAST, CELLS = "__first", "__last", "__cells"
_REST, _START, _LOW, _HIGH = "__rest", "__start", "__low", "__high"


def time_bounds(readings: DataFrame, point: str = "measuring_point", time: str = "date") -> DataFrame:
    """First and last time of every point."""
    return readings.groupBy(point).agg(
        F.min(time).alias("min_date"), F.max(time).alias("max_date")
    )


def time_axis(spark, start: int, stop: int, step: int = STEP_MS) -> DataFrame:
    """The slots ``start, start + step, ... < stop`` of a window."""
    return spark.range(start, stop, step).withColumnRenamed("id", "slot")


def clipped_ends(bounds: DataFrame, start: int, stop: int, step: int = STEP_MS) -> DataFrame:
    """First and last slot of the axis ``[start, stop)`` between a point's own bounds, if any."""
    origin, width = F.lit(start).cast("bigint"), F.lit(step).cast("bigint")
    ahead = F.greatest(F.col("min_date") - origin, F.lit(0).cast("bigint"))
    first = origin + whole(ahead + width - 1, width) * width
    last = F.least(F.col("max_date"), F.lit(stop - 1).cast("bigint"))
    kept = [name for name in bounds.columns if name not in ("min_date", "max_date")]
    return bounds.select(*kept, first.alias(FIRST), last.alias(LAST)).filter(F.col(FIRST) <= F.col(LAST))


def clipped_grid(bounds: DataFrame, start: int, stop: int, step: int = STEP_MS) -> DataFrame:
    """Slots of the axis ``[start, stop)`` that lie between a point's own bounds.

    Slots are generated per point, so no axis is joined.
    """
    ends = clipped_ends(bounds, start, stop, step)
    width = F.lit(step).cast("bigint")
    slots = F.explode(F.sequence(F.col(FIRST), F.col(LAST), width)).alias("slot")
    return ends.select(*[name for name in ends.columns if name not in (FIRST, LAST)], slots)


def own_window_ends(windows: DataFrame) -> DataFrame:
    """The ends of each window as first and last slot, both inclusive."""
    ends = windows.withColumnsRenamed({"window_start": FIRST, "window_stop": LAST})
    return ends.filter(F.col(FIRST) <= F.col(LAST))


def own_window_grid(windows: DataFrame, step: int = STEP_MS) -> DataFrame:
    """Slots from the start to the stop of each window, both inclusive."""
    slots = F.sequence(F.col("window_start"), F.col("window_stop"), F.lit(step).cast("bigint"))
    return windows.filter(F.col("window_start") <= F.col("window_stop")).withColumn(
        "slot", F.explode(slots)
    )


def fill_grid(
    grid: DataFrame, wide: DataFrame, point: str, time: str, wide_point: str = "measuring_point"
) -> DataFrame:
    """Every slot with the values read exactly then, null where there are none.

    Both sides meet on (point, slot), so a busy point is spread over its slots.
    """
    right = wide.withColumnsRenamed({wide_point: "__point", time: "__time"})
    joined = grid.join(
        right, (F.col(point) == F.col("__point")) & (F.col("slot") == F.col("__time")), "left"
    )
    return joined.drop("__point", "__time")


def _pack_start(time: Column, step: int) -> Column:
    return time - F.pmod(time, F.lit(PACK * step))


def packed(
    wide: DataFrame, point: str, time: str, values: Sequence[str], step: int = STEP_MS
) -> DataFrame:
    """Pivoted rows packed by point and ``PACK`` slots, a day of quarter-hours.

    A row holds the cells, (slot, values), of one point whose times leave the same remainder by
    the step and lie in one pack: ``PACK`` cells at most, however many readings are off a grid.
    All that is asked of packs comes from that one array, and no time is null as a key
    (``NOWHERE`` stands for null).  If no point is null either, the optimizer finds nothing to push
    into one branch of a plan only, and every branch reads the same exchange.
    """
    at = F.col(time)
    cell = F.struct(at.alias("slot"), *values)
    return wide.groupBy(
        point,
        F.coalesce(F.pmod(at, F.lit(step)), F.lit(NOWHERE)).alias(_REST),
        F.coalesce(_pack_start(at, step), F.lit(NOWHERE)).alias(_START),
    ).agg(F.collect_list(cell).alias(CELLS))


def packed_bounds(packs: DataFrame, point: str) -> DataFrame:
    """:func:`time_bounds` from packs; cells without a time bound nothing."""
    bounds = packs.groupBy(point).agg(
        F.min(F.array_min(CELLS).getField("slot")).alias("min_date"),
        F.max(F.array_max(CELLS).getField("slot")).alias("max_date"),
    )
    return bounds.filter(F.col("min_date").isNotNull())


def packed_presence(packs: DataFrame, flags: Mapping[str, str]) -> Column:
    """A struct of booleans: whether any cell has each flag (names to columns)."""

    def carried(flag: str) -> Column:
        return F.exists(CELLS, lambda cell: F.coalesce(cell.getField(flag), F.lit(False)))

    seen = [
        F.coalesce(F.max(carried(flag)), F.lit(False)).alias(name) for name, flag in flags.items()
    ]
    return packs.agg(F.struct(*seen).alias("found")).scalar()


def fill_packed(
    ends: DataFrame,
    packs: DataFrame,
    point: str,
    values: Sequence[str],
    step: int = STEP_MS,
    pack_point: str = "measuring_point",
) -> DataFrame:
    """Every slot from the first to the last with the values read exactly then, null where none are.

    ``ends`` has the point and first and last slot, as from :func:`clipped_ends`.  It meets the
    packs on (point, remainder, pack), one row for ``PACK`` slots; slots appear only afterwards,
    in the task that writes them on.  A busy point is spread over its packs.
    """
    width = F.lit(PACK * step).cast("bigint")
    first, last, start = F.col(FIRST), F.col(LAST), F.col(_START)
    kept = [name for name in ends.columns if name not in (FIRST, LAST)]
    starts = F.sequence(_pack_start(first, step), _pack_start(last, step), width)
    wanted = ends.select(
        *kept, FIRST, LAST, F.pmod(first, F.lit(step)).alias(_REST), F.explode(starts).alias(_START)
    )
    # the times beside the cells, once a pack: a slot's cell is found by its place among them
    right = packs.select(
        F.col(pack_point).alias("__point"),
        F.col(_REST).alias("__rest_r"),
        F.col(_START).alias("__start_r"),
        CELLS,
        F.col(CELLS).getField("slot").alias("__times"),
    )
    joined = wanted.join(
        right,
        (F.col(point) == F.col("__point"))
        & (F.col(_REST) == F.col("__rest_r"))
        & (start == F.col("__start_r")),
        "left",
    )
    low = F.greatest(first, start + F.col(_REST))
    high = F.least(last, start + F.col(_REST) + F.lit((PACK - 1) * step))
    ranged = joined.select(*kept, low.alias(_LOW), high.alias(_HIGH), CELLS, "__times").filter(
        F.col(_LOW) <= F.col(_HIGH)
    )
    slots = F.sequence(F.col(_LOW), F.col(_HIGH), F.lit(step).cast("bigint"))
    filled = ranged.select(*kept, F.explode(slots).alias("slot"), CELLS, "__times")
    place = F.array_position("__times", F.col("slot")) - 1
    cell = F.get(CELLS, place.cast("int"))
    return filled.select(*kept, "slot", *[cell.getField(name).alias(name) for name in values])
