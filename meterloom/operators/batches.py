"""Consecutive batches of a list in a fixed order."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.functions.timeslots import whole

RANGE_ROWS = 1_000_000
FEWEST_RANGES = 8


def dealt(rows: DataFrame, order: list[str], ranges: int) -> DataFrame:
    """Rows shuffled into ranges of all their columns, by Spark's own sample; adds ``__range``.

    Rows that share the first column are spread over as many ranges as they need.
    """
    return rows.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id())


def batch_numbers(
    df: DataFrame, order_by: str, size: int, batch: int | None = None, ranges: int | None = None
) -> DataFrame:
    """Number rows by ``order_by`` (then all other columns) and cut them into batches of ``size``.

    Adds ``batch_number``, from 1; with ``batch`` only that batch is produced.  A global row
    number would run in one task, so equal rows are first collapsed to a count, shuffled into
    sampled ranges of the whole order, numbered inside their range, and the totals of earlier
    ranges are added.  There are as many ranges as keep about ``RANGE_ROWS`` rows in each.

    Totals and rows read one shuffle.  Were it made twice, with other samples, ranges would
    disagree; each row's range is compared with the range its total is of, and the query fails then.
    """
    if ranges is None:
        ranges = FEWEST_RANGES + df.count() // RANGE_ROWS
    columns = df.columns
    order = [order_by] + [name for name in columns if name != order_by]
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    ranged = dealt(rows, order, ranges).withColumn("__mark", F.xxhash64(*order))
    inside = Window.partitionBy("__range")
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("__range")
        .agg(F.sum("__copies").alias("__total"), F.bit_xor("__mark").alias("__marks"))
        .select(
            "__range",
            "__total",
            "__marks",
            F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__offset"),
        )
    )
    running = inside.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = (F.col("__total") == F.col("__rows")) & (F.col("__marks") == F.col("__seen"))
    agreed = F.when(same, F.col("__offset")).otherwise(
        F.raise_error(F.lit("ranges differ between the totals and the rows")).cast("bigint")
    )
    placed = (
        ranged.withColumn("__upto", F.sum("__copies").over(running))
        .withColumn("__rows", F.sum("__copies").over(inside))
        .withColumn("__seen", F.bit_xor("__mark").over(inside))
        .join(F.broadcast(offsets), "__range", "left")
        .withColumn("__last", agreed + F.col("__upto"))
        .withColumn("__first", F.col("__last") - F.col("__copies") + 1)
    )
    covered = F.sequence(
        whole(F.col("__first") - 1, size) + 1, whole(F.col("__last") - 1, size) + 1
    )
    spread = placed.withColumn("batch_number", F.explode(covered))
    if batch is not None:
        spread = spread.filter(F.col("batch_number") == batch)
    # one row of very many equal copies covers many batches; its copies are made batch by batch
    here = (
        F.least(F.col("__last"), F.col("batch_number") * size)
        - F.greatest(F.col("__first"), (F.col("batch_number") - 1) * size + 1)
        + 1
    )
    return (
        spread.select(*columns, "batch_number", here.alias("__here"))
        .repartition("batch_number")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__here"))))
        .select(*columns, "batch_number")
    )
