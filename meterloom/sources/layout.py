"""Layouts of reading tables that restrictions and aggregations can make use of.

By day: a folder for each UTC day of the stored time, in ``reading_day``.  Restrictions to a window
add the same range of days (see ``operators.restrict.day_range``), so other folders are not listed
as input at all.

By point: buckets on ``measuring_point``, each sorted by time.  Whatever is grouped by point, or by
point and anything else, needs no exchange, and row groups outside a window of time are skipped.  All
readings of a point lie in one bucket and are read by one task: the layout is for meters that
report alike.  Both may be combined.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.timeslots import DAY_MS, whole
from meterloom.schemas import DAY_COLUMN, SCHEMAS, TIMES


def with_day(readings: DataFrame, kind: str) -> DataFrame:
    """Readings with the UTC day of their stored time."""
    time = F.col(TIMES[kind])
    days = whole(time - F.pmod(time, F.lit(DAY_MS)), DAY_MS)
    return readings.withColumn(DAY_COLUMN, F.date_from_unix_date(days.cast("int")))


def write_by_day(readings: DataFrame, path: str, kind: str, mode: str = "append") -> None:
    """Parquet folders by day, sorted by point and time; a day of many readings is several files."""
    keys = [DAY_COLUMN, "measuring_point", TIMES[kind]]
    rows = with_day(readings, kind).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows.write.mode(mode).partitionBy(DAY_COLUMN).parquet(path)


def save_bucketed(
    readings: DataFrame,
    table: str,
    kind: str,
    buckets: int,
    path: str | None = None,
    by_day: bool = False,
    row_group_bytes: int | None = None,
) -> None:
    """A table of Parquet buckets, one file for a bucket (and day)."""
    rows = with_day(readings, kind) if by_day else readings
    # the exchange deals rows out as buckets do, so that each task writes one bucket
    writer = rows.repartition(buckets, "measuring_point").write.format("parquet").mode("overwrite")
    writer = writer.bucketBy(buckets, "measuring_point").sortBy(TIMES[kind])
    if by_day:
        writer = writer.partitionBy(DAY_COLUMN)
    if path is not None:
        writer = writer.option("path", path)
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.saveAsTable(table)


def open_bucketed(
    spark: SparkSession, table: str, path: str, kind: str, buckets: int, by_day: bool = False
) -> DataFrame:
    """The table of files that :func:`save_bucketed` wrote to ``path``, also in another session."""
    columns = [f"`{field.name}` {field.dataType.simpleString()}" for field in SCHEMAS[kind]]
    if by_day:
        columns.append(f"{DAY_COLUMN} date")
    days = f"PARTITIONED BY ({DAY_COLUMN})" if by_day else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) USING parquet {days} "
        f"CLUSTERED BY (measuring_point) SORTED BY ({TIMES[kind]}) INTO {buckets} BUCKETS "
        f"LOCATION '{path}'"
    )
    if by_day:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)
