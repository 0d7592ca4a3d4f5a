"""CSV and Parquet extracts."""

from collections.abc import Sequence
from datetime import datetime, tzinfo

from pyspark.sql import DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

from meterloom.functions.timeslots import zone

RUN_COLUMN = "run"


def run_stamp(tz: str | tzinfo = "UTC", now: datetime | None = None) -> str:
    """Folder name of a run, ``yyyyMMddHHmm``."""
    return (now or datetime.now(zone(tz))).astimezone(zone(tz)).strftime("%Y%m%d%H%M")


def stamped(directory: str, tz: str | tzinfo = "UTC", now: datetime | None = None) -> str:
    return f"{directory.rstrip('/')}/{run_stamp(tz, now)}"


def arrange(df: DataFrame, sort_by: Sequence[str] | None, num_files: int | None) -> DataFrame:
    """Rows in file order, sorted last so that nothing moves them afterwards.

    With a sort and a file count, files hold consecutive ranges and are sorted inside; one
    file is for extracts known to be small, as a single task then writes everything.
    """
    if sort_by:
        if num_files is None:
            return df.orderBy(*sort_by)
        return df.repartitionByRange(num_files, *sort_by).sortWithinPartitions(*sort_by)
    return df if num_files is None else df.repartition(num_files)


def counted(df: DataFrame, name: str | None = None) -> tuple[DataFrame, Observation]:
    """The frame and an observation of its row count, filled by the write that consumes it.

    Without a name the observation gets one of its own, so that a counted frame may be counted again.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def run_writer(rows: DataFrame, mode: str, run: str | None) -> DataFrameWriter:
    """A writer that appends or overwrites, or with a named ``run`` replaces that run's folder only.

    Rows of a run lie in ``run=<name>``.  Spark moves a folder into place when its job has ended, so a
    run that is repeated after a failure, or by mistake, leaves no doubles and other runs stay.
    """
    if run is None:
        return rows.write.mode(mode)
    named = rows.withColumn(RUN_COLUMN, F.lit(run))
    dynamic = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    return dynamic.partitionBy(RUN_COLUMN)


def write_csv(
    df: DataFrame,
    path: str,
    header: bool = True,
    delimiter: str = ",",
    mode: str = "append",
    num_files: int | None = None,
    sort_by: Sequence[str] | None = None,
    run: str | None = None,
) -> int:
    """The number of rows written, observed after the sort, whose sampling reads the rows a second time."""
    rows, observed = counted(arrange(df, sort_by, num_files))
    run_writer(rows, mode, run).options(header=header, delimiter=delimiter).csv(path)
    return observed.get["rows"]


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "append",
    num_files: int | None = None,
    sort_by: Sequence[str] | None = None,
    run: str | None = None,
) -> int:
    rows, observed = counted(arrange(df, sort_by, num_files))
    run_writer(rows, mode, run).parquet(path)
    return observed.get["rows"]
