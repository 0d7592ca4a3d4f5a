"""Reading and inventory tables."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.schemas import SCHEMAS

# The inventory tables that the plans name.
INVENTORY_TABLES = (
    "measuring_point",
    "measuring_point_group",
    "measuring_point_groupmpoint",
    "measuring_point_technical_data",
    "voltage_level",
    "measuring_point_location_data",
    "owner",
    "measuring_point_commercial",
    "measuring_point_billing_data",
    "tariff_structure",
    "equipment_point_configuration",
    "equipment",
    "source",
    "magnitude",
    "instantaneous_value_magnitude",
    "service_point",
    "meter",
    "inspected_batch",
    "inspected_list",
    "inspection_history",
)


def read_readings(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A reading table with its declared schema; filters and columns reach the Parquet scan."""
    return spark.read.schema(SCHEMAS[kind]).parquet(path)


def read_inventory(spark: SparkSession, base: str) -> Mapping[str, DataFrame]:
    """Inventory tables stored as one Parquet folder each, opened when first asked for."""
    return _Tables(lambda name: spark.read.parquet(f"{base.rstrip('/')}/{name}"))


def jdbc_options(
    url: str,
    table: str,
    *,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for a table or a parenthesised subquery, split over ``column``."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if column is not None:
        if bounds is None:
            raise ValueError("a split column needs its lower and upper bound")
        low, high = bounds
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    """A relational table; give ``column``, ``bounds`` and ``partitions`` for a parallel read."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **settings)).load()


def read_jdbc_inventory(
    spark: SparkSession, url: str, splits: Mapping[str, dict] | None = None, **settings
) -> Mapping[str, DataFrame]:
    """Inventory tables over JDBC; ``splits`` holds per-table split settings."""
    splits = splits or {}
    return _Tables(lambda name: read_jdbc(spark, url, name, **settings, **splits.get(name, {})))


def point_ids(points: DataFrame, column: str = "ID") -> DataFrame:
    """Distinct point ids as bigint (relational ids arrive as decimals), kept distributed."""
    return points.select(F.col(column).cast("bigint").alias("ID")).distinct()


class _Tables(Mapping):
    def __init__(self, opener):
        self._opener = opener
        self._open = {}

    def __getitem__(self, name):
        if name not in INVENTORY_TABLES:
            raise KeyError(name)
        if name not in self._open:
            self._open[name] = self._opener(name)
        return self._open[name]

    def __iter__(self):
        return iter(INVENTORY_TABLES)

    def __len__(self):
        return len(INVENTORY_TABLES)
