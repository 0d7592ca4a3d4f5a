"""The long extract of indirect measures with the attributes valid at each reading."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions.labels import interval_label
from meterloom.functions.timeslots import DAY_MS, second_timestamp, slot_timestamp
from meterloom.operators.enrich import interval_join, lookup, validity
from meterloom.operators.restrict import hours_range, keep_points, time_window
from meterloom.operators.spans import Spans
from meterloom.operators.spread import BROADCAST_IDS, BROADCAST_ROWS
from meterloom.plans import inventory
from meterloom.plans.inventory import Inventory
from meterloom.schemas import QUARTER_HOUR

# Instantaneous magnitudes reported, and the report headings.
IV_MAGNITUDES = range(1, 25)
HEADINGS = {
    "CODE": "PM",
    "MANAGEMENT": "GERENCIA",
    "OFFICE": "OFICINA",
    "TARIFF_STRUCTURE": "TARIFA",
    "date": "FECHA",
    "DESCRIPTION": "MAGNITUD",
    "measurement_interval": "INTERVALO MEDIDA",
    "value": "VALOR",
    "SOURCE_NAME": "ORIGEN",
    "VOLTAGE_LEVEL": "NIVEL TENSION",
    "BADGE_NUMBER": "BN",
}

CONTRACT_AND_TARIFF = [
    ("SA_START_DATE", "SA_END_DATE"),
    ("TARIFF_STRUCTURE_START_DATE", "TARIFF_STRUCTURE_END_DATE"),
]
EQUIPMENT = [("EQUIP_START_DATE", "EQUIP_END_DATE")]

_READING = ("rowkey", "measuring_point", "magnitude", "measurement_interval", "value", "source")


def instantaneous_part(iv: DataFrame, start: int, stop: int) -> DataFrame:
    reported = time_window(iv, start, stop).filter(F.col("magnitude").isin(*IV_MAGNITUDES))
    return reported.select(
        F.lit("IV").alias("kind"), *_READING, second_timestamp(F.col("date")).alias("date")
    )


def energy_part(om: DataFrame, start: int, stop: int, rollover: bool = False) -> DataFrame:
    return hours_range(om, start, stop, QUARTER_HOUR).select(
        F.lit("OM").alias("kind"),
        *_READING,
        slot_timestamp(F.col("day"), F.col("period"), rollover).alias("date"),
    )


def window_parts(iv: DataFrame, om: DataFrame, start: int, stop: int, rollover: bool = False) -> DataFrame:
    """Both kinds of readings in a window, in one shape."""
    return instantaneous_part(iv, start, stop).unionByName(energy_part(om, start, stop, rollover))


def window_readings(
    iv: DataFrame,
    om: DataFrame,
    points: DataFrame,
    start: int,
    stop: int,
    rollover: bool = False,
    max_rows: int = BROADCAST_IDS,
) -> DataFrame:
    """:func:`window_parts` of the points."""
    return keep_points(window_parts(iv, om, start, stop, rollover), points, max_rows)


def point_spans(history: DataFrame) -> Spans:
    return validity(history, "ID", CONTRACT_AND_TARIFF)


def equipment_spans(equipment: DataFrame) -> Spans:
    return validity(equipment, "ID", EQUIPMENT)


def with_source_name(readings: DataFrame, sources: DataFrame, **settings) -> DataFrame:
    return lookup(readings, sources, {"source": "SOURCE_ID"}, **settings)


def with_magnitude_name(readings: DataFrame, magnitudes: DataFrame, **settings) -> DataFrame:
    """Descriptions by number, and by kind where the dictionary tells kinds apart."""
    on = {"magnitude": "MAGNITUDE_ID"}
    if "kind" in magnitudes.columns:
        on["kind"] = "kind"
    named = lookup(readings, magnitudes, on, **settings)
    return named.withColumn("measurement_interval", interval_label(F.col("measurement_interval")))


def report_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(name).alias(heading) for name, heading in HEADINGS.items()])


def indirect_extract(
    iv: DataFrame,
    om: DataFrame,
    inv: Inventory,
    start: int,
    stop: int,
    legacy_labels: bool = False,
    rollover: bool = False,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All readings of the indirect points in a window, one row per valid set of attributes.

    Histories cover the indirect points only, so joining them restricts the readings too: with
    all spans in one broadcast, or one exchange, there is no other join to the points.

    ``legacy_labels`` names magnitudes by number alone although both kinds share numbers, which
    repeats readings under a wrong description.
    """
    readings = window_parts(iv, om, start, stop, rollover)
    histories = [
        point_spans(inventory.point_history(inv)),
        equipment_spans(inventory.equipment_history(inv)),
    ]
    # slot times lie within a day of the stored day, and that within an hour of the window
    window = (start - 2 * DAY_MS, stop + 2 * DAY_MS)
    keyed = {"max_rows": max_rows, "salt_by": ["rowkey"]}
    return (
        interval_join(readings, histories, window=window, **keyed)
        .transform(with_source_name, inventory.sources(inv), **keyed)
        .transform(with_magnitude_name, inventory.magnitudes(inv, not legacy_labels), **keyed)
        .transform(report_columns)
    )
