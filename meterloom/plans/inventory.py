"""Queries over the relational inventory, as joins of its tables.

``inv`` maps table names to DataFrames (see ``sources.tables``).  Joins of point to point tables
carry no hint: their keys spread, and Spark picks broadcast or shuffle by size.  Dictionaries of a
few codes (offices, voltages, tariffs) go through a checked broadcast instead, as a shuffle on so
few keys would leave most tasks idle.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.functions.timeslots import compact_date, report_date
from meterloom.operators.batches import batch_numbers
from meterloom.operators.spread import bounded_join

Inventory = Mapping[str, DataFrame]

# Batch size, plate prefix and phase text of the inventory queries.
BATCH_SIZE = 15_000
PLATE_PREFIX = "070"
THREE_PHASE = "TRIFASICO"


def _points_in_group(inv: Inventory, group: str) -> DataFrame:
    chosen = inv["measuring_point_group"].filter(F.col("code") == group)
    members = bounded_join(
        inv["measuring_point_groupmpoint"],
        chosen.select(F.col("id").alias("measuring_point_group")),
        ["measuring_point_group"],
    )
    points = inv["measuring_point"].select("id", "code")
    return points.join(members, points["id"] == members["measuring_point"])


def points_by_group(inv: Inventory, group: str) -> DataFrame:
    """(ID, CODE) of the points of a group."""
    return _points_in_group(inv, group).select(F.col("id").alias("ID"), F.col("code").alias("CODE"))


def points_by_group_and_phase(inv: Inventory, group: str, phase: int) -> DataFrame:
    """(ID, CODE) of the points of a group with a phase type (0 single, 1 three-phase)."""
    phased = inv["measuring_point_technical_data"].filter(F.col("phase_type") == phase)
    return (
        points_by_group(inv, group)
        .join(phased.select(F.col("measuring_point").alias("ID")), "ID")
        .select("ID", "CODE")
    )


def _plated(service_points: DataFrame) -> DataFrame:
    return service_points.filter(F.col("numero_placa").startswith(PLATE_PREFIX))


def points_by_plate(inv: Inventory) -> DataFrame:
    """Distinct (ID, CODE) of the points whose meter plate has the prefix."""
    plated = _plated(inv["service_point"]).select(F.col("punto_servicio").alias("code"))
    return (
        inv["measuring_point"]
        .join(plated, "code")
        .select(F.col("id").alias("ID"), F.col("code").alias("CODE"))
        .distinct()
    )


def _indirect_ids(inv: Inventory) -> DataFrame:
    scaled = inv["equipment_point_configuration"].filter(F.col("reading_constant") > 1)
    return scaled.select(F.col("measuring_point").alias("id")).distinct()


def indirect_points(inv: Inventory) -> DataFrame:
    """Distinct ID of the points read through a transformer (reading constant above 1)."""
    return (
        inv["measuring_point"]
        .join(_indirect_ids(inv), "id", "left_semi")
        .select(F.col("id").alias("ID"))
        .distinct()
    )


def _inspection_list(inv: Inventory) -> DataFrame:
    return inv["inspected_batch"].select(
        F.col("punto_medida_interno").alias("PUNTO_MEDIDA_INTERNO"),
        F.col("punto_servicio").alias("PUNTO_SERVICIO"),
        F.col("fechai1").alias("FECHAI1"),
    )


def inspection_batches(inv: Inventory, size: int = BATCH_SIZE) -> DataFrame:
    """The inspection list cut into batches in point order, with ``batch_number``."""
    return batch_numbers(_inspection_list(inv), "PUNTO_MEDIDA_INTERNO", size)


def inspected_points(
    inv: Inventory, batch: int | None = None, size: int = BATCH_SIZE
) -> DataFrame:
    """One batch of the inspection list, or all of it."""
    listed = _inspection_list(inv)
    if batch is None:
        return listed
    return batch_numbers(listed, "PUNTO_MEDIDA_INTERNO", size, batch).drop("batch_number")


def inspection_dates(inspections: DataFrame, id_column: str = "PUNTO_SERVICIO") -> DataFrame:
    """Inspections reduced to (PM, DATE as yyyyMMdd)."""
    date = compact_date(report_date(F.col("FECHAI1")))
    return inspections.select(F.col(id_column).alias("PM"), date.alias("DATE"))


def inspections_with_points(inv: Inventory) -> DataFrame:
    """Distinct (PUNTO_MEDIDA_MDM, PUNTO_SERVICIO, FECHAI1) of the inspected points."""
    points = inv["measuring_point"].select(
        F.col("id").alias("PUNTO_MEDIDA_MDM"), F.col("code").alias("punto_servicio")
    )
    return (
        points.join(inv["inspected_list"], "punto_servicio")
        .select(
            "PUNTO_MEDIDA_MDM",
            F.col("punto_servicio").alias("PUNTO_SERVICIO"),
            F.col("fechai1").alias("FECHAI1"),
        )
        .distinct()
    )


def _three_phase_installs(inv: Inventory) -> DataFrame:
    """Plated three-phase service points with the install dates of their meter."""
    three_phase = _plated(inv["service_point"]).filter(F.trim("fases") == F.lit(THREE_PHASE))
    installed = inv["meter"].filter(F.col("fecha_desde").isNotNull())
    return three_phase.join(installed, "numero_placa").select("punto_servicio", "fecha_desde")


def count_three_phase_points(inv: Inventory) -> DataFrame:
    """Number of plated three-phase points with a known install date."""
    return _three_phase_installs(inv).agg(F.countDistinct("punto_servicio").alias("points"))


def latest_inspections(inv: Inventory) -> DataFrame:
    """The most recent inspection dates per point code, from the newest extraction day.

    Rows of one code and date are collapsed before ranking, so a rank group holds no more rows
    than a point has inspection dates.
    """
    history = inv["inspection_history"].withColumn("extracted", report_date(F.col("fecha")))
    newest = history.agg(F.max("extracted").alias("newest")).scalar()
    current = history.filter((F.col("extracted") == newest) & F.col("fechai1").isNotNull())
    dated = current.groupBy("id", "fechai1").agg(F.max("commit_dttm").alias("commit_dttm"))
    recent = Window.partitionBy("id").orderBy(F.desc("commit_dttm"))
    return (
        dated.withColumn("date_rank", F.dense_rank().over(recent))
        .filter(F.col("date_rank") == 1)
        .select("id", "fechai1")
    )


def inspected_three_phase_points(inv: Inventory) -> DataFrame:
    """Distinct (PUNTO_SERVICIO as point id, FECHAI1) of latest inspections made on or after the
    install date of the point's three-phase meter."""
    latest = latest_inspections(inv).withColumn("inspected", report_date(F.col("fechai1")))
    installs = _three_phase_installs(inv).groupBy("punto_servicio").agg(
        F.min("fecha_desde").alias("fecha_desde")
    )
    after_install: Column = (latest["id"] == installs["punto_servicio"]) & (
        latest["inspected"] >= installs["fecha_desde"]
    )
    valid = latest.join(installs, after_install, "left_semi")
    points = inv["measuring_point"].select(F.col("id").alias("PUNTO_SERVICIO"), "code").distinct()
    return (
        points.join(valid, points["code"] == valid["id"])
        .select("PUNTO_SERVICIO", F.col("fechai1").alias("FECHAI1"))
        .distinct()
    )


def point_history(inv: Inventory) -> DataFrame:
    """Contract, tariff, office and voltage history of the indirect points."""
    points = inv["measuring_point"].join(_indirect_ids(inv), "id", "left_semi")
    location = inv["measuring_point_location_data"].select(
        F.col("id").alias("location_data"), "owner"
    )
    owner = inv["owner"].select(
        F.col("id").alias("owner"), F.col("code").alias("OFFICE"), F.col("management").alias("MANAGEMENT")
    )
    commercial = inv["measuring_point_commercial"].select(
        F.col("id").alias("commercial_data"),
        F.col("measuring_point").alias("ID"),
        F.col("start_date").alias("SA_START_DATE"),
        F.col("end_date").alias("SA_END_DATE"),
    )
    billing = inv["measuring_point_billing_data"].select(
        "commercial_data",
        "tariff_structure",
        F.col("tariff_structure_start_date").alias("TARIFF_STRUCTURE_START_DATE"),
        F.col("tariff_structure_end_date").alias("TARIFF_STRUCTURE_END_DATE"),
    )
    tariff = inv["tariff_structure"].select(
        F.col("id").alias("tariff_structure"), F.col("code").alias("TARIFF_STRUCTURE_CODE")
    )
    technical = inv["measuring_point_technical_data"].select(
        F.col("measuring_point").alias("ID"), "voltage_level"
    )
    voltage = inv["voltage_level"].select(
        F.col("id").alias("voltage_level"), F.col("code").alias("VOLTAGE_LEVEL_CODE")
    )
    return (
        points.select(F.col("id").alias("ID"), F.col("code").alias("CODE"), "location_data")
        .join(location, "location_data")
        .transform(bounded_join, owner, ["owner"])
        .join(technical, "ID")
        .transform(bounded_join, voltage, ["voltage_level"])
        .join(commercial, "ID")
        .join(billing, "commercial_data")
        .transform(bounded_join, tariff, ["tariff_structure"])
        .select(
            "ID",
            "CODE",
            "MANAGEMENT",
            "OFFICE",
            F.col("TARIFF_STRUCTURE_CODE").alias("TARIFF_STRUCTURE"),
            "SA_START_DATE",
            "SA_END_DATE",
            "TARIFF_STRUCTURE_START_DATE",
            "TARIFF_STRUCTURE_END_DATE",
            F.col("VOLTAGE_LEVEL_CODE").alias("VOLTAGE_LEVEL"),
        )
    )


def equipment_history(inv: Inventory) -> DataFrame:
    """Equipment spans (ID, EQUIP_START_DATE, EQUIP_END_DATE, BADGE_NUMBER) of indirect points."""
    points = inv["measuring_point"].select("id").join(_indirect_ids(inv), "id", "left_semi")
    fitted = inv["equipment_point_configuration"].select(
        F.col("measuring_point").alias("id"), "equipment", "start_date", "end_date"
    )
    equipment = inv["equipment"].select(F.col("id").alias("equipment"), "code")
    return (
        points.join(fitted, "id")
        .join(equipment, "equipment")
        .select(
            F.col("id").alias("ID"),
            F.col("start_date").alias("EQUIP_START_DATE"),
            F.col("end_date").alias("EQUIP_END_DATE"),
            F.col("code").alias("BADGE_NUMBER"),
        )
    )


def sources(inv: Inventory) -> DataFrame:
    return inv["source"].select(F.col("id").alias("SOURCE_ID"), F.col("name").alias("SOURCE_NAME"))


def magnitudes(inv: Inventory, with_kind: bool = False) -> DataFrame:
    """Distinct (MAGNITUDE_ID, DESCRIPTION) of both dictionaries.

    Their numbers overlap; ``with_kind`` adds ``kind`` (OM or IV) so that a join can tell them apart.
    """

    def entries(table, kind):
        tag = [F.lit(kind).alias("kind")] if with_kind else []
        return inv[table].select(*tag, F.col("id").alias("MAGNITUDE_ID"), F.col("description").alias("DESCRIPTION"))

    return (
        entries("magnitude", "OM")
        .unionByName(entries("instantaneous_value_magnitude", "IV"))
        .distinct()
    )
