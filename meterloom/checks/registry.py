"""The registered check queries, each over whole test tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.checks.fixtures import Fixtures
from meterloom.functions.keys import iv_row_key, om_row_key
from meterloom.functions.labels import interval_label
from meterloom.functions.timeslots import (
    STEP_MS,
    argument_ms,
    slot_ms,
    slot_text,
    day_of,
    slot_timestamp,
    snap,
)
from meterloom.operators.enrich import interval_join
from meterloom.operators.grid import clipped_grid, own_window_grid, time_bounds
from meterloom.operators.pivoting import absent_as, pivot_max
from meterloom.operators.restrict import (
    daily_template,
    inspection_windows,
    own_window,
    points_hours,
    points_window,
)
from meterloom.plans import curves, extract, inventory
from meterloom.schemas import DAY_COLUMN, ENERGY_COLUMNS, THREE_PHASE_COLUMNS
from meterloom.sources.cells import decode_batches, decode_cells, gather_cells

START = argument_ms("202401050000")
STOP = argument_ms("202401200000")
GROUP = "BUILDING"
BATCH_SIZE = 40

_QUERIES = {}


def check(function):
    """Register a query; it gets the fixtures of a data folder."""

    def run(spark: SparkSession, base: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(Fixtures(spark, str(base).rstrip("/")))

    _QUERIES[function.__name__] = run
    return function


def queries():
    return dict(_QUERIES)


# curves


@check
def grid_energy_curve(f):
    return curves.energy_curves(f.om, inventory.points_by_group(f, GROUP), START, STOP)


@check
def grid_energy_curve_text(f):
    points = inventory.points_by_group(f, GROUP)
    return curves.energy_curves(f.om, points, START, STOP, gaps="text", absent=None)


@check
def grid_energy_curve_raw_ids(f):
    return curves.energy_curves(f.om, None, START, STOP)


@check
def grid_energy_curve_missing_magnitude(f):
    return curves.energy_curves(f.om_missing, None, START, STOP)


@check
def grid_iv_curve_triphasic(f):
    return curves.iv_curves(f.iv, inventory.points_by_plate(f), START, STOP)


@check
def grid_iv_curve_monophasic(f):
    return curves.iv_curves(f.iv, inventory.points_by_plate(f), START, STOP, phases=1)


@check
def grid_iv_curve_offgrid(f):
    return curves.iv_curves(f.iv_offgrid, inventory.points_by_plate(f), START, STOP)


@check
def grid_iv_curve_snapped(f):
    snapped = f.iv_offgrid.withColumn("date", snap(F.col("date")))
    return curves.iv_curves(snapped, inventory.points_by_plate(f), START, STOP)


@check
def iv_before_inspection(f):
    return curves.iv_before_inspection(f.iv, inventory.inspections_with_points(f))


@check
def iv_before_inspection_monophasic(f):
    return curves.iv_before_inspection(f.iv, inventory.inspections_with_points(f), phases=1)


@check
def energy_before_inspection(f):
    return curves.energy_before_inspection(f.om, inventory.inspected_points(f))


@check
def energy_before_inspection_legacy(f):
    return curves.energy_before_inspection(f.om, inventory.inspected_points(f), legacy=True)


@check
def energy_before_inspection_missing_magnitude(f):
    return curves.energy_before_inspection(f.om_missing, inventory.inspected_points(f), rollover=True)


# the long extract


@check
def indirect_extract(f):
    return extract.indirect_extract(f.iv_all_magnitudes, f.om, f, START, STOP)


@check
def indirect_extract_legacy_labels(f):
    return extract.indirect_extract(f.iv_all_magnitudes, f.om, f, START, STOP, legacy_labels=True)


@check
def interval_join_contract_tariff(f):
    joined = interval_join(
        f.long_readings, [extract.point_spans(inventory.point_history(f))]
    )
    return joined.select(
        "rowkey",
        "measuring_point",
        "date",
        "value",
        "CODE",
        "MANAGEMENT",
        "OFFICE",
        "TARIFF_STRUCTURE",
        "SA_START_DATE",
        "TARIFF_STRUCTURE_END_DATE",
        "VOLTAGE_LEVEL",
    )


@check
def interval_join_equipment(f):
    joined = interval_join(
        f.long_readings, [extract.equipment_spans(inventory.equipment_history(f))]
    )
    return joined.select(
        "rowkey", "date", "value", "EQUIP_START_DATE", "EQUIP_END_DATE", "BADGE_NUMBER"
    )


@check
def interval_join_equipment_shuffled(f):
    """The same where no side counts as small and busy keys are split."""
    spans = [extract.equipment_spans(inventory.equipment_history(f))]
    joined = interval_join(f.long_readings, spans, max_rows=0, hot_rows=50)
    return joined.select(
        "rowkey", "date", "value", "EQUIP_START_DATE", "EQUIP_END_DATE", "BADGE_NUMBER"
    )


@check
def lookup_source(f):
    named = extract.with_source_name(f.iv, inventory.sources(f))
    return named.select("rowkey", "measuring_point", "source", "SOURCE_NAME")


@check
def lookup_magnitude(f):
    kinds = f.iv_all_magnitudes.withColumn("kind", F.lit("IV"))
    named = extract.with_magnitude_name(kinds, inventory.magnitudes(f, with_kind=True))
    return named.select("rowkey", "magnitude", "measurement_interval", "DESCRIPTION")


@check
def union_iv_om(f):
    return extract.window_readings(f.iv, f.om, inventory.indirect_points(f), START, STOP)


# grid, pivot, bounds


@check
def point_time_bounds(f):
    return time_bounds(f.iv)


@check
def per_point_grid(f):
    return clipped_grid(time_bounds(f.iv_offgrid), START, STOP)


def _windows(f):
    inspections = inventory.inspections_with_points(f)
    return inspection_windows(inspections, "PUNTO_MEDIDA_MDM", "PUNTO_SERVICIO")


@check
def own_window_grid_summary(f):
    grid = own_window_grid(_windows(f).select("point", "window_start", "window_stop"))
    return grid.groupBy("point").agg(
        F.count("slot").alias("slots"),
        F.min("slot").alias("first_slot"),
        F.max("slot").alias("last_slot"),
        F.sum(F.col("slot") - F.col("window_start")).alias("offset_sum"),
    )


@check
def pivot_max_magnitudes(f):
    return pivot_max(f.iv, ["measuring_point", "date"], THREE_PHASE_COLUMNS)


@check
def pivot_missing_magnitude(f):
    keys = ["measuring_point", "day", "period"]
    return absent_as(pivot_max(f.om_missing, keys, ENERGY_COLUMNS, presence=True), ENERGY_COLUMNS)


# inventory


@check
def points_by_group(f):
    return inventory.points_by_group(f, GROUP)


@check
def points_by_group_phase(f):
    return inventory.points_by_group_and_phase(f, GROUP, 1)


@check
def points_by_plate_prefix(f):
    return inventory.points_by_plate(f)


@check
def points_indirect(f):
    return inventory.indirect_points(f)


@check
def inspection_batches(f):
    return inventory.inspection_batches(f, BATCH_SIZE)


@check
def inspection_batch(f):
    return inventory.inspected_points(f, batch=2, size=BATCH_SIZE)


@check
def inspections_with_points(f):
    return inventory.inspections_with_points(f)


@check
def latest_inspection_triphasic(f):
    return inventory.inspected_three_phase_points(f)


@check
def count_triphasic_points(f):
    return inventory.count_three_phase_points(f)


@check
def point_history(f):
    return inventory.point_history(f)


@check
def equipment_history(f):
    return inventory.equipment_history(f)


@check
def source_dictionary(f):
    return inventory.sources(f)


@check
def union_distinct_magnitudes(f):
    return inventory.magnitudes(f.repeated_dictionaries())


@check
def inspection_date_format(f):
    return inventory.inspection_dates(inventory.inspected_points(f))


# restrictions


@check
def restrict_points_window_iv(f):
    return points_window(f.iv, inventory.points_by_plate(f), START, STOP)


@check
def restrict_points_window_shuffled(f):
    """The same where the list of points doesn't count as small."""
    return points_window(f.iv, inventory.points_by_plate(f), START, STOP, max_rows=0)


@check
def restrict_points_window_laid_out(f):
    """The same on a table in folders by day and buckets by point."""
    kept = points_window(f.bucketed("iv"), inventory.points_by_plate(f), START, STOP)
    return kept.drop(DAY_COLUMN)


@check
def pivot_points_window_laid_out(f):
    """Restricted and pivoted without an exchange."""
    kept = points_window(f.bucketed("iv"), inventory.points_by_plate(f), START, STOP)
    return pivot_max(kept, ["measuring_point", "date"], THREE_PHASE_COLUMNS)


@check
def restrict_points_window_om(f):
    return points_hours(f.om, inventory.points_by_plate(f), START, STOP, 1)


@check
def restrict_own_window(f):
    windows = inspection_windows(inventory.inspected_points(f), "PUNTO_MEDIDA_INTERNO", "PUNTO_SERVICIO")
    return own_window(f.om, windows, "day")


@check
def restrict_own_window_laid_out(f):
    windows = inspection_windows(inventory.inspected_points(f), "PUNTO_MEDIDA_INTERNO", "PUNTO_SERVICIO")
    return own_window(f.bucketed("om"), windows, "day").drop(DAY_COLUMN)


@check
def restrict_own_window_iv(f):
    return own_window(f.iv_offgrid, _windows(f), "date")


@check
def restrict_daily_template(f):
    return daily_template(f.om, START, STOP, 1, list(ENERGY_COLUMNS))


@check
def restrict_daily_template_laid_out(f):
    return daily_template(f.bucketed("om"), START, STOP, 1, list(ENERGY_COLUMNS)).drop(DAY_COLUMN)


# column functions


@check
def row_keys(f):
    point = F.col("measuring_point")
    suffix = F.lit("00000")
    return f.iv.select(
        "rowkey",
        iv_row_key(point, F.col("date"), suffix).alias("iv_key"),
        om_row_key(point, F.col("measurement_interval"), F.col("date"), suffix).alias("om_key"),
        iv_row_key(point + 1234567890, F.col("date"), suffix).alias("long_key"),
    )


@check
def slot_time_rollover(f):
    return f.om.select("rowkey", "period", slot_ms(F.col("day"), F.col("period")).alias("slot"))


@check
def slot_time_wrap(f):
    day, period = F.col("day"), F.col("period")
    return f.om.select(
        "rowkey",
        "period",
        slot_text(day_of(day), period).alias("slot_text"),
        slot_timestamp(day, period).alias("slot_time"),
    )


@check
def interval_labels(f):
    return f.iv.select("rowkey", interval_label(F.col("measurement_interval")).alias("label"))


@check
def slots_per_day(f):
    """Grid step arithmetic: readings per snapped slot and point."""
    slot = snap(F.col("date"), STEP_MS)
    return f.iv_offgrid.groupBy("measuring_point", slot.alias("slot")).agg(
        F.count(F.lit(1)).alias("readings")
    )


# encoded cells


@check
def decode_om_cells(f):
    return decode_cells(gather_cells(f.cells("om"), "om"), "om", strict=True)


@check
def decode_iv_cells(f):
    return decode_cells(gather_cells(f.cells("iv"), "iv"), "iv", strict=False, missing="sentinel")


@check
def decode_iv_cells_null(f):
    return decode_cells(gather_cells(f.cells("iv"), "iv"), "iv", strict=False)


@check
def decode_om_cells_batches(f):
    return decode_batches(gather_cells(f.cells("om"), "om"), "om", strict=True)


@check
def decode_iv_cells_batches(f):
    rows = gather_cells(f.cells("iv"), "iv")
    return decode_batches(rows, "iv", strict=False, missing="sentinel")


@check
def decode_event_cells(f):
    return decode_cells(gather_cells(f.cells("event"), "event"), "event", strict=True)
