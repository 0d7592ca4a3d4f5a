"""Curves on the quarter-hour grid, for a common window or the days before an inspection."""

from collections.abc import Mapping
from datetime import tzinfo

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from meterloom.functions.labels import gap_text
from meterloom.functions.timeslots import DAY_MS, STEP_MS, date_ms, epoch_seconds, slot_ms, slot_timestamp
from meterloom.operators.grid import (
    NOWHERE,
    clipped_ends,
    fill_packed,
    own_window_ends,
    packed,
    packed_bounds,
    packed_presence,
)
from meterloom.operators.pivoting import (
    absent_as,
    filled_where_absent,
    pivot_max,
    presence_flags,
)
from meterloom.operators.restrict import (
    daily_template,
    inspection_windows,
    keep_points,
    mark_points,
    outer_window,
    own_window,
    points_window,
)
from meterloom.operators.spans import Spans, span_join
from meterloom.operators.spread import BROADCAST_IDS, BROADCAST_ROWS, bounded_join
from meterloom.schemas import (
    ENERGY_COLUMNS,
    ENERGY_SOURCE,
    QUARTER_HOUR,
    SINGLE_PHASE_COLUMNS,
    THREE_PHASE_COLUMNS,
)


def _placed(readings: DataFrame, time: str) -> DataFrame:
    return readings.filter(F.col("measuring_point").isNotNull() & F.col(time).isNotNull())


def _curve(
    readings: DataFrame,
    time: str,
    names: Mapping[int, str],
    start: int,
    stop: int,
    step: int,
    points: DataFrame | None,
    absent: float | None = None,
) -> DataFrame:
    """(measuring_point, slot, one column per magnitude) on each point's clipped grid.

    Readings are pivoted once and packed; the bounds, the fill and the presence of magnitudes
    share the packs' exchange.  The outer code is attached to the bounds, one row per point.
    Readings without point or time, or of points to be left out, count only for presence.
    """
    columns, marked = list(names.values()), absent is not None
    flags = presence_flags(names) if marked else []
    if marked:
        # without a point there is no time to bound, so that such rows share a group
        lost = F.col("measuring_point").isNull()
        nowhere = F.coalesce("measuring_point", F.lit(NOWHERE))
        read = readings.withColumns({time: F.when(~lost, F.col(time)), "measuring_point": nowhere})
    else:
        read = _placed(readings, time)
    wide = pivot_max(read, ["measuring_point", time], names, presence=marked)
    packs = packed(wide, "measuring_point", time, [*columns, *flags], step)
    bounds = packed_bounds(packs, "measuring_point")
    if points is None:
        labelled = bounds.withColumn("label", F.col("measuring_point"))
    else:
        codes = points.select(
            F.col("ID").cast("bigint").alias("measuring_point"), F.col("CODE").alias("label")
        )
        labelled = bounds.join(codes, "measuring_point")
    ends = clipped_ends(labelled, start, stop, step)
    curve = fill_packed(ends, packs, "measuring_point", columns, step).select(
        F.col("label").alias("measuring_point"), "slot", *columns
    )
    if not marked:
        return curve
    found = packed_presence(packs, dict(zip(columns, flags, strict=True)))
    return filled_where_absent(curve, found, names, absent)


def _phase_columns(phases: int) -> Mapping[int, str]:
    if phases not in (1, 3):
        raise ValueError(f"phases must be 1 or 3, not {phases}")
    return THREE_PHASE_COLUMNS if phases == 3 else SINGLE_PHASE_COLUMNS


def _instantaneous(readings: DataFrame, names: Mapping[int, str]) -> DataFrame:
    return readings.filter(
        F.col("magnitude").isin(*names) & (F.col("measurement_interval") == QUARTER_HOUR)
    )


def iv_curves(
    readings: DataFrame,
    points: DataFrame,
    start: int,
    stop: int,
    phases: int = 3,
    step: int = STEP_MS,
    max_rows: int = BROADCAST_IDS,
) -> DataFrame:
    """Voltage and current per point and slot as text, gaps as NaN."""
    names = _phase_columns(phases)
    kept = points_window(_instantaneous(readings, names), points, start, stop, max_rows)
    curve = _curve(kept, "date", names, start, stop, step, points)
    return curve.select(
        "measuring_point",
        epoch_seconds(F.col("slot")).alias("date"),
        *[gap_text(F.col(name)).alias(name) for name in names.values()],
    )


def energy_curves(
    readings: DataFrame,
    points: DataFrame | None,
    start: int,
    stop: int,
    gaps: str = "null",
    absent: float | None = -1.0,
    tz: str | tzinfo = "UTC",
    source: int = ENERGY_SOURCE,
    step: int = STEP_MS,
    max_rows: int = BROADCAST_IDS,
) -> DataFrame:
    """Active and reactive energy per point and slot.

    Without ``points`` all points are reported by their id.  ``gaps`` is ``null`` or ``text``
    (values as text, gaps as NaN).  ``absent`` fills a magnitude that no reading carries; None
    leaves it a gap like any other.  A magnitude is present if any point's reading carries it.
    """
    if gaps not in ("null", "text"):
        raise ValueError(f"gaps must be 'null' or 'text', not {gaps!r}")
    names = ENERGY_COLUMNS
    restricted = daily_template(readings, start, stop, QUARTER_HOUR, list(names), tz).filter(
        F.col("source") == source
    )
    slotted = restricted.select(
        "measuring_point",
        slot_ms(F.col("day"), F.col("period")).alias("day"),
        "magnitude",
        "value",
    )
    if points is not None and absent is None:
        slotted = keep_points(slotted, points, max_rows)
    elif points is not None:
        slotted = mark_points(slotted, points, ["day"], max_rows)
    curve = _curve(slotted, "day", names, start, stop, step, points, absent)
    values = [
        gap_text(F.col(name)).alias(name) if gaps == "text" else F.col(name)
        for name in names.values()
    ]
    return curve.select("measuring_point", epoch_seconds(F.col("slot")).alias("day"), *values)


def iv_before_inspection(
    readings: DataFrame,
    inspections: DataFrame,
    days: int = 90,
    phases: int = 3,
    step: int = STEP_MS,
    max_rows: int = BROADCAST_ROWS,
    unreadable: Observation | None = None,
) -> DataFrame:
    """Voltage and current curves of the days before each inspection, gaps as NaN.

    ``inspections`` has PUNTO_MEDIDA_MDM, PUNTO_SERVICIO and FECHAI1.  Every inspection gets its
    own whole grid, also without any reading.
    """
    names = _phase_columns(phases)
    windows = inspection_windows(
        inspections, "PUNTO_MEDIDA_MDM", "PUNTO_SERVICIO", days=days, unreadable=unreadable
    )
    kept = own_window(_instantaneous(readings, names), windows, "date", max_rows)
    wide = pivot_max(_placed(kept, "date"), ["measuring_point", "date"], names)
    packs = packed(wide, "measuring_point", "date", list(names.values()), step)
    ends = own_window_ends(windows.select("point", "code", "window_start", "window_stop"))
    filled = fill_packed(ends, packs, "point", list(names.values()), step)
    return filled.select(
        F.col("code").alias("measuring_point"),
        epoch_seconds(F.col("slot")).alias("date"),
        *[gap_text(F.col(name)).alias(name) for name in names.values()],
    )


def energy_before_inspection(
    readings: DataFrame,
    inspections: DataFrame,
    days: int = 90,
    legacy: bool = False,
    rollover: bool = False,
    source: int = ENERGY_SOURCE,
    absent: float = -1.0,
    max_rows: int = BROADCAST_ROWS,
    unreadable: Observation | None = None,
) -> DataFrame:
    """Energy per point and time in the days before an inspection, no grid.

    ``inspections`` has PUNTO_MEDIDA_INTERNO, PUNTO_SERVICIO and FECHAI1.  A reading is reported
    for the inspections whose window holds it; ``legacy`` reports it for every inspection of its
    point.  ``rollover`` puts period 96 on the next day instead of the start of its own.
    """
    names = ENERGY_COLUMNS
    windows = inspection_windows(
        inspections, "PUNTO_MEDIDA_INTERNO", "PUNTO_SERVICIO", days=days, unreadable=unreadable
    )
    measured = readings.filter(
        (F.col("measurement_interval") == QUARTER_HOUR)
        & F.col("magnitude").isin(*names)
        & (F.col("source") == source)
    )
    outer = outer_window(windows)
    kept = own_window(measured, windows, "day", max_rows, outer)
    timed = kept.select(
        "measuring_point",
        slot_timestamp(F.col("day"), F.col("period"), rollover).alias("date"),
        "magnitude",
        "value",
    )
    # keys that are never null leave nothing to push into one reader of the pivot only
    never = F.timestamp_seconds(F.lit(-(1 << 35)))
    keyed = timed.withColumns(
        {
            "measuring_point": F.coalesce("measuring_point", F.lit(NOWHERE)),
            "date": F.coalesce("date", never),
        }
    )
    wide = pivot_max(keyed, ["measuring_point", "date"], names, presence=True)
    wide = absent_as(wide, names, absent)
    if legacy:
        codes = windows.select(F.col("point").alias("measuring_point"), "code")
        joined = bounded_join(wide, codes, ["measuring_point"], "inner", max_rows)
    else:
        day_end = DAY_MS if rollover else DAY_MS - 1
        earliest, latest = outer
        spans = Spans(
            windows.select("point", "code", "window_start", "window_stop"),
            "point",
            F.col("window_start"),
            F.col("window_stop") + day_end,
        )
        joined = span_join(
            wide,
            "measuring_point",
            F.unix_millis("date") if rollover else date_ms(F.to_date("date")),
            [spans],
            window=(earliest, latest + day_end),
            max_rows=max_rows,
            salt_by=["measuring_point", "date"],
        )
    date = F.when(F.col("date") != never, F.col("date")).alias("date")
    return joined.select(F.col("code").alias("measuring_point"), date, *names.values())
