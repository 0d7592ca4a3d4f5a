"""The check queries as plain SQL over the test tables.

``_FRAMES`` restates the derived frames, ``_QUERIES`` the results; a query carries only the frames
it uses.  Nothing here is shared with the DataFrame code except the windows and batch size.
"""

import re

START = 1704412800000
STOP = 1705708800000
STEP = 900000
BATCH_SIZE = 40

_FRAMES = {
    "ev": """
        SELECT event_id, event_type, user_id AS measuring_point, value, props AS validation_result,
               epoch_us(ts) // 1000 AS last_update_time,
               CAST(CASE WHEN event_id % 4 = 0 THEN 21 ELSE 41 END AS BIGINT) AS source
        FROM events""",
    "iv_coded": """
        SELECT *, CAST(CASE event_type WHEN 'view' THEN 13 WHEN 'click' THEN 14 WHEN 'signup' THEN 15
                       WHEN 'purchase' THEN 16 WHEN 'error' THEN 17 END AS BIGINT) AS magnitude,
               CAST(CASE event_id % 10 WHEN 0 THEN 2 WHEN 5 THEN NULL ELSE 1 END AS BIGINT) AS measurement_interval,
               last_update_time // 900000 * 900000 AS date
        FROM ev""",
    "iv_full": """
        SELECT lpad(CAST(measuring_point AS VARCHAR), 8, '0') || lpad(CAST(date AS VARCHAR), 14, '0')
               || lpad(CAST(event_id % 100000 AS VARCHAR), 5, '0') AS rowkey, *
        FROM iv_coded""",
    "iv": """
        SELECT rowkey, magnitude, measurement_interval, source, measuring_point, value, date,
               last_update_time, validation_result FROM iv_full""",
    "iv_offgrid": """
        SELECT lpad(CAST(measuring_point AS VARCHAR), 8, '0')
               || lpad(CAST(last_update_time AS VARCHAR), 14, '0')
               || lpad(CAST(event_id % 100000 AS VARCHAR), 5, '0') AS rowkey,
               magnitude, measurement_interval, source, measuring_point, value,
               last_update_time AS date, last_update_time, validation_result
        FROM iv_coded""",
    "iv_all": "SELECT * REPLACE (event_id % 24 + 1 AS magnitude) FROM iv_full",
    "om_coded": """
        SELECT *, last_update_time // 86400000 * 86400000 AS day,
               CAST(last_update_time % 86400000 // 900000 + 1 AS INTEGER) AS period,
               CAST(CASE WHEN event_type IN ('view', 'click') THEN 1
                         WHEN event_type IN ('signup', 'purchase') THEN 3
                         WHEN event_type = 'error' THEN 2 END AS BIGINT) AS magnitude,
               CAST(1 AS BIGINT) AS measurement_interval
        FROM ev""",
    "om_full": """
        SELECT lpad(CAST(measuring_point AS VARCHAR), 8, '0') || measurement_interval
               || lpad(CAST(day // 3600000 AS VARCHAR), 10, '0') || magnitude
               || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') AS rowkey, *,
               make_timestamp(day * 1000) + INTERVAL 1 MINUTE
                 * (CASE WHEN period // 4 = 24 THEN 0 ELSE period // 4 END * 60 + period % 4 * 15)
                 AS wrapped_time
        FROM om_coded""",
    "om": """
        SELECT rowkey, day, magnitude, measurement_interval, measuring_point, period, value,
               validation_result, source, last_update_time FROM om_full""",
    "om_missing": "SELECT * FROM om WHERE magnitude <> 3",
    "long_readings": """
        SELECT l_orderkey || '-' || l_linenumber AS rowkey, o_custkey AS measuring_point,
               l_shipdate AS date, l_quantity AS value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "measuring_point": "SELECT c_custkey AS id, c_name AS code, c_custkey AS location_data FROM customer",
    "commercial": """
        SELECT o_orderkey AS id, o_custkey AS measuring_point, o_orderdate AS start_date,
               lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS end_date
        FROM orders""",
    "billing": """
        SELECT o_orderkey AS commercial_data, o_orderpriority AS tariff, o_orderdate AS tariff_start,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 90 DAY END AS tariff_end
        FROM orders""",
    "equipment_point": """
        SELECT c.measuring_point, l.equipment, c.id % 3 + 1 AS reading_constant, c.start_date, c.end_date
        FROM commercial c LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS equipment FROM lineitem GROUP BY 1) l
          ON l.l_orderkey = c.id""",
    "indirect": """
        SELECT DISTINCT mp.id FROM measuring_point mp JOIN equipment_point ec
        ON ec.measuring_point = mp.id WHERE ec.reading_constant > 1""",
    "history": """
        SELECT mp.id AS "ID", mp.code AS "CODE", r_name AS "MANAGEMENT", n_name AS "OFFICE",
               b.tariff AS "TARIFF_STRUCTURE", c.start_date AS "SA_START_DATE",
               c.end_date AS "SA_END_DATE", b.tariff_start AS "TARIFF_STRUCTURE_START_DATE",
               b.tariff_end AS "TARIFF_STRUCTURE_END_DATE", vl.r_name_level AS "VOLTAGE_LEVEL"
        FROM measuring_point mp JOIN customer cu ON cu.c_custkey = mp.location_data
        JOIN nation ON n_nationkey = cu.c_nationkey JOIN region ON r_regionkey = n_regionkey
        JOIN commercial c ON c.measuring_point = mp.id JOIN billing b ON b.commercial_data = c.id
        JOIN (SELECT r_regionkey AS level_id, r_name AS r_name_level FROM region) vl
          ON vl.level_id = cu.c_nationkey % 5
        WHERE mp.id IN (SELECT id FROM indirect)""",
    "equipment_spans": """
        SELECT mp.id AS "ID", ec.start_date AS "EQUIP_START_DATE", ec.end_date AS "EQUIP_END_DATE",
               p_brand AS "BADGE_NUMBER"
        FROM measuring_point mp JOIN equipment_point ec ON ec.measuring_point = mp.id
        JOIN part ON p_partkey = ec.equipment WHERE mp.id IN (SELECT id FROM indirect)""",
    "source_names": """
        SELECT DISTINCT source AS source_id,
               CASE source WHEN 21 THEN 'manual' WHEN 41 THEN 'remote' END AS source_name FROM ev""",
    "magnitude_names": """
        SELECT 'OM' AS kind, CAST(n_nationkey + 1 AS BIGINT) AS magnitude_id,
               'energy ' || (n_nationkey + 1) AS description FROM nation WHERE n_nationkey < 6
        UNION SELECT 'IV', CAST(n_nationkey + 1 AS BIGINT), 'instantaneous ' || (n_nationkey + 1)
        FROM nation WHERE n_nationkey < 24""",
    "service_point": """
        SELECT c_custkey, c_name AS punto_servicio,
               CASE WHEN c_custkey % 3 = 0 THEN '070' ELSE '080' END || c_custkey AS numero_placa,
               CASE WHEN c_custkey % 2 = 1 THEN 'TRIFASICO ' ELSE 'MONOFASICO' END AS fases
        FROM customer""",
    "meter": """
        SELECT numero_placa, CASE WHEN c_custkey % 11 <> 0
               THEN DATE '2024-01-01' + CAST(c_custkey % 20 AS INTEGER) END AS fecha_desde
        FROM service_point""",
    "plated": """
        SELECT DISTINCT mp.id, mp.code FROM measuring_point mp
        LEFT JOIN service_point dt ON dt.punto_servicio = mp.code WHERE dt.numero_placa LIKE '070%'""",
    "grouped": "SELECT c_custkey AS id, c_name AS code FROM customer WHERE c_mktsegment = 'BUILDING'",
    "inspected": """
        SELECT c_custkey AS id, c_name AS code,
               DATE '2024-01-01' + CAST(c_custkey % 30 + 45 * visit AS INTEGER) AS inspected_on
        FROM customer JOIN (SELECT unnest([0, 1]) AS visit) v ON visit = 0 OR c_custkey % 3 = 0""",
    "inspected_failing": """
        SELECT DISTINCT * FROM inspected
        WHERE id IN (SELECT user_id FROM events WHERE event_type = 'error')""",
    "windows": """
        SELECT id, code, inspected_on, epoch_ms(CAST(inspected_on AS TIMESTAMP)) AS window_stop,
               epoch_ms(CAST(inspected_on - 90 AS TIMESTAMP)) AS window_start FROM inspected""",
    "windows_failing": """
        SELECT * FROM windows WHERE id IN (SELECT id FROM inspected_failing)""",
    "batches": f"""
        SELECT id AS "PUNTO_MEDIDA_INTERNO", code AS "PUNTO_SERVICIO",
               strftime(inspected_on, '%d/%m/%Y') AS "FECHAI1",
               CAST(ceil(row_number() OVER (
                 ORDER BY id, code, strftime(inspected_on, '%d/%m/%Y')) / {BATCH_SIZE}) AS BIGINT) AS batch_number
        FROM inspected""",
    "three_phase": """
        SELECT s.punto_servicio, m.fecha_desde FROM service_point s
        LEFT JOIN meter m ON m.numero_placa = s.numero_placa
        WHERE s.numero_placa LIKE '070%' AND trim(s.fases) = 'TRIFASICO' AND m.fecha_desde IS NOT NULL""",
    "inspection_history": """
        SELECT c_name AS id, DATE '2024-02-01' + CASE WHEN k = 0 THEN 0 ELSE 1 END AS fecha,
               DATE '2024-01-01' + CAST(c_custkey % 30 + k AS INTEGER) AS inspected_on,
               DATE '2024-02-01' + k AS commit_day
        FROM customer, (SELECT unnest([0, 1, 2]) AS k)""",
    "axis": f"SELECT unnest(range({START}, {STOP}, {STEP})) AS slot",
    "om_window": f"""
        SELECT measuring_point, day + period * {STEP} AS slot, magnitude, value FROM om
        WHERE source = 41 AND magnitude IN (1, 3) AND measurement_interval = 1
          AND day BETWEEN {START} AND {STOP} AND day % 86400000 = 0""",
    "om_missing_window": "SELECT * FROM om_window WHERE magnitude <> 3",
    "indirect_readings": f"""
        SELECT 'IV' AS kind, rowkey, measuring_point, make_timestamp(date // 1000 * 1000000) AS date,
               magnitude, measurement_interval, value, source
        FROM iv_all WHERE measuring_point IN (SELECT id FROM indirect) AND date BETWEEN {START} AND {STOP}
        UNION ALL
        SELECT 'OM', rowkey, measuring_point, wrapped_time, magnitude, measurement_interval, value, source
        FROM om_full WHERE measuring_point IN (SELECT id FROM indirect) AND measurement_interval = 1
          AND day // 3600000 BETWEEN {START // 3600000} AND {STOP // 3600000}""",
}


def _energy_curve(readings, columns, code="p.code", points="JOIN grouped p ON p.id = b.measuring_point"):
    return f"""
        SELECT {code} AS measuring_point, a.slot // 1000 AS day, {columns}
        FROM (SELECT measuring_point, min(slot) AS lo, max(slot) AS hi FROM {readings} GROUP BY 1) b
        JOIN axis a ON a.slot BETWEEN b.lo AND b.hi {points}
        LEFT JOIN (SELECT measuring_point, slot, max(value) FILTER (magnitude = 1) AS m1,
                          max(value) FILTER (magnitude = 3) AS m3
                   FROM {readings} GROUP BY 1, 2) w
          ON w.measuring_point = b.measuring_point AND w.slot = a.slot"""


_TEXT = "coalesce(CAST({0} AS VARCHAR), 'NaN') AS {1}"
_THREE = {
    "voltage_phase_1": 13,
    "voltage_phase_2": 15,
    "voltage_phase_3": 17,
    "current_phase_1": 14,
    "current_phase_2": 16,
    "current_phase_3": 18,
}
_ONE = {"voltage_phase_1": 13, "current_phase_1": 14}


def _iv_pivot(readings, columns):
    cells = ", ".join(
        f"max(value) FILTER (magnitude = {m}) AS {name}" for name, m in columns.items()
    )
    return f"SELECT measuring_point, date, {cells} FROM {readings} GROUP BY 1, 2"


def _iv_curve(readings, columns, date="date"):
    kept = f"""(SELECT measuring_point, {date} AS date, magnitude, value FROM {readings}
        WHERE measurement_interval = 1 AND magnitude IN ({", ".join(map(str, columns.values()))})
          AND {date} BETWEEN {START} AND {STOP})"""
    texts = ", ".join(_TEXT.format(f"w.{name}", name) for name in columns)
    return f"""
        SELECT p.code AS measuring_point, a.slot // 1000 AS date, {texts}
        FROM (SELECT measuring_point, min(date) AS lo, max(date) AS hi FROM {kept} GROUP BY 1) b
        JOIN axis a ON a.slot BETWEEN b.lo AND b.hi JOIN plated p ON p.id = b.measuring_point
        LEFT JOIN ({_iv_pivot(kept, columns)}) w
          ON w.measuring_point = b.measuring_point AND w.date = a.slot"""


def _iv_before(columns):
    return f"""
    SELECT g.code AS measuring_point, g.slot // 1000 AS date,
           {", ".join(_TEXT.format(f"w.{name}", name) for name in columns)}
    FROM (SELECT id, code, unnest(range(window_start, window_stop + 1, {STEP})) AS slot
          FROM windows_failing) g
    LEFT JOIN ({_iv_pivot("(SELECT * FROM iv WHERE measurement_interval = 1)", columns)}) w
      ON w.measuring_point = g.id AND w.date = g.slot"""


def _energy_before(condition, readings="om_full", time="wrapped_time", reactive="w.m3"):
    return f"""
        SELECT i.code AS measuring_point, w.date, w.m1 AS active_energy, {reactive} AS reactive_energy_1
        FROM (SELECT o.measuring_point, {time} AS date, max(value) FILTER (magnitude = 1) AS m1,
                     max(value) FILTER (magnitude = 3) AS m3
              FROM {readings} o
              WHERE source = 41 AND magnitude IN (1, 3) AND measurement_interval = 1
                AND EXISTS (SELECT 1 FROM windows x WHERE x.id = o.measuring_point
                            AND o.day // 3600000 BETWEEN x.window_start // 3600000
                                                     AND x.window_stop // 3600000)
              GROUP BY 1, 2) w
        JOIN windows i ON i.id = w.measuring_point {condition}"""


_LABEL = """CASE WHEN measurement_interval = 1 THEN 'QH' WHEN measurement_interval IS NULL THEN 'INSTANTANEO'
               ELSE CAST(measurement_interval AS VARCHAR) END"""


def _extract(kind):
    return f"""
        SELECT h."CODE" AS "PM", h."MANAGEMENT" AS "GERENCIA", h."OFFICE" AS "OFICINA",
               h."TARIFF_STRUCTURE" AS "TARIFA", r.date AS "FECHA", m.description AS "MAGNITUD",
               {_LABEL} AS "INTERVALO MEDIDA", r.value AS "VALOR", s.source_name AS "ORIGEN",
               h."VOLTAGE_LEVEL" AS "NIVEL TENSION", e."BADGE_NUMBER" AS "BN"
        FROM indirect_readings r
        JOIN history h ON h."ID" = r.measuring_point AND h."SA_START_DATE" < r.date
          AND (r.date <= h."SA_END_DATE" OR h."SA_END_DATE" IS NULL)
          AND h."TARIFF_STRUCTURE_START_DATE" < r.date
          AND (r.date <= h."TARIFF_STRUCTURE_END_DATE" OR h."TARIFF_STRUCTURE_END_DATE" IS NULL)
        JOIN equipment_spans e ON e."ID" = r.measuring_point AND e."EQUIP_START_DATE" < r.date
          AND (r.date <= e."EQUIP_END_DATE" OR e."EQUIP_END_DATE" IS NULL)
        JOIN source_names s ON s.source_id = r.source
        JOIN magnitude_names m ON m.magnitude_id = r.magnitude {kind}"""


def _iv_cells(missing, text):
    return f"""
        SELECT rowkey, magnitude, CASE WHEN event_type = 'error' OR measurement_interval IS NULL THEN {missing}
               ELSE measurement_interval END AS measurement_interval, source, measuring_point,
               CASE WHEN value < 25 THEN CAST({missing} AS DOUBLE) ELSE value END AS value, date,
               last_update_time,
               CASE WHEN value > 480 THEN {text} ELSE validation_result END AS validation_result
        FROM iv_full"""


_QUERIES = {
    "grid_energy_curve": _energy_curve(
        "om_window", "w.m1 AS active_energy, w.m3 AS reactive_energy_1"
    ),
    "grid_energy_curve_text": _energy_curve(
        "om_window",
        f"{_TEXT.format('w.m1', 'active_energy')}, {_TEXT.format('w.m3', 'reactive_energy_1')}",
    ),
    "grid_energy_curve_raw_ids": _energy_curve(
        "om_window", "w.m1 AS active_energy, w.m3 AS reactive_energy_1", "b.measuring_point", ""
    ),
    "grid_energy_curve_missing_magnitude": _energy_curve(
        "om_missing_window",
        "w.m1 AS active_energy, CAST(-1 AS DOUBLE) AS reactive_energy_1",
        "b.measuring_point",
        "",
    ),
    "grid_iv_curve_triphasic": _iv_curve("iv", _THREE),
    "grid_iv_curve_monophasic": _iv_curve("iv", _ONE),
    "grid_iv_curve_offgrid": _iv_curve("iv_offgrid", _THREE),
    "grid_iv_curve_snapped": _iv_curve("iv_offgrid", _THREE, "date // 900000 * 900000"),
    "iv_before_inspection": _iv_before(_THREE),
    "iv_before_inspection_monophasic": _iv_before(_ONE),
    "energy_before_inspection": _energy_before(
        "AND CAST(w.date AS DATE) BETWEEN i.inspected_on - 90 AND i.inspected_on"
    ),
    "energy_before_inspection_legacy": _energy_before(""),
    "energy_before_inspection_missing_magnitude": _energy_before(
        "AND epoch_ms(w.date) BETWEEN i.window_start AND i.window_stop + 86400000",
        "(SELECT * FROM om_full WHERE magnitude <> 3)",
        f"make_timestamp((day + period * {STEP}) * 1000)",
        "CAST(-1 AS DOUBLE)",
    ),
    "indirect_extract": _extract("AND m.kind = r.kind"),
    "indirect_extract_legacy_labels": _extract(""),
    "interval_join_contract_tariff": """
        SELECT r.rowkey, r.measuring_point, r.date, r.value, h."CODE", h."MANAGEMENT", h."OFFICE",
               h."TARIFF_STRUCTURE", h."SA_START_DATE", h."TARIFF_STRUCTURE_END_DATE", h."VOLTAGE_LEVEL"
        FROM long_readings r JOIN history h ON h."ID" = r.measuring_point
          AND h."SA_START_DATE" < r.date AND (r.date <= h."SA_END_DATE" OR h."SA_END_DATE" IS NULL)
          AND h."TARIFF_STRUCTURE_START_DATE" < r.date
          AND (r.date <= h."TARIFF_STRUCTURE_END_DATE" OR h."TARIFF_STRUCTURE_END_DATE" IS NULL)""",
    "interval_join_equipment": """
        SELECT r.rowkey, r.date, r.value, e."EQUIP_START_DATE", e."EQUIP_END_DATE", e."BADGE_NUMBER"
        FROM long_readings r JOIN equipment_spans e ON e."ID" = r.measuring_point
          AND e."EQUIP_START_DATE" < r.date
          AND (r.date <= e."EQUIP_END_DATE" OR e."EQUIP_END_DATE" IS NULL)""",
    "lookup_source": """
        SELECT rowkey, measuring_point, source, source_name AS "SOURCE_NAME"
        FROM iv JOIN source_names ON source_id = source""",
    "lookup_magnitude": f"""
        SELECT rowkey, magnitude, {_LABEL} AS measurement_interval, description AS "DESCRIPTION"
        FROM iv_all JOIN magnitude_names ON magnitude_id = magnitude AND kind = 'IV'""",
    "union_iv_om": f"""
        SELECT 'IV' AS kind, rowkey, measuring_point, make_timestamp(date // 1000 * 1000000) AS date,
               magnitude, measurement_interval, value, source
        FROM iv WHERE measuring_point IN (SELECT id FROM indirect) AND date BETWEEN {START} AND {STOP}
        UNION ALL
        SELECT kind, rowkey, measuring_point, date, magnitude, measurement_interval, value, source
        FROM indirect_readings WHERE kind = 'OM'""",
    "point_time_bounds": """
        SELECT measuring_point, min(date) AS min_date, max(date) AS max_date FROM iv GROUP BY 1""",
    "per_point_grid": """
        SELECT measuring_point, slot
        FROM (SELECT measuring_point, min(date) AS lo, max(date) AS hi FROM iv_offgrid GROUP BY 1)
        JOIN axis ON slot BETWEEN lo AND hi""",
    "own_window_grid_summary": f"""
        SELECT id AS point, count(*) AS slots, min(slot) AS first_slot, max(slot) AS last_slot,
               CAST(sum(slot - window_start) AS BIGINT) AS offset_sum
        FROM (SELECT id, window_start, unnest(range(window_start, window_stop + 1, {STEP})) AS slot
              FROM windows_failing) GROUP BY 1""",
    "pivot_max_magnitudes": _iv_pivot("iv", _THREE),
    "pivot_missing_magnitude": """
        SELECT measuring_point, day, period, max(value) FILTER (magnitude = 1) AS active_energy,
               CAST(-1 AS DOUBLE) AS reactive_energy_1
        FROM om_missing GROUP BY 1, 2, 3""",
    "points_by_group": 'SELECT id AS "ID", code AS "CODE" FROM grouped',
    "points_by_group_phase": 'SELECT id AS "ID", code AS "CODE" FROM grouped WHERE id % 2 = 1',
    "points_by_plate_prefix": 'SELECT id AS "ID", code AS "CODE" FROM plated',
    "points_indirect": 'SELECT id AS "ID" FROM indirect',
    "inspection_batches": "SELECT * FROM batches",
    "inspection_batch": """
        SELECT "PUNTO_MEDIDA_INTERNO", "PUNTO_SERVICIO", "FECHAI1" FROM batches WHERE batch_number = 2""",
    "inspections_with_points": """
        SELECT id AS "PUNTO_MEDIDA_MDM", code AS "PUNTO_SERVICIO",
               strftime(inspected_on, '%d/%m/%Y') AS "FECHAI1" FROM inspected_failing""",
    "latest_inspection_triphasic": """
        SELECT DISTINCT mp.id AS "PUNTO_SERVICIO", strftime(t.inspected_on, '%d/%m/%Y') AS "FECHAI1"
        FROM (SELECT *, dense_rank() OVER (PARTITION BY id ORDER BY commit_day DESC) AS date_rank
              FROM inspection_history WHERE fecha = (SELECT max(fecha) FROM inspection_history)) t
        JOIN measuring_point mp ON mp.code = t.id
        WHERE t.date_rank = 1 AND EXISTS (SELECT 1 FROM three_phase k WHERE k.punto_servicio = t.id
                                          AND t.inspected_on >= k.fecha_desde)""",
    "count_triphasic_points": "SELECT count(DISTINCT punto_servicio) AS points FROM three_phase",
    "point_history": "SELECT * FROM history",
    "equipment_history": "SELECT * FROM equipment_spans",
    "source_dictionary": """
        SELECT source_id AS "SOURCE_ID", source_name AS "SOURCE_NAME" FROM source_names""",
    "union_distinct_magnitudes": """
        SELECT id AS "MAGNITUDE_ID", 'code ' || id AS "DESCRIPTION"
        FROM (SELECT p_partkey % 5000 AS id FROM part UNION SELECT l_partkey * 2 FROM lineitem)""",
    "inspection_date_format": """
        SELECT code AS "PM", strftime(inspected_on, '%Y%m%d') AS "DATE" FROM inspected""",
    "restrict_points_window_iv": f"""
        SELECT * FROM iv WHERE rowkey >= lpad(CAST(measuring_point AS VARCHAR), 8, '0') || '0{START}00000'
          AND rowkey <= lpad(CAST(measuring_point AS VARCHAR), 8, '0') || '0{STOP}99999'
          AND measuring_point IN (SELECT id FROM plated)""",
    "restrict_points_window_om": f"""
        SELECT * FROM om
        WHERE rowkey >= lpad(CAST(measuring_point AS VARCHAR), 8, '0') || '10000{START // 3600000}00000'
          AND rowkey <= lpad(CAST(measuring_point AS VARCHAR), 8, '0') || '10000{STOP // 3600000}99999'
          AND measuring_point IN (SELECT id FROM plated)""",
    "restrict_own_window": """
        SELECT * FROM om WHERE EXISTS (
          SELECT 1 FROM windows w WHERE w.id = om.measuring_point AND om.day // 3600000
            BETWEEN w.window_start // 3600000 AND w.window_stop // 3600000)""",
    "restrict_own_window_iv": """
        SELECT * FROM iv_offgrid v WHERE EXISTS (
          SELECT 1 FROM windows_failing w WHERE w.id = v.measuring_point
            AND v.date BETWEEN w.window_start AND w.window_stop)""",
    "restrict_daily_template": f"""
        SELECT * FROM om WHERE measurement_interval = 1 AND magnitude IN (1, 3)
          AND day // 3600000 IN (SELECT unnest(range({START // 3600000}, {STOP // 3600000 + 1}, 24)))""",
    "row_keys": """
        SELECT rowkey, substr(rowkey, 1, 22) || '00000' AS iv_key,
               substr(rowkey, 1, 8) || measurement_interval
               || lpad(CAST(date // 3600000 AS VARCHAR), 10, '0') || '00000' AS om_key,
               CAST(measuring_point + 1234567890 AS VARCHAR) || substr(rowkey, 9, 14) || '00000' AS long_key
        FROM iv""",
    "slot_time_rollover": f"SELECT rowkey, period, day + period * {STEP} AS slot FROM om",
    "slot_time_wrap": """
        SELECT rowkey, period, strftime(wrapped_time, '%Y-%m-%d %H:%M') AS slot_text,
               wrapped_time AS slot_time FROM om_full""",
    "interval_labels": f"SELECT rowkey, {_LABEL} AS label FROM iv",
    "slots_per_day": f"""
        SELECT measuring_point, date // {STEP} * {STEP} AS slot, count(*) AS readings
        FROM iv_offgrid GROUP BY 1, 2""",
    "decode_om_cells": "SELECT * FROM om",
    "decode_iv_cells": _iv_cells("-1", "''"),
    "decode_iv_cells_null": _iv_cells("NULL", "NULL"),
    "decode_event_cells": """
        SELECT rowkey, last_update_time // 86400000 * 86400000 AS day, event_type AS file,
               validation_result AS information, last_update_time, measuring_point, source,
               magnitude AS event_type FROM iv_full""",
}

_QUERIES["interval_join_equipment_shuffled"] = _QUERIES["interval_join_equipment"]
_QUERIES["restrict_points_window_shuffled"] = _QUERIES["restrict_points_window_iv"]
_QUERIES["decode_om_cells_batches"] = _QUERIES["decode_om_cells"]
_QUERIES["decode_iv_cells_batches"] = _QUERIES["decode_iv_cells"]
_QUERIES["restrict_points_window_laid_out"] = _QUERIES["restrict_points_window_iv"]
_QUERIES["restrict_own_window_laid_out"] = _QUERIES["restrict_own_window"]
_QUERIES["restrict_daily_template_laid_out"] = _QUERIES["restrict_daily_template"]
_QUERIES["pivot_points_window_laid_out"] = _iv_pivot(f"({_QUERIES['restrict_points_window_iv']})", _THREE)


def _frames_for(text, chosen):
    for name, body in _FRAMES.items():
        if name not in chosen and re.search(rf"\b{name}\b", text):
            _frames_for(body, chosen)
            chosen[name] = body
    return chosen


def oracle_sql():
    result = {}
    for name, text in _QUERIES.items():
        frames = _frames_for(text, {})
        parts = ", ".join(f"{frame} AS ({body})" for frame, body in frames.items())
        result[name] = f"WITH {parts} {text}" if parts else text
    return result
