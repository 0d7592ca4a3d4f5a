"""Declared schemas of the reading tables; sources never infer types."""

from pyspark.sql import types as T


def _fields(*pairs):
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


OM = _fields(
    ("rowkey", T.StringType()),
    ("day", T.LongType()),
    ("magnitude", T.LongType()),
    ("measurement_interval", T.LongType()),
    ("measuring_point", T.LongType()),
    ("period", T.IntegerType()),
    ("value", T.DoubleType()),
    ("validation_result", T.StringType()),
    ("source", T.LongType()),
    ("last_update_time", T.LongType()),
)

IV = _fields(
    ("rowkey", T.StringType()),
    ("magnitude", T.LongType()),
    ("measurement_interval", T.LongType()),
    ("source", T.LongType()),
    ("measuring_point", T.LongType()),
    ("value", T.DoubleType()),
    ("date", T.LongType()),
    ("last_update_time", T.LongType()),
    ("validation_result", T.StringType()),
)

EVENT = _fields(
    ("rowkey", T.StringType()),
    ("day", T.LongType()),
    ("file", T.StringType()),
    ("information", T.StringType()),
    ("last_update_time", T.LongType()),
    ("measuring_point", T.LongType()),
    ("source", T.LongType()),
    ("event_type", T.LongType()),
)

CELLS = _fields(
    ("rowkey", T.StringType()),
    ("qualifier", T.StringType()),
    ("value", T.BinaryType()),
)

SCHEMAS = {"om": OM, "iv": IV, "event": EVENT}

#: The column that holds a kind's stored time, and the day folder of a table laid out by day.
TIMES = {"om": "day", "iv": "date", "event": "day"}
DAY_COLUMN = "reading_day"

# The short cell name that stores each field, per kind of record.
QUALIFIERS = {
    "om": {
        "day": "D",
        "magnitude": "M",
        "measurement_interval": "MI",
        "measuring_point": "MP",
        "period": "P",
        "value": "V",
        "validation_result": "VR",
        "source": "S",
        "last_update_time": "L",
    },
    "iv": {
        "magnitude": "M",
        "measurement_interval": "MI",
        "source": "S",
        "measuring_point": "MP",
        "value": "V",
        "date": "D",
        "last_update_time": "L",
        "validation_result": "VR",
    },
    "event": {
        "day": "D",
        "file": "F",
        "information": "I",
        "last_update_time": "L",
        "measuring_point": "MP",
        "source": "S",
        "event_type": "T",
    },
}

# Magnitude numbers and the report columns they feed.
ENERGY_COLUMNS = {1: "active_energy", 3: "reactive_energy_1"}
SINGLE_PHASE_COLUMNS = {13: "voltage_phase_1", 14: "current_phase_1"}
THREE_PHASE_COLUMNS = {
    13: "voltage_phase_1",
    15: "voltage_phase_2",
    17: "voltage_phase_3",
    14: "current_phase_1",
    16: "current_phase_2",
    18: "current_phase_3",
}
QUARTER_HOUR = 1
ENERGY_SOURCE = 41
