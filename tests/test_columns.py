"""Column functions: times, keys, labels, cells."""

import math
import random
import struct
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from meterloom.functions import keys, labels, timeslots
from meterloom.sources import cells

DAY = 1704412800000  # 2024-01-05 00:00 UTC


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize(
    "period, rolled, wrapped",
    [
        (0, datetime(2024, 1, 5, 0, 0), "2024-01-05 00:00"),
        (1, datetime(2024, 1, 5, 0, 15), "2024-01-05 00:15"),
        (95, datetime(2024, 1, 5, 23, 45), "2024-01-05 23:45"),
        (96, datetime(2024, 1, 6, 0, 0), "2024-01-05 00:00"),
        (97, datetime(2024, 1, 6, 0, 15), "2024-01-05 00:15"),
    ],
)
def test_both_slot_conventions(spark, period, rolled, wrapped):
    day, number = F.lit(DAY), F.lit(period)
    got = one(
        spark,
        ms=timeslots.slot_ms(day, number),
        rolled=timeslots.slot_timestamp(day, number, rollover=True),
        text=timeslots.slot_text(timeslots.day_of(day), number),
        wrapped=timeslots.slot_timestamp(day, number),
        parsed=timeslots.slot_text_timestamp(timeslots.slot_text(timeslots.day_of(day), number)),
    )
    assert got.ms == DAY + period * timeslots.STEP_MS
    assert got.rolled == rolled
    assert got.text == wrapped
    assert got.wrapped == got.parsed == datetime.strptime(wrapped, "%Y-%m-%d %H:%M")


def test_period_past_hour_24_has_no_wrapped_time(spark):
    text = timeslots.slot_text(timeslots.day_of(F.lit(DAY)), F.lit(100))
    got = one(
        spark,
        text=text,
        time=timeslots.slot_timestamp(F.lit(DAY), F.lit(100)),
        parsed=timeslots.slot_text_timestamp(text),
    )
    assert got.text == "2024-01-05 25:00" and got.time is None and got.parsed is None


def test_epoch_seconds_pass_2038(spark):
    got = one(spark, s=timeslots.epoch_seconds(F.lit(5_000_000_000_999)))
    assert got.s == 5_000_000_000


def test_report_dates(spark):
    got = one(
        spark,
        good=timeslots.report_date(F.lit("05/01/2024")),
        short=timeslots.report_date(F.lit("5/1/2024")),
        bad=timeslots.report_date(F.lit("2024-01-05")),
        none=timeslots.report_date(F.lit(None).cast("string")),
        **{
            f"bad{i}": timeslots.report_date(F.lit(text))
            for i, text in enumerate(["", "05/01", "1/2024", "05/01/24", "05/01/2024/9", "31/02/2024"])
        },
        compact=timeslots.compact_date(timeslots.report_date(F.lit("05/01/2024"))),
        hours=timeslots.date_hours(timeslots.report_date(F.lit("05/01/2024"))),
    )
    assert got.good == got.short == date(2024, 1, 5)
    assert got.bad is None and got.none is None
    assert all(got[f"bad{i}"] is None for i in range(6))
    assert got.compact == "20240105"
    assert got.hours == DAY // 3600000


def test_argument_zone():
    west = timezone(timedelta(hours=-3))
    assert timeslots.argument_ms("202401050000") == DAY
    assert timeslots.argument_ms("202401050000", west) == DAY + 3 * 3600000


def test_day_starts_step_calendar_days():
    hours = timeslots.day_start_hours(DAY, DAY + 2 * timeslots.DAY_MS)
    assert hours == [DAY // 3600000 + 24 * i for i in range(3)]
    start = timeslots.argument_ms("202403300000", "Europe/Madrid")
    stop = timeslots.argument_ms("202404010000", "Europe/Madrid")
    first, second, third = timeslots.day_start_hours(start, stop, "Europe/Madrid")
    assert (second - first, third - second) == (24, 23)


def test_row_keys(spark):
    got = one(
        spark,
        short=keys.iv_row_key(F.lit(42), F.lit(DAY), F.lit("00000")),
        long=keys.padded_point(F.lit(1234567890)),
        om=keys.om_row_key(F.lit(42), F.lit(1), F.lit(DAY), F.lit("00000")),
        clean=keys.clean_row_key(F.lit("key 12:00")),
        whole=keys.clean_row_key(F.lit("key")),
    )
    assert got.short == "00000042" + "0" + str(DAY) + "00000"
    assert got.long == "1234567890"
    assert got.om == "00000042" + "1" + f"{DAY // 3600000:010d}" + "00000"
    assert got.clean == got.whole == "key"


def test_labels(spark):
    got = one(
        spark,
        quarter=labels.interval_label(F.lit(1).cast("bigint")),
        other=labels.interval_label(F.lit(-1).cast("bigint")),
        unknown=labels.interval_label(F.lit(None).cast("bigint")),
        gap=labels.gap_text(F.lit(None).cast("double")),
        value=labels.gap_text(F.lit(1.5)),
    )
    assert tuple(got) == ("QH", "-1", "INSTANTANEO", "NaN", "1.5")


def test_decoded_numbers_equal_their_bits(spark):
    chance = random.Random(7)
    bits = [chance.getrandbits(64) for _ in range(3000)]
    bits += [0, 1 << 63, 1, (1 << 52) - 1, 1 << 52, 0x7FF << 52, 0xFFF << 52, (0x7FF << 52) + 1]
    bits += [struct.unpack(">Q", struct.pack(">d", v))[0] for v in (1.0, -1.0, 0.1, 490.02, 5e-324)]
    data = [(i, b.to_bytes(8, "big"), (b >> 32).to_bytes(4, "big")) for i, b in enumerate(bits)]
    df = spark.createDataFrame(data, "i int, wide binary, narrow binary").select(
        "i",
        cells.big_endian_double(F.col("wide")).alias("double"),
        cells.big_endian_long(F.col("wide")).alias("long"),
        cells.big_endian_int(F.col("narrow")).alias("int"),
    )
    for row in df.collect():
        wide = bits[row.i].to_bytes(8, "big")
        number = struct.unpack(">d", wide)[0]
        assert row["long"] == struct.unpack(">q", wide)[0]
        assert row["int"] == struct.unpack(">i", wide[:4])[0]
        if math.isnan(number):
            assert math.isnan(row["double"])
        else:
            assert row["double"] == number


CELLS = [
    ("k1 10:00", "M", (13).to_bytes(8, "big")),
    ("k1 10:00", "MP", (7).to_bytes(8, "big")),
    ("k1 10:00", "D", DAY.to_bytes(8, "big")),
]


def stored(spark, rows):
    return spark.createDataFrame(rows, "rowkey string, qualifier string, value binary")


def test_absent_iv_cells(spark):
    wide = cells.gather_cells(stored(spark, CELLS), "iv")
    row = cells.decode_iv(wide).first()
    assert (row.rowkey, row.magnitude, row.measuring_point, row.date) == ("k1", 13, 7, DAY)
    assert row.value is None and row.source is None and row.validation_result is None
    row = cells.decode_iv(wide, missing="sentinel").first()
    assert (row.value, row.source, row.validation_result) == (-1.0, -1, "")


def test_strict_records_fail_on_absent_cells(spark):
    with pytest.raises(Exception, match="is absent"):
        cells.decode_om(cells.gather_cells(stored(spark, CELLS), "om")).collect()


def test_cells_of_wrong_length_fail(spark):
    wrong = [("k1", "V", b"\x00\x01")]
    with pytest.raises(Exception, match="does not hold 8 bytes"):
        cells.decode_iv(cells.gather_cells(stored(spark, wrong), "iv")).collect()


def test_event_texts_may_be_absent(spark):
    names = {"D": 8, "L": 8, "MP": 8, "S": 8, "T": 8}
    data = [("k", q, (5).to_bytes(n, "big")) for q, n in names.items()]
    row = cells.decode_event(cells.gather_cells(stored(spark, data), "event")).first()
    assert row.event_type == 5 and row.file is None
