"""Operators on literal frames, against brute force where the result is not obvious."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterloom.functions.timeslots import DAY_MS, STEP_MS
from meterloom.operators import spread
from meterloom.operators.batches import batch_numbers, dealt
from meterloom.operators.enrich import interval_join, lookup, validity
from meterloom.operators.grid import (
    clipped_grid,
    PACK,
    clipped_ends,
    fill_grid,
    fill_packed,
    own_window_ends,
    own_window_grid,
    packed,
    packed_bounds,
    time_axis,
    time_bounds,
)
from meterloom.operators.pivoting import absent_as, pivot_max
from meterloom.operators.restrict import (
    daily_template,
    hours_range,
    inspection_windows,
    keep_points,
    mark_points,
    own_window,
    points_window,
)
from meterloom.operators.spans import Spans, islands, span_join
from tests.conftest import rows

DAY = 1704412800000
READING = "rowkey string, measuring_point bigint, date bigint, magnitude bigint, value double"


# skew


def test_hot_keys_are_the_largest(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(2,)] * 30 + [(3,)] * 5, "k int")
    assert rows(spread.hot_keys(df, ["k"], hot_rows=10)) == [(1, 5), (2, 3)]
    many = spark.range(60_000).select((F.col("id") % 25_000).alias("k"))
    assert spread.hot_keys(many, ["k"], hot_rows=1).count() == 25_000


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("max_rows", [0, 1000])
@pytest.mark.parametrize("hot_rows", [3, 10, 1000])
def test_bounded_join_equals_plain_join(spark, how, max_rows, hot_rows):
    chance = random.Random(3)
    big = [(i, 1 if i % 3 == 0 else chance.randrange(9)) for i in range(300)]
    big += [(300, None), (301, None)] + [(302, 1)] * 40
    small = [(k, f"{k}-{c}") for k in (1, 1, 2, 3, 11) for c in "ab"] + [(None, "n")]
    left = spark.createDataFrame(big, "i int, k int")
    right = spark.createDataFrame(small, "k int, v string")
    got = spread.bounded_join(left, right, ["k"], how, max_rows, hot_rows=hot_rows)
    assert rows(got) == rows(left.join(right, "k", how).select(*got.columns))


def test_bounded_join_refuses_kinds_that_copies_would_break(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        spread.bounded_join(df, df, ["id"], "right")


def test_salted_hot_key_reaches_several_salts(spark):
    big = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").cast("string").alias("rowkey"))
    hot = spread.hot_keys(big, ["k"], hot_rows=100)
    counts = spread.salted(big, hot, ["k"], ["rowkey"]).groupBy(spread.SALT).count()
    sizes = [n for _, n in rows(counts)]
    assert len(sizes) == 10 and max(sizes) < 200


# range joins


def brute_spans(readings, spans, low_open):
    found = []
    for i, key, time in readings:
        for span, span_key, low, high in spans:
            if None in (key, time, low) or key != span_key:
                continue
            if (low < time if low_open else low <= time) and (high is None or time <= high):
                found.append((i, span))
    return sorted(found)


def random_case(seed):
    chance = random.Random(seed)
    readings = [
        (i, 1 if i % 3 == 0 else chance.randrange(6), chance.randrange(0, 2000)) for i in range(200)
    ]
    readings += [(200, None, 5), (201, 1, None)] + [(202 + i, 1, 700) for i in range(30)]
    spans = []
    for s in range(60):
        low = chance.randrange(-300, 2300)
        spans.append((s, chance.choice([1, 1, 2, 3, 9]), low, low + chance.randrange(-20, 600)))
    spans += [(60, 1, 100, None), (61, 2, None, 500), (62, 1, 700, 700), (63, 3, -50, None)]
    spans += [(64, 1, 0, 1999), (65, 1, 650, 700)] * 2
    return readings, spans


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("low_open", [True, False])
@pytest.mark.parametrize("max_rows", [0, 10_000])
@pytest.mark.parametrize("window", [None, (0, 2000)])
def test_span_join_equals_brute_force(spark, seed, low_open, max_rows, window):
    readings, spans = random_case(seed)
    left = spark.createDataFrame(readings, "i int, k int, t bigint")
    right = spark.createDataFrame(spans, "s int, kk int, low bigint, high bigint")
    side = Spans(right, "kk", F.col("low"), F.col("high"), low_open)
    settings = {"window": window, "max_rows": max_rows, "hot_rows": 5 if seed == 1 else None}
    got = span_join(left, "k", F.col("t"), [side], **settings)
    assert got.columns == ["i", "k", "t", "s", "low", "high"]
    expected = brute_spans(readings, spans, low_open)
    assert rows(got.select("i", "s")) == sorted(expected, key=repr)
    semi = span_join(left, "k", F.col("t"), [side], how="left_semi", **settings)
    assert rows(semi.select("i")) == sorted({(i,) for i, _ in expected}, key=repr)


@pytest.mark.parametrize("hot_rows", [5, None])
@pytest.mark.parametrize("max_rows", [0, 70, 10_000])
def test_two_sides_meet_the_readings_together(spark, max_rows, hot_rows):
    readings, first = random_case(4)
    second = random_case(5)[1][:20]
    left = spark.createDataFrame(readings, "i int, k int, t bigint")
    shape = "kk int, low bigint, high bigint"
    a = spark.createDataFrame(first, f"a int, {shape}").withColumnRenamed("kk", "ka")
    b = spark.createDataFrame(second, f"b int, {shape}").withColumnRenamed("kk", "kb")
    sides = [
        Spans(a.withColumnsRenamed({"low": "al", "high": "ah"}), "ka", F.col("al"), F.col("ah")),
        Spans(b.withColumnsRenamed({"low": "bl", "high": "bh"}), "kb", F.col("bl"), F.col("bh")),
    ]
    got = span_join(left, "k", F.col("t"), sides, max_rows=max_rows, hot_rows=hot_rows)
    one, two = brute_spans(readings, first, False), brute_spans(readings, second, False)
    expected = [(i, s, u) for i, s in one for j, u in two if i == j]
    assert rows(got.select("i", "a", "b")) == sorted(expected, key=repr)


def test_islands_are_unions(spark):
    many = [(1, i, i + 500 + i % 7) for i in range(1000)]
    spans = [*many, (2, 0, 5), (2, 5, 9), (2, 9, 9), (2, 11, 12), (2, 0, 3), (3, -4, 2), (None, 1, 2)]
    found = islands(spark.createDataFrame(spans, "k int, low bigint, high bigint"), "k", "low", "high")
    assert rows(found) == sorted([(1, 0, 1504), (2, 0, 9), (2, 11, 12), (3, -4, 2), (None, 1, 2)], key=repr)


def test_span_join_of_nothing(spark):
    left = spark.createDataFrame([], "i int, k int, t bigint")
    right = spark.createDataFrame([], "s int, kk int, low bigint, high bigint")
    side = Spans(right, "kk", F.col("low"), F.col("high"))
    for max_rows in (0, 10):
        assert rows(span_join(left, "k", F.col("t"), [side], max_rows=max_rows)) == []


def test_interval_ends(spark):
    at = datetime(2024, 1, 5, 12)
    hour = timedelta(hours=1)
    readings = spark.createDataFrame(
        [(i, 1, at + i * hour) for i in range(5)], "i int, measuring_point bigint, date timestamp"
    )
    history = spark.createDataFrame(
        [
            (1, "closed", at, at + 2 * hour, at - hour, None),
            (1, "open", at + hour, None, at - hour, None),
            (1, "both", at, None, at + 2 * hour, at + 3 * hour),
            (1, "unborn", None, None, at - hour, None),
            (2, "other", at, None, at, None),
        ],
        "ID bigint, name string, s1 timestamp, e1 timestamp, s2 timestamp, e2 timestamp",
    )
    sides = [validity(history, "ID", [("s1", "e1"), ("s2", "e2")])]
    expected = [(1, "closed"), (2, "closed"), (2, "open"), (3, "both"), (3, "open"), (4, "open")]
    for max_rows in (0, 100):
        got = interval_join(readings, sides, max_rows=max_rows)
        assert rows(got.select("i", "name")) == expected


def test_lookup_drops_unknown_codes_and_repeats_double_entries(spark):
    readings = spark.createDataFrame([(1, 41), (2, 21), (3, 99)], "i int, source bigint")
    names = spark.createDataFrame([(41, "a"), (41, "b"), (21, "c")], "SOURCE_ID bigint, NAME string")
    for max_rows in (0, 10):
        got = lookup(readings, names, {"source": "SOURCE_ID"}, max_rows)
        assert got.columns == ["i", "source", "NAME"]
        assert rows(got) == [(1, 41, "a"), (1, 41, "b"), (2, 21, "c")]


# restrictions


def test_window_is_inclusive_and_ids_may_be_decimals(spark):
    times = [DAY - 1, DAY, DAY + 10, DAY + 11]
    data = [(f"{p}-{t}", p, t, 13, 1.0) for p in (1, 2) for t in times]
    readings = spark.createDataFrame(data, READING)
    points = spark.sql("SELECT CAST(1 AS DECIMAL(38,10)) AS ID UNION ALL SELECT 1 UNION ALL SELECT 5")
    for max_rows in (0, 10):
        kept = points_window(readings, points, DAY, DAY + 10, max_rows)
        assert rows(kept.select("measuring_point", "date")) == [(1, DAY), (1, DAY + 10)]
    for max_rows in (0, 10):
        assert keep_points(readings, points, max_rows).count() == 4
        marked = mark_points(readings, points, ["date"], max_rows)
        assert marked.columns == readings.columns
        left = [(None, None)] * 4 + [(1, t) for t in times]
        assert rows(marked.select("measuring_point", "date")) == sorted(left, key=repr)
    assert keep_points(readings, points.limit(0)).count() == 0


def om(spark, data):
    return spark.createDataFrame(
        data,
        "rowkey string, measuring_point bigint, day bigint, magnitude bigint, "
        "measurement_interval bigint, period int, value double, source bigint",
    )


def test_hours_are_cut_and_inclusive(spark):
    days = [DAY - 1, DAY, DAY + 3600000, DAY + 7200000 - 1, DAY + 7200000]
    readings = om(spark, [("k", 1, d, 1, 1, 1, 1.0, 41) for d in days] + [("k", 1, DAY, 1, 2, 1, 1.0, 41)])
    kept = hours_range(readings, DAY + 5, DAY + 3600000 + 5, 1)
    assert [d for d, in rows(kept.select("day"))] == days[1:4]


def test_daily_template_keeps_day_starts_of_listed_magnitudes(spark):
    data = [("k", 9, DAY + offset, m, 1, 1, 1.0, 41) for offset in (0, 3600000, DAY_MS, 2 * DAY_MS) for m in (1, 3, 10)]
    kept = daily_template(om(spark, data), DAY, DAY + DAY_MS, 1, [1, 3])
    assert rows(kept.select("day", "magnitude")) == [
        (DAY, 1), (DAY, 3), (DAY + DAY_MS, 1), (DAY + DAY_MS, 3)
    ]


def test_own_windows(spark):
    inspections = spark.createDataFrame(
        [(1, "a", "05/01/2024"), (1, "a", "25/01/2024"), (2, "b", "no date")],
        "ID bigint, CODE string, FECHAI1 string",
    )
    windows = inspection_windows(inspections, "ID", "CODE", days=10)
    starts = [DAY - 10 * DAY_MS, DAY + 10 * DAY_MS]
    assert rows(windows.filter("point = 1").select("window_start")) == [(s,) for s in starts]
    offsets = [-DAY_MS * 10 - 1, -DAY_MS * 10, 0, 1, 3600000, DAY_MS * 5, DAY_MS * 10, DAY_MS * 20 + 1]
    data = [(f"{p}{o}", p, DAY + o, 13, 1.0) for p in (1, 2) for o in offsets]
    readings = spark.createDataFrame(data, READING)
    for max_rows in (0, 1000):
        kept = own_window(readings, windows, "date", max_rows)
        assert [d - DAY for d, in rows(kept.select("date"))] == [
            -DAY_MS * 10, 0, DAY_MS * 10
        ]
        energy = own_window(readings.withColumnRenamed("date", "day"), windows, "day", max_rows)
        assert [d - DAY for d, in rows(energy.select("day"))] == [
            -DAY_MS * 10, 0, 1, DAY_MS * 10, DAY_MS * 20 + 1
        ]
        nothing = own_window(readings, windows.filter("point = 2"), "date", max_rows)
        assert nothing.count() == 0


# grid and pivot


def test_grid_is_anchored_clipped_and_end_exclusive(spark):
    start, stop = DAY + 7, DAY + 7 + 10 * STEP_MS
    chance = random.Random(5)
    bounds = [(0, start, start), (1, start + 1, start + 2), (2, stop, stop + 5), (3, start - 9, stop + 9)]
    for point in range(4, 60):
        low = start + chance.randrange(-3 * STEP_MS, 12 * STEP_MS)
        bounds.append((point, low, low + chance.randrange(0, 6 * STEP_MS)))
    df = spark.createDataFrame(bounds, "measuring_point bigint, min_date bigint, max_date bigint")
    axis = range(start, stop, STEP_MS)
    expected = [(p, s) for p, low, high in bounds for s in axis if low <= s <= high]
    assert rows(clipped_grid(df, start, stop)) == sorted(expected, key=repr)
    assert [s for s, in time_axis(spark, start, stop).collect()] == list(axis)


def test_own_window_grid_has_both_ends(spark):
    df = spark.createDataFrame(
        [(1, DAY, DAY + 2 * STEP_MS), (2, DAY, DAY), (3, DAY, DAY - 1), (4, None, None)],
        "point bigint, window_start bigint, window_stop bigint",
    )
    got = own_window_grid(df).select("point", "slot")
    assert rows(got) == [(1, DAY), (1, DAY + STEP_MS), (1, DAY + 2 * STEP_MS), (2, DAY)]


def test_pivot_keeps_the_largest_and_absent_cells_stay_null(spark):
    data = [(1, 5, 1, 2.0), (1, 5, 1, 9.0), (1, 6, 3, None), (2, 5, 8, 4.0)]
    readings = spark.createDataFrame(data, "p int, t int, magnitude bigint, value double")
    names = {1: "one", 3: "three", 7: "seven"}
    wide = pivot_max(readings, ["p", "t"], names)
    assert rows(wide) == [(1, 5, 9.0, None, None), (1, 6, None, None, None), (2, 5, None, None, None)]
    marked = absent_as(pivot_max(readings, ["p", "t"], names, presence=True), names)
    assert marked.columns == wide.columns
    assert rows(marked.select("p", "t", "three", "seven")) == [
        (1, 5, None, -1.0), (1, 6, None, -1.0), (2, 5, None, -1.0)
    ]
    twice = readings.unionByName(readings)
    assert absent_as(pivot_max(twice, ["p", "t"], names, presence=True), names).count() == 3
    nothing = pivot_max(readings.limit(0), ["p", "t"], names, presence=True)
    assert absent_as(nothing, names).count() == 0


def test_bounds_of_packs_equal_bounds_of_readings(spark):
    chance = random.Random(9)
    data = [("k", chance.randrange(5), chance.randrange(1000), 13, 1.0) for _ in range(200)]
    readings = spark.createDataFrame(data, READING)
    wide = pivot_max(readings, ["measuring_point", "date"], {13: "v", 14: "c"})
    for step in (1, 7, 900_000):
        packs = packed(wide, "measuring_point", "date", ["v", "c"], step)
        assert rows(packed_bounds(packs, "measuring_point")) == rows(time_bounds(readings))


@pytest.mark.parametrize("step", [1, 7, 60])
@pytest.mark.parametrize("origin", [0, -5000, 3])
def test_packed_fill_equals_slot_by_slot(spark, step, origin):
    """Packs of 96 slots on grids of any step and origin, also before the epoch, with readings on and off the grid."""
    chance = random.Random(step)
    moments = {(p, origin + chance.randrange(-300 * step, 700 * step)) for p in range(4) for _ in range(400)}
    wide = spark.createDataFrame([(p, t, float(t)) for p, t in moments], "measuring_point bigint, date bigint, v double")
    packs = packed(wide, "measuring_point", "date", ["v"], step)
    assert packs.selectExpr("max(size(__cells))").first()[0] <= PACK
    start, stop = origin, origin + 500 * step + 1
    bounds = time_bounds(wide).withColumn("label", F.col("measuring_point") * 2)
    by_slot = fill_grid(clipped_grid(bounds, start, stop, step), wide, "measuring_point", "date")
    got = fill_packed(clipped_ends(bounds, start, stop, step), packs, "measuring_point", ["v"], step)
    assert got.columns == by_slot.columns and got.count() > 1000
    assert rows(got) == rows(by_slot)
    windows = [(p, origin + chance.randrange(-400 * step, 400 * step), n) for p in range(6) for n in (0, 1, 95 * step, 300 * step + 2)]
    shape = "point bigint, window_start bigint, window_stop bigint"
    own = spark.createDataFrame([(p, a, a + n) for p, a, n in windows] + [(1, 5, 4), (2, None, None)], shape)
    by_slot = fill_grid(own_window_grid(own, step).select("point", "slot"), wide, "point", "date")
    got = fill_packed(own_window_ends(own), packs, "point", ["v"], step)
    assert rows(got) == rows(by_slot)


def test_fill_needs_exact_slots(spark):
    grid = spark.createDataFrame([(1, 0), (1, 10), (2, 0)], "measuring_point bigint, slot bigint")
    wide = spark.createDataFrame([(1, 10, 5.0), (1, 11, 6.0), (2, 5, 7.0)], "measuring_point bigint, date bigint, v double")
    got = fill_grid(grid, wide, "measuring_point", "date")
    assert rows(got) == [(1, 0, None), (1, 10, 5.0), (2, 0, None)]


# batches


@pytest.mark.parametrize("ranges", [2, 16])
@pytest.mark.parametrize("size", [1, 7, 1000])
def test_batches_are_consecutive_in_order(spark, ranges, size):
    chance = random.Random(size)
    data = [(chance.randrange(50), chance.choice("ab")) for _ in range(120)] + [(13, "a")] * 60
    df = spark.createDataFrame(data, "id bigint, name string")
    expected = [(*row, i // size + 1) for i, row in enumerate(sorted(data))]
    assert rows(batch_numbers(df, "id", size, ranges=ranges)) == sorted(expected, key=repr)
    second = batch_numbers(df, "id", size, batch=2, ranges=ranges)
    assert rows(second) == sorted((r for r in expected if r[2] == 2), key=repr)


def test_batches_with_nulls_and_rows_of_one_point(spark):
    data = [(7, i) for i in range(3000)] + [(i, None) for i in range(1500)] + [(None, i) for i in range(1500)]
    df = spark.createDataFrame(data, "id bigint, place bigint")
    first = sorted(data, key=lambda r: tuple((v is not None, v or 0) for v in r))
    expected = [(*row, i // 100 + 1) for i, row in enumerate(first)]
    assert rows(batch_numbers(df, "id", 100)) == sorted(expected, key=repr)


def test_a_point_with_half_of_the_list_is_spread(spark):
    df = spark.range(8000).selectExpr("if(id < 4000, 7, id) id", "id place")
    counts = dealt(df, ["id", "place"], 8).groupBy("__range").count().collect()
    assert len(counts) == 8 and max(r["count"] for r in counts) < 2000
    of_one = dealt(df, ["id", "place"], 8).filter("id = 7").select("__range").distinct().count()
    assert of_one >= 4


def test_batches_shuffle_into_ranges_once(spark):
    found = batch_numbers(spark.range(1000).selectExpr("id % 100 id", "id place"), "id", 10)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("rangepartitioning(") == 2  # one is named where it is reused
    assert "approx" not in plan


def test_batches_of_nothing(spark):
    assert batch_numbers(spark.createDataFrame([], "id bigint"), "id", 5).count() == 0
