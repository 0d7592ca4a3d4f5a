"""Laid-out reading tables, repeated runs and rejected dates."""

import os
import struct

import pytest
from pyspark.sql import functions as F

from meterloom.checks import registry
from meterloom.checks.fixtures import Fixtures
from meterloom.functions.timeslots import DAY_MS, STEP_MS
from meterloom.operators.grid import packed, packed_bounds
from meterloom.operators.pivoting import pivot_max
from meterloom.operators.restrict import (
    daily_template,
    hours_range,
    inspection_windows,
    own_window,
    points_hours,
    points_window,
    unreadable_dates,
)
from meterloom.schemas import DAY_COLUMN, IV, THREE_PHASE_COLUMNS
from meterloom.sinks.files import write_csv, write_parquet
from meterloom.sources.cells import decode_batches, decode_cells, gather_cells
from meterloom.sources.layout import open_bucketed, save_bucketed, with_day, write_by_day
from meterloom.sources.tables import read_readings
from tests.conftest import rows
from tests.test_plans import DAY, executed_nodes, iv_row, metric, plan, run_job, stored  # noqa: F401

START, STOP = registry.START, registry.STOP


def test_days_are_those_of_utc_also_before_the_epoch(spark):
    times = [-1, 0, DAY_MS - 1, DAY_MS, -DAY_MS, -DAY_MS - 1]
    df = spark.createDataFrame([iv_row(1, t, 13, 1.0) for t in times], IV)
    found = {r["date"]: str(r[DAY_COLUMN]) for r in with_day(df, "iv").collect()}
    days = ["1969-12-31", "1970-01-01", "1970-01-01", "1970-01-02", "1969-12-31", "1969-12-30"]
    assert found == dict(zip(times, days, strict=True))


@pytest.fixture(scope="module")
def by_day(spark, base, tmp_path_factory):
    folder = tmp_path_factory.mktemp("days")
    f = Fixtures(spark, base)
    for kind in ("iv", "om"):
        write_by_day(getattr(f, kind), f"{folder}/{kind}", kind)
    return {kind: read_readings(spark, f"{folder}/{kind}", kind) for kind in ("iv", "om")} | {"f": f}


def restrictions(f, iv, om):
    some = f["measuring_point"].select(F.col("id").alias("ID"))
    batch = f["inspected_batch"].select(F.upper("punto_servicio").alias("CODE"), F.col("punto_medida_interno").alias("ID"), F.col("fechai1").alias("FECHAI1"))
    early = inspection_windows(batch, "ID", "CODE", days=3).filter(F.col("window_stop") < DAY + 3 * DAY_MS)
    return {
        "R1": points_window(iv, some, START, STOP),
        "R2": points_hours(om, some, START, STOP, 1),
        "R3": own_window(om, early, "day"),
        "R4": own_window(iv, early, "date"),
        "R5": daily_template(om, START, STOP, 1, [1, 3]),
        "hours": hours_range(om, START, STOP, 1),
    }


@pytest.mark.parametrize("name", ["R1", "R2", "R3", "R4", "R5", "hours"])
def test_restrictions_read_only_their_days(spark, by_day, capsys, name):
    found = restrictions(by_day["f"], by_day["iv"], by_day["om"])[name]
    filters = [x for x in plan(found, capsys).splitlines() if x.startswith("PartitionFilters")]
    assert any(DAY_COLUMN in x and (">=" in x or " IN" in x) for x in filters), filters
    plain = restrictions(by_day["f"], by_day["f"].iv, by_day["f"].om)[name]
    assert rows(found.select(*plain.columns)) == rows(plain)
    scans = [n for n in executed_nodes(found) if DAY_COLUMN in n.toString() and n.nodeName().startswith("Scan")]
    read = sum(n.metrics().apply("numPartitions").value() for n in scans)
    days = by_day["iv" if name in ("R1", "R4") else "om"].select(DAY_COLUMN).distinct().count()
    assert 0 < read < days


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("buckets")
    data = spark.range(40_000).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("rowkey"),
        (F.lit(13) + F.col("id") % 6).alias("magnitude"),
        F.lit(1).cast("bigint").alias("measurement_interval"),
        F.lit(41).cast("bigint").alias("source"),
        (F.col("id") % 50).alias("measuring_point"),
        F.sqrt("id").alias("value"),
        (F.lit(DAY) + (F.col("id") * 7919 % 40_000) * STEP_MS / 100).cast("bigint").alias("date"),
        F.col("id").alias("last_update_time"),
        F.sha2(F.col("id").cast("string"), 256).alias("validation_result"),
    )
    path = f"file://{folder}/iv"
    save_bucketed(data, "bucketed_iv", "iv", 4, path=path, row_group_bytes=64 << 10)
    yield data, path
    spark.sql("DROP TABLE IF EXISTS bucketed_iv")


def test_point_buckets_need_no_exchange(spark, bucketed, capsys):
    data, _ = bucketed
    table = spark.table("bucketed_iv")
    chosen = spark.range(30).select(F.col("id").alias("ID"))
    stop = DAY + 20 * STEP_MS
    kept = points_window(table, chosen, DAY, stop)
    wide = pivot_max(kept, ["measuring_point", "date"], THREE_PHASE_COLUMNS)
    packs = packed(wide, "measuring_point", "date", list(THREE_PHASE_COLUMNS.values()))
    for result in (wide, packs, packed_bounds(packs, "measuring_point")):
        text = plan(result, capsys)
        assert "hashpartitioning" not in text and "Bucketed: true" in text
    plain = pivot_max(points_window(data, chosen, DAY, stop), ["measuring_point", "date"], THREE_PHASE_COLUMNS)
    assert rows(wide) == rows(plain)


def test_row_groups_outside_the_window_are_skipped(spark, bucketed):
    data, _ = bucketed
    early = spark.table("bucketed_iv").filter(F.col("date") < DAY + 10 * STEP_MS)
    want = data.filter(F.col("date") < DAY + 10 * STEP_MS).count()
    nodes = executed_nodes(early.select("rowkey", "date"))
    assert want <= metric(nodes, "Scan", "numOutputRows") < 40_000 / 4


def test_buckets_are_opened_in_another_session(spark, bucketed, tmp_path, base):
    data, path = bucketed
    again = open_bucketed(spark, "bucketed_again", path, "iv", 4)
    assert rows(again.select("rowkey", "date")) == rows(data.select("rowkey", "date"))
    f = Fixtures(spark, base)
    save_bucketed(f.om, "bucketed_om", "om", 3, path=f"file://{tmp_path}/om", by_day=True)
    again = open_bucketed(spark, "bucketed_om_again", f"file://{tmp_path}/om", "om", 3, by_day=True)
    assert rows(again.drop(DAY_COLUMN).select(*f.om.columns)) == rows(f.om)
    for name in ("bucketed_again", "bucketed_om", "bucketed_om_again"):
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("write", [write_csv, write_parquet])
def test_a_repeated_run_replaces_only_itself(spark, tmp_path, write):
    path = f"{tmp_path}/runs"
    assert write(spark.range(10), path, run="a") == 10
    assert write(spark.range(10, 15), path, run="b", num_files=2) == 5
    assert write(spark.range(7), path, run="a", sort_by=["id"]) == 7
    kind = "csv" if write is write_csv else "parquet"
    found = spark.read.format(kind).option("header", True).load(path)
    assert rows(found.groupBy("run").count()) == [("a", 7), ("b", 5)]


def test_a_job_run_twice_leaves_no_doubles(spark, base, stored, tmp_path, capsys):  # noqa: F811
    window = ["--start", str(START), "--stop", str(STOP)]
    for name in ("x", "y", "x"):
        run_job(spark, stored, "iv-curves", *window, "--run", name, "--out", f"{tmp_path}/i", tables=("iv",))
    got = spark.read.csv(f"{tmp_path}/i/triphasic", header=True)
    want = registry.queries()["grid_iv_curve_triphasic"](spark, base).count()
    assert rows(got.groupBy("run").count()) == [("x", want), ("y", want)]
    minutes = ["--start", "202401050000", "--stop", "202401200000"]
    for _ in range(2):
        run_job(spark, stored, "energy-curves", *minutes, "--run", "x", "--out", f"{tmp_path}/e")
    want = registry.queries()["grid_energy_curve_raw_ids"](spark, base).count()
    assert spark.read.csv(f"{tmp_path}/e").count() == want
    capsys.readouterr()


def test_unreadable_dates_are_counted_and_listed(spark, stored, tmp_path, capsys):  # noqa: F811
    inspections = spark.createDataFrame([("A", "05/01/2024"), ("B", "31/31/2024"), ("C", None), ("D", "")], "c string, FECHAI1 string")
    assert [r["c"] for r in unreadable_dates(inspections).orderBy("c").collect()] == ["B", "C", "D"]
    folder = f"{tmp_path}/inventory"
    os.makedirs(folder)
    for name in os.listdir(f"{stored}/inventory"):
        if name != "inspected_batch":
            os.symlink(f"{stored}/inventory/{name}", f"{folder}/{name}")
    batch = spark.read.parquet(f"{stored}/inventory/inspected_batch").withColumn(
        "fechai1", F.when(F.col("punto_medida_interno") % 10 == 0, "no date").otherwise(F.col("fechai1"))
    )
    batch.write.parquet(f"{folder}/inspected_batch")
    wrong = batch.filter("fechai1 = 'no date'").count()
    paths = ["--om", f"{stored}/om", "--inventory", folder, "--rejects", f"{tmp_path}/rejects"]
    from meterloom import jobs

    jobs.main(["energy-before-inspection", *paths, "--out", f"{tmp_path}/b"], spark)
    assert f"{wrong} inspections without a readable date" in capsys.readouterr().out
    assert spark.read.csv(f"{tmp_path}/rejects", header=True).count() == wrong > 0


def test_cells_decoded_by_batches_equal_expressions(spark, base, tmp_path):
    """From stored cells, with absent cells, special doubles and clashing lengths."""
    f = Fixtures(spark, base)
    for kind, strict in (("iv", False), ("om", True), ("event", True)):
        gather_cells(f.cells(kind), kind).write.parquet(f"{tmp_path}/{kind}")
        cells = spark.read.parquet(f"{tmp_path}/{kind}")
        for missing in ("null", "sentinel"):
            batches = decode_batches(cells, kind, strict, missing)
            assert batches.schema.names == decode_cells(cells, kind, strict, missing).schema.names
            assert rows(batches) == rows(decode_cells(cells, kind, strict, missing))
    iv = spark.read.parquet(f"{tmp_path}/iv")
    doubles = [0.0, -0.0, 5e-324, -1.5, 1.7e308, float("inf"), float("-inf")]
    for double in doubles:
        raw = F.unhex(F.lit(struct.pack(">d", double).hex()))
        assert decode_batches(iv.withColumn("V", raw).limit(3), "iv", False).select("value").distinct().collect() == [(double,)]
    for broken in (F.unhex(F.lit("0102")), F.lit(None).cast("binary")):
        with pytest.raises(Exception, match="cell V of a om record"):
            decode_batches(spark.read.parquet(f"{tmp_path}/om").withColumn("V", broken), "om", True).collect()
    assert decode_batches(iv.limit(0), "iv", False).count() == 0
