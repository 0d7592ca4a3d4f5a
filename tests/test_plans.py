"""Extracts on literal frames, their physical plans, files and command line."""

import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from meterloom import jobs
from meterloom.checks import registry
from meterloom.checks.fixtures import Fixtures
from meterloom.functions.timeslots import DAY_MS, STEP_MS
from meterloom.operators.restrict import points_window
from meterloom.plans import curves, extract, inventory
from meterloom.schemas import CELLS, EVENT, IV, OM
from meterloom.sinks.files import counted, run_stamp, stamped, write_csv, write_parquet
from meterloom.sources.cells import gather_cells
from meterloom.sources.tables import INVENTORY_TABLES, jdbc_options, read_inventory, read_readings
from tests.conftest import rows

DAY = 1704412800000
SECOND = DAY // 1000


def om_row(point, day, period, magnitude, value, source=41, interval=1):
    key = f"{point}-{day}-{period}-{magnitude}-{value}"
    return (key, day, magnitude, interval, point, period, value, "", source, day)


def iv_row(point, date, magnitude, value, interval=1):
    return (f"{point}-{date}-{magnitude}", magnitude, interval, 41, point, value, date, date, "")


def points(spark, *pairs):
    return spark.createDataFrame(list(pairs), "ID bigint, CODE string")


@pytest.fixture
def energy(spark):
    return spark.createDataFrame(
        [
            om_row(1, DAY, 1, 1, 2.0),
            om_row(1, DAY, 1, 1, 3.0),
            om_row(1, DAY, 4, 1, 5.0),
            om_row(1, DAY, 2, 1, 9.0, source=21),
            om_row(2, DAY, 96, 3, 7.0),
            om_row(3, DAY + DAY_MS, 1, 1, 1.0),
        ],
        OM,
    )


def test_energy_curve_fills_gaps_and_keeps_the_largest(spark, energy):
    chosen = points(spark, (1, "A"), (1, "A2"), (2, "B"))
    for max_rows in (0, 100):
        got = curves.energy_curves(energy, chosen, DAY, DAY + DAY_MS, max_rows=max_rows)
        one = [(SECOND + 900, 3.0), (SECOND + 1800, None), (SECOND + 2700, None), (SECOND + 3600, 5.0)]
        expected = [(code, day, value, None) for code in ("A", "A2") for day, value in one]
        assert rows(got) == expected  # the slot of point 2 is the exclusive end


def test_period_96_is_the_next_day(spark, energy):
    got = curves.energy_curves(energy, None, DAY, DAY + DAY_MS + 1)
    assert (2, SECOND + 86400, None, 7.0) in rows(got)


def test_absent_magnitude_differs_from_absent_cell(spark, energy):
    only_active = energy.filter("magnitude = 1")
    chosen = points(spark, (1, "A"))
    marked = curves.energy_curves(only_active, chosen, DAY, DAY + DAY_MS)
    assert {row[3] for row in rows(marked)} == {-1.0}
    assert {row[3] for row in rows(curves.energy_curves(energy, chosen, DAY, DAY + DAY_MS))} == {None}
    text = curves.energy_curves(only_active, chosen, DAY, DAY + DAY_MS, gaps="text", absent=None)
    assert rows(text)[:2] == [("A", SECOND + 900, "3.0", "NaN"), ("A", SECOND + 1800, "NaN", "NaN")]


def test_no_points_no_rows(spark, energy):
    assert curves.energy_curves(energy, points(spark, (99, "Z")), DAY, DAY + DAY_MS).count() == 0
    assert curves.energy_curves(energy.limit(0), None, DAY, DAY + DAY_MS).count() == 0


def test_iv_curve_interval_phase_and_offgrid(spark):
    readings = spark.createDataFrame(
        [
            iv_row(1, DAY, 13, 220.5),
            iv_row(1, DAY + 1, 14, 3.0),
            iv_row(1, DAY + 2 * STEP_MS, 14, 4.0),
            iv_row(1, DAY + 3 * STEP_MS, 13, 1.0, interval=2),
            iv_row(1, DAY + 4 * STEP_MS, 15, 1.0),
        ],
        IV,
    )
    single = curves.iv_curves(readings, points(spark, (1, "A")), DAY, DAY + DAY_MS, phases=1)
    assert rows(single) == [
        ("A", SECOND, "220.5", "NaN"),
        ("A", SECOND + 900, "NaN", "NaN"),
        ("A", SECOND + 1800, "NaN", "4.0"),
    ]
    three = curves.iv_curves(readings, points(spark, (1, "A")), DAY, DAY + DAY_MS)
    assert three.count() == 5 and len(three.columns) == 8


def test_every_inspection_gets_its_own_grid(spark):
    readings = spark.createDataFrame([iv_row(1, DAY, 13, 220.5), iv_row(1, DAY + 1, 13, 9.0)], IV)
    inspections = spark.createDataFrame(
        [(1, "A", "05/01/2024"), (1, "A", "06/01/2024"), (2, "B", "06/01/2024")],
        "PUNTO_MEDIDA_MDM bigint, PUNTO_SERVICIO string, FECHAI1 string",
    )
    got = curves.iv_before_inspection(readings, inspections, days=1)
    assert got.count() == 3 * 97
    read = got.filter("voltage_phase_1 != 'NaN'").select("measuring_point", "date", "voltage_phase_1")
    assert rows(read) == [("A", SECOND, "220.5")] * 2


def test_energy_before_inspection_by_window_or_by_point(spark):
    readings = spark.createDataFrame(
        [om_row(1, DAY, 96, 1, 2.0), om_row(1, DAY + DAY_MS, 1, 3, 4.0), om_row(1, DAY - 9 * DAY_MS, 1, 1, 8.0)],
        OM,
    )
    inspections = spark.createDataFrame(
        [(1, "A", "05/01/2024"), (1, "B", "06/01/2024")],
        "PUNTO_MEDIDA_INTERNO bigint, PUNTO_SERVICIO string, FECHAI1 string",
    )
    first, second = datetime(2024, 1, 5), datetime(2024, 1, 6, 0, 15)
    for max_rows in (0, 100):
        own = curves.energy_before_inspection(readings, inspections, 1, max_rows=max_rows)
        assert rows(own) == [("A", first, 2.0, None), ("B", first, 2.0, None), ("B", second, None, 4.0)]
        legacy = curves.energy_before_inspection(readings, inspections, 1, True, max_rows=max_rows)
        assert rows(legacy) == [(c, t, *v) for c in "AB" for t, v in ((first, (2.0, None)), (second, (None, 4.0)))]
    rolled = curves.energy_before_inspection(readings, inspections, 1, rollover=True)
    assert ("A", datetime(2024, 1, 6), 2.0, None) in rows(rolled)


def test_extract_is_the_same_without_broadcast(spark, base):
    f = Fixtures(spark, base)
    window = (registry.START, registry.STOP)
    plain = extract.indirect_extract(f.iv_all_magnitudes, f.om, f, *window)
    shuffled = extract.indirect_extract(f.iv_all_magnitudes, f.om, f, *window, max_rows=0)
    assert rows(plain) == rows(shuffled)
    assert plain.columns == list(extract.HEADINGS.values())


def test_three_phase_inspections_rank_ties_and_install_date(spark):
    text = {
        "service_point": ("punto_servicio string, numero_placa string, fases string", [
            ("A", "0701", "TRIFASICO "), ("B", "0702", "TRIFASICO"), ("C", "0703", "MONOFASICO"), ("D", "0804", "TRIFASICO"),
        ]),
        "meter": ("numero_placa string, fecha_desde date", [
            ("0701", datetime(2024, 1, 3).date()), ("0702", None), ("0703", datetime(2024, 1, 1).date()),
        ]),
        "inspection_history": ("id string, fecha string, fechai1 string, commit_dttm timestamp", [
            ("A", "01/02/2024", "09/01/2024", datetime(2024, 3, 1)),
            ("A", "02/02/2024", "03/01/2024", datetime(2024, 2, 2)),
            ("A", "02/02/2024", "04/01/2024", datetime(2024, 2, 2)),
            ("A", "02/02/2024", "05/01/2024", datetime(2024, 2, 1)),
            ("A", "02/02/2024", None, datetime(2024, 2, 9)),
            ("B", "02/02/2024", "05/01/2024", datetime(2024, 2, 1)),
            ("C", "02/02/2024", "05/01/2024", datetime(2024, 2, 1)),
        ]),
        "measuring_point": ("id bigint, code string", [(1, "A"), (2, "B"), (3, "C")]),
    }
    inv = {name: spark.createDataFrame(data, shape) for name, (shape, data) in text.items()}
    assert rows(inventory.inspected_three_phase_points(inv)) == [(1, "03/01/2024"), (1, "04/01/2024")]
    assert rows(inventory.count_three_phase_points(inv)) == [(1,)]


# physical plans


def plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_nested_loops_and_no_python(spark, base, capsys, name):
    text = plan(registry.queries()[name](spark, base), capsys)
    assert "BroadcastNestedLoopJoin" not in text
    assert "CartesianProduct" not in text
    if not name.startswith("decode"):  # the fixture encodes doubles in Python
        assert "Python" not in text and "Pandas" not in text


def test_curve_reads_its_readings_once(spark, energy, tmp_path):
    energy.write.parquet(f"{tmp_path}/om")
    stored = read_readings(spark, f"{tmp_path}/om", "om")
    curve = curves.energy_curves(stored, None, DAY, DAY + DAY_MS, absent=None)
    curve.collect()
    executed = curve._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in executed
    assert executed.count("FileScan") == 1


def test_restrictions_reach_the_scan(spark, energy, tmp_path, capsys):
    energy.write.parquet(f"{tmp_path}/om")
    stored = read_readings(spark, f"{tmp_path}/om", "om")
    text = plan(curves.energy_curves(stored, None, DAY, DAY + DAY_MS), capsys)
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    for part in ("measurement_interval,1", "magnitude, [1,3]", "GreaterThanOrEqual(day", "source,41"):
        assert part in pushed
    assert "validation_result" not in text and "last_update_time" not in text


def test_chosen_group_is_no_shuffle_key(spark, base, capsys):
    text = plan(inventory.points_by_group(Fixtures(spark, base), registry.GROUP), capsys)
    assert "hashpartitioning(measuring_point_group" not in text


def executed_nodes(df, scalars=True):
    """Nodes of the plan that ran, stages opened, each reused exchange left out."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name.startswith("ReusedExchange") or name.startswith("ReusedSubquery"):
            return None
        found.append(node)
        for kind in ("children", "subqueries") if scalars else ("children",):
            below = getattr(node, kind)()
            for i in range(below.size()):
                walk(below.apply(i).child() if below.apply(i).nodeName().startswith("Subquery") else below.apply(i))
        return None

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return found


def metric(nodes, kind, name):
    return sum(n.metrics().apply(name).value() for n in nodes if n.nodeName().startswith(kind))


def test_inspection_grids_travel_packed(spark):
    """A shuffled row for 96 slots, not for each: a twentieth of the grid at most."""
    readings = spark.createDataFrame([iv_row(1, DAY - i * STEP_MS, 13, 220.5) for i in range(500)], IV)
    inspections = spark.createDataFrame(
        [(i % 5, f"P{i}", "05/01/2024") for i in range(20)],
        "PUNTO_MEDIDA_MDM bigint, PUNTO_SERVICIO string, FECHAI1 string",
    )
    curve = curves.iv_before_inspection(readings, inspections, max_rows=0)
    nodes = executed_nodes(curve)
    assert curve.count() == 20 * 8641
    assert 0 < metric(nodes, "Exchange", "shuffleRecordsWritten") < 20 * 8641 / 20


@pytest.mark.parametrize("job", ["curve", "points", "before"])
def test_presence_costs_no_second_read(spark, energy, tmp_path, job):
    many = energy
    for _ in range(4):
        many = many.unionByName(many)
    many.write.parquet(f"{tmp_path}/om")
    stored = read_readings(spark, f"{tmp_path}/om", "om")
    if job == "before":
        inspections = spark.createDataFrame(
            [(1, "A", "06/01/2024"), (3, "C", "06/01/2024")],
            "PUNTO_MEDIDA_INTERNO bigint, PUNTO_SERVICIO string, FECHAI1 string",
        )
        result = curves.energy_before_inspection(stored, inspections)
    else:
        chosen = None if job == "curve" else points(spark, (1, "A"))
        result = curves.energy_curves(stored, chosen, DAY, DAY + DAY_MS)
    assert metric(executed_nodes(result), "Scan parquet", "numOutputRows") <= many.count()


def test_presence_is_that_of_all_points(spark, energy):
    chosen = points(spark, (1, "A"))
    for max_rows in (0, 100):
        got = curves.energy_curves(energy, chosen, DAY, DAY + DAY_MS, max_rows=max_rows)
        assert {row[3] for row in rows(got)} == {None}  # only point 2 has magnitude 3


def test_extract_reads_its_readings_once(spark, base, tmp_path):
    """However many spans there are; few jobs run before the extract itself, and none over readings."""
    f = Fixtures(spark, base)
    f.iv_all_magnitudes.write.parquet(f"{tmp_path}/iv")
    f.om.write.parquet(f"{tmp_path}/om")
    iv, om = (read_readings(spark, f"{tmp_path}/{kind}", kind) for kind in ("iv", "om"))
    extract.indirect_extract(iv, om, f, registry.START, registry.STOP)  # opens the inventory's files
    for max_rows in (0, 200_000):
        spark.sparkContext.setJobGroup(f"extract-{max_rows}", "building")
        result = extract.indirect_extract(iv, om, f, registry.START, registry.STOP, max_rows=max_rows)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs_before = spark.sparkContext.statusTracker().getJobIdsForGroup(f"extract-{max_rows}")
        # the count of the spans before a broadcast is one action, but of a job per stage
        assert len(jobs_before) < (50 if max_rows else 15)
        nodes = executed_nodes(result)
        scans = [n for n in nodes if n.nodeName().startswith("Scan parquet") and str(tmp_path) in n.toString()]
        assert 0 < sum(n.metrics().apply("numOutputRows").value() for n in scans) <= iv.count() + om.count()


# sources, files, command line


def test_newest_version_of_a_cell_counts(spark):
    cells = [("k", "V", bytearray(b"\x09"), 1), ("k", "V", bytearray(b"\x01"), 2), ("k", "M", bytearray(b"\x05"), 1)]
    found = gather_cells(spark.createDataFrame(cells, "rowkey string, qualifier string, value binary, version bigint"), "iv")
    assert [(bytes(r["V"]), bytes(r["M"]), r["S"]) for r in found.collect()] == [(b"\x01", b"\x05", None)]


def test_legacy_inspections_differ(spark, base):
    counts = [registry.queries()[n](spark, base).count() for n in ("energy_before_inspection", "energy_before_inspection_legacy")]
    assert 0 < counts[0] < counts[1]


def test_window_restriction_equals_the_key_range(spark, base):
    f = Fixtures(spark, base)
    some = f["measuring_point"].filter("id % 2 = 0").select(F.col("id").alias("ID"))
    kept = points_window(f.iv, some, registry.START, registry.STOP)
    key = F.lpad(F.col("measuring_point").cast("string"), 8, "0")
    ranged = f.iv.filter("measuring_point % 2 = 0").filter(
        F.col("rowkey").between(
            F.concat(key, F.lit(f"{registry.START:014d}00000")),
            F.concat(key, F.lit(f"{registry.STOP:014d}99999")),
        )
    )
    assert rows(kept) == rows(ranged)


def test_jdbc_options():
    assert "partitionColumn" not in jdbc_options("jdbc:x", "t")
    options = jdbc_options("jdbc:x", "(SELECT 1)", column="ID", bounds=(0, 9), partitions=4, properties={"user": "u"})
    assert options["dbtable"] == "(SELECT 1)" and options["user"] == "u"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("0", "9", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", column="ID")


def test_schemas():
    assert len(OM) == 10 and len(IV) == 9 and len(EVENT) == 8 and len(CELLS) == 3


def test_stamps():
    now = datetime(2024, 1, 5, 1, 30, tzinfo=timezone.utc)
    assert run_stamp(now=now) == "202401050130"
    assert stamped("/out/", "America/Sao_Paulo", now) == "/out/202401042230"


def csv_lines(path):
    files = sorted(name for name in os.listdir(path) if name.endswith(".csv"))
    return [open(f"{path}/{name}").read().splitlines() for name in files]


def test_csv_sorted_files_append_and_overwrite(spark, tmp_path):
    df = spark.range(100).select((99 - F.col("id")).alias("n"), F.lit(None).cast("double").alias("v"))
    path = f"{tmp_path}/csv"
    write_csv(df, path, delimiter=";", num_files=1, sort_by=["n"])
    assert csv_lines(path) == [["n;v"] + [f"{i};" for i in range(100)]]
    write_csv(df, path, header=False, num_files=4, sort_by=["n"])
    assert sum(len(lines) for lines in csv_lines(path)) == 201
    write_csv(df, path, header=False, mode="overwrite", num_files=4, sort_by=["n"])
    numbers = [int(line.split(",")[0]) for lines in csv_lines(path) for line in lines]
    assert numbers == list(range(100))
    write_csv(df, path, header=False, mode="overwrite", sort_by=["n"])
    assert [int(line.split(",")[0]) for lines in csv_lines(path) for line in lines] == list(range(100))
    observed, count = counted(df)
    write_parquet(observed, f"{tmp_path}/parquet", num_files=2)
    assert count.get == {"rows": 100}
    assert rows(spark.read.parquet(f"{tmp_path}/parquet")) == rows(df)


@pytest.fixture(scope="module")
def stored(spark, base, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    f = Fixtures(spark, base)
    f.iv.write.parquet(f"{folder}/iv")
    f.om.write.parquet(f"{folder}/om")
    for name in INVENTORY_TABLES:
        f[name].coalesce(1).write.parquet(f"{folder}/inventory/{name}")
    return str(folder)


def run_job(spark, stored, name, *more, tables=("om",)):
    paths = [part for table in tables for part in (f"--{table}", f"{stored}/{table}")]
    jobs.main([name, *paths, "--inventory", f"{stored}/inventory", *more], spark)


def single_folder(path):
    (name,) = os.listdir(path)
    return f"{path}/{name}"


def test_tables_are_split_as_asked():
    found = jobs._splits(["measuring_point=id:1:900:8", "meter=punto_servicio:0:50:2"])
    assert found["measuring_point"] == {"column": "id", "bounds": (1, 900), "partitions": 8}
    assert found["meter"] == {"column": "punto_servicio", "bounds": (0, 50), "partitions": 2}


def test_jobs_write_what_the_queries_return(spark, base, stored, tmp_path, capsys):
    def expected(name):
        return registry.queries()[name](spark, base)

    window = ["--start", "202401050000", "--stop", "202401200000"]
    epoch = ["--start", str(registry.START), "--stop", str(registry.STOP)]
    run_job(spark, stored, "energy-curves", *window, "--group", registry.GROUP, "--out", f"{tmp_path}/e")
    lines = [line for part in csv_lines(single_folder(f"{tmp_path}/e")) for line in part]
    want = expected("grid_energy_curve").orderBy("measuring_point", "day").collect()
    assert lines == [",".join("" if v is None else str(v) for v in row) for row in want]

    Fixtures(spark, base).cells("om").write.parquet(f"{tmp_path}/cells")
    more = ["--cells", "--om", f"{tmp_path}/cells", "--inventory", f"{stored}/inventory", "--out", f"{tmp_path}/c"]
    jobs.main(["energy-curves", *window, "--group", registry.GROUP, *more], spark)
    assert [line for part in csv_lines(single_folder(f"{tmp_path}/c")) for line in part] == lines

    run_job(spark, stored, "iv-curves", *epoch, "--files", "2", "--out", f"{tmp_path}/i", tables=("iv",))
    got = spark.read.csv(f"{tmp_path}/i/triphasic", header=True)
    want = expected("grid_iv_curve_triphasic")
    assert rows(got) == rows(want.select(*[F.col(c).cast("string") for c in want.columns]))

    run_job(spark, stored, "iv-curves", *epoch, "--phases", "1", "--group", registry.GROUP, "--out", f"{tmp_path}/i", tables=("iv",))
    assert len(spark.read.csv(f"{tmp_path}/i/monophasic", header=True).columns) == 4

    run_job(spark, stored, "energy-before-inspection", "--files", "3", "--out", f"{tmp_path}/b")
    got = spark.read.csv(single_folder(f"{tmp_path}/b"), header=True, sep=";")
    assert got.count() == expected("energy_before_inspection").count()

    run_job(spark, stored, "iv-before-inspection", "--days", "2", "--out", f"{tmp_path}/p", tables=("iv",))
    got = spark.read.csv(f"{tmp_path}/p/triphasic", header=True)
    assert got.count() == expected("inspections_with_points").count() * 193

    more = ["--days", "1", "--phases", "1", "--format", "parquet"]
    capsys.readouterr()
    run_job(spark, stored, "iv-before-inspection", *more, "--files", "2", "--out", f"{tmp_path}/p", tables=("iv",))
    got = spark.read.parquet(f"{tmp_path}/p/monophasic")
    assert got.columns == ["measuring_point", "date", "voltage_phase_1", "current_phase_1"]
    assert got.count() == expected("inspections_with_points").count() * 97
    assert f"{got.count()} rows written" in capsys.readouterr().out

    run_job(spark, stored, "iv-curves", *epoch, "--snap", "--out", f"{tmp_path}/s", tables=("iv",))
    got = spark.read.csv(f"{tmp_path}/s/triphasic", header=True)
    assert got.count() == expected("grid_iv_curve_triphasic").count()

    run_job(
        spark, stored, "indirect-extract", *window, "--overwrite", "--delimiter", ",", "--out", f"{tmp_path}/x", tables=("iv", "om")
    )
    got = spark.read.csv(f"{tmp_path}/x", header=True)
    assert got.columns == list(extract.HEADINGS.values())
    inv = read_inventory(spark, f"{stored}/inventory")
    readings = [read_readings(spark, f"{stored}/{kind}", kind) for kind in ("iv", "om")]
    want = extract.indirect_extract(*readings, inv, registry.START, registry.STOP)
    assert got.count() == want.count()


def test_job_without_points_writes_nothing(spark, stored, tmp_path, capsys):
    window = ["--start", "202401050000", "--stop", "202401200000"]
    run_job(spark, stored, "energy-curves", *window, "--group", "NONE", "--out", f"{tmp_path}/none")
    assert "nothing is written" in capsys.readouterr().out
    assert not os.path.exists(f"{tmp_path}/none")
