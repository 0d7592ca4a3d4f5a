"""Command line of the extracts: read tables, build a plan, write files.

    python -m meterloom.jobs energy-curves --om /data/om \
        --inventory /data/inventory --group BUILDING --start 202401050000 --stop 202401200000 \
        --out /data/extracts
"""

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.timeslots import argument_ms, snap
from meterloom.operators.restrict import unreadable_dates
from meterloom.plans import curves, extract, inventory
from meterloom.sinks.files import stamped, write_csv, write_parquet
from meterloom.sources.cells import read_cells
from meterloom.sources.tables import read_inventory, read_jdbc_inventory, read_readings


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="meterloom", description=__doc__.split("\n")[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name, *tables, window=None, points=False):
        sub = jobs.add_parser(name)
        for table in tables:
            sub.add_argument(f"--{table}", required=True, help=f"path of the {table} reading table")
        sub.add_argument("--cells", action="store_true", help="reading tables hold binary cells")
        sub.add_argument("--missing", choices=("null", "sentinel"), default="null", help="absent cells")
        sub.add_argument("--inventory", required=True, help="folder of tables, or a jdbc: URL")
        sub.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
        sub.add_argument(
            "--jdbc-split",
            action="append",
            default=[],
            metavar="TABLE=COLUMN:LOW:HIGH:N",
            help="read a table in N parts, by a numeric column between two bounds",
        )
        sub.add_argument("--out", required=True, help="output folder")
        sub.add_argument("--format", choices=("csv", "parquet"), default="csv")
        sub.add_argument("--tz", default="UTC", help="zone of arguments, days and written times")
        sub.add_argument("--files", type=int, help="number of output files")
        sub.add_argument(
            "--run", metavar="NAME", help="write to run=NAME and replace what a run of that name wrote"
        )
        if window:
            sub.add_argument("--start", required=True, help=window)
            sub.add_argument("--stop", required=True, help=window)
        if points:
            sub.add_argument("--group", help="group of points")
        return sub

    iv = job("iv-curves", "iv", window="epoch ms", points=True)
    iv.add_argument("--phases", type=int, choices=(1, 3), default=3)
    iv.add_argument("--snap", action="store_true", help="floor times to the quarter hour")
    rejects = {"metavar": "PATH", "help": "write inspections without a readable date there"}
    before = job("iv-before-inspection", "iv")
    before.add_argument("--rejects", **rejects)
    before.add_argument("--days", type=int, default=90)
    before.add_argument("--phases", type=int, choices=(1, 3), default=3)
    energy = job("energy-curves", "om", window="yyyyMMddHHmm", points=True)
    energy.add_argument("--gaps", choices=("null", "text"), default="null")
    energy.add_argument("--overwrite", action="store_true")
    inspected = job("energy-before-inspection", "om")
    inspected.add_argument("--rejects", **rejects)
    inspected.add_argument("--batch", type=int, help="inspection batch; all when absent")
    inspected.add_argument("--batch-size", type=int, default=inventory.BATCH_SIZE)
    inspected.add_argument("--days", type=int, default=90)
    inspected.add_argument("--legacy", action="store_true", help="join inspections on point only")
    inspected.add_argument("--rollover", action="store_true", help="period 96 is the next day")
    indirect = job("indirect-extract", "iv", "om", window="yyyyMMddHHmm")
    indirect.add_argument("--legacy-labels", action="store_true")
    indirect.add_argument("--rollover", action="store_true", help="period 96 is the next day")
    indirect.add_argument("--delimiter", default=";")
    indirect.add_argument("--overwrite", action="store_true")
    return parser


def _splits(texts: list[str]) -> dict[str, dict]:
    """Split settings of inventory tables, each from ``table=column:low:high:n``."""
    found = {}
    for text in texts:
        table, _, rest = text.partition("=")
        column, low, high, parts = rest.split(":")
        found[table] = {"column": column, "bounds": (int(low), int(high)), "partitions": int(parts)}
    return found


def _write(rows: DataFrame, path: str, args, header=True, delimiter=",", **settings) -> None:
    settings |= {"num_files": args.files, "run": args.run}
    if args.format == "parquet":
        written = write_parquet(rows, path, **settings)
    else:
        written = write_csv(rows, path, header, delimiter, **settings)
    print(f"{written} rows written to {path}")


def _stamped(args) -> str:
    """The run's folder; a named run has a folder of its own anyway."""
    return args.out if args.run else stamped(args.out, args.tz)


def _report_rejects(inspections: DataFrame, unreadable: Observation, args) -> None:
    """Say how many inspections had no readable date, and write them where asked."""
    count = unreadable.get["unreadable"]
    if count:
        print(f"{count} inspections without a readable date are left out")
    if args.rejects:
        write_csv(unreadable_dates(inspections), args.rejects, mode="overwrite", num_files=1)


def _inventory(spark: SparkSession, args):
    if args.inventory.startswith("jdbc:"):
        properties = dict(option.split("=", 1) for option in args.jdbc_option)
        return read_jdbc_inventory(
            spark, args.inventory, _splits(args.jdbc_split), properties=properties
        )
    return read_inventory(spark, args.inventory)


def _readings(spark: SparkSession, args, kind: str) -> DataFrame:
    path = getattr(args, kind)
    if args.cells:
        return read_cells(spark, path, kind, args.missing)
    return read_readings(spark, path, kind)


def _nothing_to_do(points: DataFrame | None) -> bool:
    if points is not None and points.isEmpty():
        print("no points selected, nothing is written")
        return True
    return False


def _iv_curves(spark, inv, args):
    if args.group:
        phase = 0 if args.phases == 1 else 1
        points = inventory.points_by_group_and_phase(inv, args.group, phase)
    else:
        points = inventory.points_by_plate(inv)
    if _nothing_to_do(points):
        return
    readings = _readings(spark, args, "iv")
    if args.snap:
        readings = readings.withColumn("date", snap(F.col("date")))
    curve = curves.iv_curves(readings, points, int(args.start), int(args.stop), args.phases)
    folder = "triphasic" if args.phases == 3 else "monophasic"
    _write(
        curve,
        f"{args.out.rstrip('/')}/{folder}",
        args,
        sort_by=["measuring_point", "date"],
    )


def _iv_before_inspection(spark, inv, args):
    inspections = inventory.inspections_with_points(inv)
    if _nothing_to_do(inspections):
        return
    unreadable = Observation()
    curve = curves.iv_before_inspection(
        _readings(spark, args, "iv"), inspections, args.days, args.phases, unreadable=unreadable
    )
    folder = "triphasic" if args.phases == 3 else "monophasic"
    _write(
        curve,
        f"{args.out.rstrip('/')}/{folder}",
        args,
        sort_by=["measuring_point", "date"],
    )
    _report_rejects(inspections, unreadable, args)


def _energy_curves(spark, inv, args):
    points = inventory.points_by_group(inv, args.group) if args.group else None
    if _nothing_to_do(points):
        return
    curve = curves.energy_curves(
        _readings(spark, args, "om"),
        points,
        argument_ms(args.start, args.tz),
        argument_ms(args.stop, args.tz),
        gaps=args.gaps,
        absent=None if args.gaps == "text" else -1.0,
        tz=args.tz,
    )
    _write(
        curve,
        _stamped(args),
        args,
        header=False,
        mode="overwrite" if args.overwrite else "append",
        sort_by=["measuring_point", "day"],
    )


def _energy_before_inspection(spark, inv, args):
    inspections = inventory.inspected_points(inv, args.batch, args.batch_size)
    if _nothing_to_do(inspections):
        return
    unreadable = Observation()
    energy = curves.energy_before_inspection(
        _readings(spark, args, "om"),
        inspections,
        args.days,
        args.legacy,
        args.rollover,
        unreadable=unreadable,
    )
    _write(energy, _stamped(args), args, delimiter=";")
    _report_rejects(inspections, unreadable, args)


def _indirect_extract(spark, inv, args):
    if _nothing_to_do(inventory.indirect_points(inv)):
        return
    rows = extract.indirect_extract(
        _readings(spark, args, "iv"),
        _readings(spark, args, "om"),
        inv,
        argument_ms(args.start, args.tz),
        argument_ms(args.stop, args.tz),
        args.legacy_labels,
        args.rollover,
    )
    path = args.out if args.overwrite else _stamped(args)
    _write(
        rows,
        path,
        args,
        delimiter=args.delimiter,
        mode="overwrite" if args.overwrite else "append",
    )


_JOBS = {
    "iv-curves": _iv_curves,
    "iv-before-inspection": _iv_before_inspection,
    "energy-curves": _energy_curves,
    "energy-before-inspection": _energy_before_inspection,
    "indirect-extract": _indirect_extract,
}


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"meterloom {args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", args.tz)
    _JOBS[args.job](spark, _inventory(spark, args), args)


if __name__ == "__main__":
    main()
