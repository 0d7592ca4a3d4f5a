"""Reading and inventory frames derived from the test tables (see FIXTURES.md)."""

import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.functions.keys import iv_row_key, om_row_key
from meterloom.functions.timeslots import DAY_MS, STEP_MS, snap, whole
from meterloom.operators.spread import bounded_join
from meterloom.schemas import IV, OM, QUALIFIERS, SCHEMAS
from meterloom.sources.layout import save_bucketed

FIRST_DAY = "2024-01-01"

# Event types standing for magnitudes, dictionary names of the sources.
IV_CODES = {"view": 13, "click": 14, "signup": 15, "purchase": 16, "error": 17}
OM_CODES = {"view": 1, "click": 1, "signup": 3, "purchase": 3, "error": 2}


def _coded(codes):
    value = F.lit(None).cast("bigint")
    for name, code in codes.items():
        value = F.when(F.col("event_type") == name, F.lit(code).cast("bigint")).otherwise(value)
    return value


def _digits(number, width):
    return F.lpad(F.pmod(number, F.lit(10**width)).cast("string"), width, "0")


def _calendar_text(days):
    return F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), days.cast("int")), "dd/MM/yyyy")


def _visited(customers: DataFrame) -> DataFrame:
    """Inspection dates: one of every customer, and a later one, with an overlapping window, of a third."""
    last = F.when(F.col("c_custkey") % 3 == 0, F.lit(1)).otherwise(F.lit(0))
    visits = customers.withColumn("visit", F.explode(F.sequence(F.lit(0), last)))
    return visits.withColumn("fechai1", _calendar_text(F.col("c_custkey") % 30 + 45 * F.col("visit")))


def next_start(df: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    """Adds ``end_date``: the start of the key's next row in (time, tie) order, null for the last.

    Rows are ordered inside (key, month) groups; the next non-empty month is looked up in a
    table of first starts per month, so a busy key is not ordered in one task.
    """
    dated = df.withColumn("__month", F.trunc(time, "month"))
    inside = Window.partitionBy(key, "__month").orderBy(time, tie)
    months = dated.groupBy(key, "__month").agg(F.min(time).alias("__first"))
    across = Window.partitionBy(key).orderBy("__month")
    following = months.select(key, "__month", F.lead("__first").over(across).alias("__following"))
    return (
        dated.withColumn("__next", F.lead(time).over(inside))
        .join(following, [key, "__month"])
        .withColumn("end_date", F.coalesce("__next", "__following"))
        .drop("__month", "__next", "__following")
    )


@F.pandas_udf(T.BinaryType())
def _double_bytes(values):
    import pandas as pd

    return pd.Series(values.to_numpy(dtype=">f8").view("V8").tolist(), index=values.index)


def _cell(column, kind):
    if kind == T.StringType():
        return F.encode(column, "UTF-8")
    if kind == T.DoubleType():
        return _double_bytes(column)
    width = 8 if kind == T.IntegerType() else 16
    return F.unhex(F.lpad(F.hex(column), width, "0"))


class Fixtures:
    """Frames by attribute or, for inventory tables, by name as a mapping."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self._opened = {}

    def table(self, name: str) -> DataFrame:
        path = f"{self.base}/{name}.parquet"
        return self._once(path, lambda: self.spark.read.parquet(path))

    def _once(self, key, opener):
        if key not in self._opened:
            self._opened[key] = opener()
        return self._opened[key]

    # readings

    def _events(self) -> DataFrame:
        ms = F.unix_millis(F.col("ts").cast("timestamp"))
        fourth = F.when(F.col("event_id") % 4 == 0, F.lit(21)).otherwise(F.lit(41))
        return self.table("events").select(
            "event_id",
            "event_type",
            F.col("user_id").alias("measuring_point"),
            "value",
            F.col("props").alias("validation_result"),
            ms.alias("last_update_time"),
            fourth.cast("bigint").alias("source"),
        )

    def _iv(self, snapped=True) -> DataFrame:
        update = F.col("last_update_time")
        last = F.col("event_id") % 10
        interval = F.when(last == 0, F.lit(2)).when(last != 5, F.lit(1))  # some are unknown
        return (
            self._events()
            .withColumn("date", snap(update) if snapped else update)
            .withColumn("magnitude", _coded(IV_CODES))
            .withColumn("measurement_interval", interval.cast("bigint"))
            .withColumn(
                "rowkey",
                iv_row_key(F.col("measuring_point"), F.col("date"), _digits(F.col("event_id"), 5)),
            )
        )

    def _om(self) -> DataFrame:
        update = F.col("last_update_time")
        day = snap(update, DAY_MS)
        suffix = F.concat(F.col("magnitude").cast("string"), _digits(F.col("event_id"), 4))
        return (
            self._events()
            .withColumn("day", day)
            .withColumn("period", (whole(update - day, STEP_MS) + 1).cast("int"))
            .withColumn("magnitude", _coded(OM_CODES))
            .withColumn("measurement_interval", F.lit(1).cast("bigint"))
            .withColumn(
                "rowkey",
                om_row_key(
                    F.col("measuring_point"), F.col("measurement_interval"), F.col("day"), suffix
                ),
            )
        )

    @property
    def iv(self) -> DataFrame:
        return self._iv().select(*IV.names)

    @property
    def iv_offgrid(self) -> DataFrame:
        return self._iv(snapped=False).select(*IV.names)

    @property
    def iv_all_magnitudes(self) -> DataFrame:
        return self._iv().withColumn("magnitude", F.col("event_id") % 24 + 1).select(*IV.names)

    @property
    def om(self) -> DataFrame:
        return self._om().select(*OM.names)

    @property
    def om_missing(self) -> DataFrame:
        return self.om.filter(F.col("magnitude") != 3)

    @property
    def long_readings(self) -> DataFrame:
        """Readings over seven years, to meet the contract and equipment histories."""
        lines = self.table("lineitem")
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("rowkey"),
            F.col("o_custkey").alias("measuring_point"),
            F.col("l_shipdate").cast("timestamp").alias("date"),
            F.col("l_linenumber").cast("bigint").alias("magnitude"),
            F.col("l_quantity").alias("value"),
            F.when(F.col("l_returnflag") == "A", 41).otherwise(21).cast("bigint").alias("source"),
            F.when(F.col("l_linestatus") == "F", 1)
            .otherwise(2)
            .cast("bigint")
            .alias("measurement_interval"),
        )

    # encoded cells

    def _stored(self, kind: str) -> DataFrame:
        if kind == "event":
            rows = self._iv().select(
                "event_id",
                "rowkey",
                snap(F.col("last_update_time"), DAY_MS).alias("day"),
                F.col("event_type").alias("file"),
                F.col("validation_result").alias("information"),
                "last_update_time",
                "measuring_point",
                "source",
                F.col("magnitude").alias("event_type"),
            )
        else:
            rows = self._iv() if kind == "iv" else self._om()
        return rows.withColumn("rowkey", F.concat_ws(" ", "rowkey", "event_id"))

    def cells(self, kind: str) -> DataFrame:
        """(rowkey, qualifier, value); low readings, errors and high readings lack cells in IV."""
        lacking = {}
        if kind == "iv":
            lacking = {
                "value": F.col("value") < 25,
                "measurement_interval": F.col("event_type") == "error",
                "validation_result": F.col("value") > 480,
            }
        pairs = []
        for field in SCHEMAS[kind]:
            if field.name == "rowkey":
                continue
            cell = _cell(F.col(field.name), field.dataType)
            if field.name in lacking:
                cell = F.when(~lacking[field.name], cell)
            pairs.append(
                F.struct(
                    F.lit(QUALIFIERS[kind][field.name]).alias("qualifier"), cell.alias("value")
                )
            )
        return (
            self._stored(kind)
            .select("rowkey", F.explode(F.array(*pairs)).alias("cell"))
            .select("rowkey", "cell.qualifier", "cell.value")
            .filter(F.col("value").isNotNull())
        )

    # inventory

    def __getitem__(self, name: str) -> DataFrame:
        return self._once(name, getattr(self, f"_{name}"))

    def _measuring_point(self):
        return self.table("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("code"),
            F.col("c_custkey").alias("location_data"),
        )

    def _measuring_point_group(self):
        return (
            self.table("customer")
            .groupBy(F.col("c_mktsegment").alias("code"))
            .agg(F.min("c_custkey").alias("id"))
        )

    def _measuring_point_groupmpoint(self):
        groups = self._measuring_point_group()
        members = self.table("customer").select(
            F.col("c_custkey").alias("measuring_point"), F.col("c_mktsegment").alias("code")
        )
        return bounded_join(members, groups, ["code"]).select(
            "measuring_point", F.col("id").alias("measuring_point_group")
        )

    def _measuring_point_technical_data(self):
        return self.table("customer").select(
            F.col("c_custkey").alias("measuring_point"),
            (F.col("c_custkey") % 2).alias("phase_type"),
            (F.col("c_nationkey") % 5).alias("voltage_level"),
        )

    def _voltage_level(self):
        return self.table("region").select(
            F.col("r_regionkey").alias("id"), F.col("r_name").alias("code")
        )

    def _measuring_point_location_data(self):
        return self.table("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("owner")
        )

    def _owner(self):
        nations, regions = self.table("nation"), self.table("region")
        return nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"]).select(
            F.col("n_nationkey").alias("id"),
            F.col("n_name").alias("code"),
            F.col("r_name").alias("management"),
        )

    def _dated_orders(self):
        return self._once("dated orders", self._order_spans)

    def _order_spans(self):
        orders = self.table("orders").withColumn("start_date", F.col("o_orderdate").cast("timestamp"))
        return next_start(orders, "o_custkey", "start_date", "o_orderkey")

    def _measuring_point_commercial(self):
        return self._dated_orders().select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("measuring_point"),
            "start_date",
            "end_date",
        )

    def _measuring_point_billing_data(self):
        start = F.col("o_orderdate").cast("timestamp")
        tariffs = self._tariff_structure().select(
            F.col("code").alias("o_orderpriority"), F.col("id").alias("tariff_structure")
        )
        return bounded_join(self.table("orders"), tariffs, ["o_orderpriority"]).select(
            F.col("o_orderkey").alias("commercial_data"),
            "tariff_structure",
            start.alias("tariff_structure_start_date"),
            F.when(F.col("o_orderstatus") != "O", start + F.expr("interval 90 days")).alias(
                "tariff_structure_end_date"
            ),
        )

    def _tariff_structure(self):
        return (
            self.table("orders")
            .groupBy(F.col("o_orderpriority").alias("code"))
            .agg(F.min("o_orderkey").alias("id"))
        )

    def _equipment_point_configuration(self):
        lines = self.table("lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("equipment"))
        orders = self._dated_orders()
        return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left").select(
            F.col("o_custkey").alias("measuring_point"),
            "equipment",
            (F.col("o_orderkey") % 3 + 1).alias("reading_constant"),
            "start_date",
            "end_date",
        )

    def _equipment(self):
        return self.table("part").select(
            F.col("p_partkey").alias("id"), F.col("p_brand").alias("code")
        )

    def _source(self):
        codes = self._events().select(F.col("source").alias("id")).distinct()
        name = F.when(F.col("id") == 21, "manual").when(F.col("id") == 41, "remote")
        return codes.withColumn("name", name)

    def _numbered(self, count, text):
        ids = self.table("nation").filter(F.col("n_nationkey") < count)
        ids = ids.select((F.col("n_nationkey") + 1).cast("bigint").alias("id"))
        return ids.withColumn("description", F.concat(F.lit(text), F.col("id").cast("string")))

    def _magnitude(self):
        return self._numbered(6, "energy ")

    def _instantaneous_value_magnitude(self):
        return self._numbered(24, "instantaneous ")

    def repeated_dictionaries(self):
        """Dictionaries that grow with the tables; each repeats its codes, and both share some."""
        parts = self.table("part").select((F.col("p_partkey") % 5000).alias("id"))
        lines = self.table("lineitem").select((F.col("l_partkey") * 2).alias("id"))
        described = F.concat(F.lit("code "), F.col("id").cast("string")).alias("description")
        codes = {"magnitude": parts, "instantaneous_value_magnitude": lines}
        return {name: ids.select(F.col("id").cast("bigint"), described) for name, ids in codes.items()}

    def bucketed(self, kind):
        """A reading table in buckets by point and folders by day, saved in the warehouse once a session."""
        name = f"meterloom_{kind}_{zlib.crc32(self.base.encode()):08x}"
        if not self.spark.catalog.tableExists(name):
            unique = f"{name}_{uuid.uuid4().hex}"
            folder = f"{self.spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{unique}"
            save_bucketed(getattr(self, kind), name, kind, 8, path=folder, by_day=True)
        return self.spark.table(name)

    def _plate(self):
        prefix = F.when(F.col("c_custkey") % 3 == 0, "070").otherwise("080")
        return F.concat(prefix, F.col("c_custkey").cast("string"))

    def _service_point(self):
        return self.table("customer").select(
            F.col("c_name").alias("punto_servicio"),
            self._plate().alias("numero_placa"),
            F.when(F.col("c_custkey") % 2 == 1, "TRIFASICO ").otherwise("MONOFASICO").alias("fases"),
        )

    def _meter(self):
        installed = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("c_custkey") % 20).cast("int"))
        return self.table("customer").select(
            self._plate().alias("numero_placa"),
            F.when(F.col("c_custkey") % 11 != 0, installed).alias("fecha_desde"),
        )

    def _inspected_batch(self):
        return _visited(self.table("customer")).select(
            F.col("c_custkey").alias("punto_medida_interno"),
            F.col("c_name").alias("punto_servicio"),
            "fechai1",
        )

    def _inspected_list(self):
        """Points that sent an error event are inspected."""
        errors = self.table("events").filter(F.col("event_type") == "error")
        failing = errors.select("user_id").distinct()
        customers = self.table("customer")
        chosen = customers.join(failing, F.col("c_custkey") == F.col("user_id"), "left_semi")
        return _visited(chosen).select(F.col("c_name").alias("punto_servicio"), "fechai1")

    def _inspection_history(self):
        k = F.col("k")
        return (
            self.table("customer")
            .withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(3)])))
            .select(
                F.col("c_name").alias("id"),
                _calendar_text(F.when(k == 0, 31).otherwise(32)).alias("fecha"),
                _calendar_text(F.col("c_custkey") % 30 + k).alias("fechai1"),
                F.date_add(F.lit("2024-02-01").cast("date"), k).cast("timestamp").alias("commit_dttm"),
            )
        )
