"""Table schemas, readers, uniqueness checks and mart writers.

Instants are TIMESTAMP in a UTC session; flags and codes stay text so leading zeros survive.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parceltrail.operators.lookup import Dimension, Labels
from parceltrail.session import prepare, require_utc


def _schema(text: str) -> T.StructType:
    """From "type: column column ..." lines."""
    kinds = {
        "str": T.StringType(),
        "ts": T.TimestampType(),
        "long": T.LongType(),
        "dec": T.DecimalType(38, 9),
    }
    fields = []
    for line in text.strip().splitlines():
        kind, columns = line.split(":")
        fields += [T.StructField(c, kinds[kind.strip()]) for c in columns.split()]
    return T.StructType(fields)


_PLACES = """
str: sender_name sender_cellphone sender_province_name sender_city_name sender_district_name
str: recipient_name recipient_address recipient_cellphone
str: recipient_province_name recipient_city_name recipient_district_name
"""

_WAYBILL = (
    """
str: waybill_no order_no ecommerce_order_no waybill_source waybill_status void_flag return_flag deleted
str: service_type express_type payment_type relationship_type parent_shipping_cleint vip_customer_name
long: vip_customer_id
ts: shipping_time update_time pod_record_time return_pod_record_time
long: pickup_branch_id pickup_courier_id
str: pickup_branch_name pickup_courier_name pod_branch_name pod_photo_url pod_courier_name signer
long: sender_city_id recipient_district_id
str: item_value item_name
dec: standard_shipping_fee total_shipping_fee insurance_amount handling_fee receivable_shipping_fee other_fee
dec: cod_amount item_weight item_actual_weight item_calculated_weight
"""
    + _PLACES.strip()
)

SCHEMAS: dict[str, T.StructType] = {
    "order_order": _schema(
        """
str: waybill_no order_no ecommerce_order_no order_source order_status payment_type express_type service_type
str: parent_shipping_cleint vip_customer_name
ts: input_time update_time start_pickup_time end_pickup_time pickup_failure_time pickup_time
str: scheduling_target_branch_name pickup_branch_name pickup_failure_problem_code
long: pickup_courier_id
str: pickup_courier_name
dec: standard_shipping_fee total_shipping_fee insurance_amount handling_fee other_fee
dec: item_weight item_actual_weight item_calculated_weight item_value
str: item_name
"""
        + _PLACES.strip()
    ),
    "waybill_waybill": _schema(_WAYBILL),
    "dm_waybill_waybill": _schema(_WAYBILL + "\nlong: pod_courier_id pod_branch_id\nstr: delivery_branch_name"),
    "waybill_waybill_line": _schema(
        """
str: waybill_no
ts: record_time
str: operation_type operation_branch_name problem_code problem_type photo_url bag_no vehicle_tag_no
"""
    ),
    "waybill_problem_piece": _schema("str: waybill_no\nts: operation_time\nstr: problem_reason problem_type"),
    "waybill_return_bill": _schema(
        """
str: waybill_no return_waybill_no
ts: update_time return_record_time return_confirm_record_time return_pod_record_time
str: return_confirm_status
long: return_type_id
str: return_branch_name
dec: return_shipping_fee
str: return_pod_photo_url recipient_city_name recipient_province_name deleted
"""
    ),
    "system_option": _schema("str: type_option option_value option_name"),
    "mapping_kanwil_area": _schema("str: province_name kanwil_name"),
    "masterdata_city_mapping_area_island_new": _schema("str: city province pulau"),
    "masterdata_sla_shopee": _schema("str: origin_city destination_city sla"),
    "masterdata_sales_source": _schema("str: source division sales_name"),
    "masterdata_sales_seller_vip": _schema("str: seller_name division sales_name"),
    "res_problem_package": _schema("str: code register_reason_bahasa deleted"),
    "return_type": _schema("long: id\nstr: return_type\nlong: deleted"),
    "res_user": _schema("long: id\nstr: personnel_no enabled deleted"),
    "res_branch": _schema("long: id\nstr: branch_no branch_level\nlong: city_id"),
    "res_area": _schema("long: city_id\nstr: province_name"),
    "standard_shipping_fee": _schema(
        """
str: search_code
long: sender_location_id recipient_location_id
str: express_type
long: shipping_client_id
dec: discount_rate
long: min_sla max_sla
ts: end_expire_time
str: deleted
ts: created_at
"""
    ),
    "mitra_late_reason_delivery": _schema("str: waybill_no late_delivery_reason"),
    "masterdata_branch_coverage_th": _schema("long: district_id\nstr: branch_name"),
    "a_mh_facility_name_rnd": _schema("str: mh_code mh_name"),
    "smu_template_2": _schema(
        """
str: report_date origin destination_by_bagging destination_by_issued
long: no_of_packages
dec: smu_weight
str: bm_code vm_code area_pulau smu_booking_code
dec: total_smu_fee
str: flight_no airlanes vendor
"""
    ),
}

# Keys that must be unique for lookups to keep the row count: table -> (key columns, row filter).
UNIQUE_KEYS: dict[str, tuple[tuple[str, ...], str]] = {
    "system_option": (("type_option", "option_value"), "true"),
    "mapping_kanwil_area": (("province_name",), "true"),
    "masterdata_city_mapping_area_island_new": (("city", "province"), "true"),
    "masterdata_sla_shopee": (("origin_city", "destination_city"), "true"),
    "masterdata_sales_source": (("source",), "true"),
    "masterdata_sales_seller_vip": (("seller_name",), "true"),
    "res_problem_package": (("code",), "deleted = '0'"),
    "return_type": (("id",), "true"),
    "res_user": (("id",), "deleted = '0'"),
    "res_branch": (("id",), "true"),
    "masterdata_branch_coverage_th": (("district_id",), "true"),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], name: str = "table") -> None:
    """Raise when a key repeats. Runs a job; meant for dimensions, before a report."""
    found = duplicate_keys(df, keys).take(1)
    if found:
        raise ValueError(f"{name}: key {tuple(keys)} is not unique, for example {found[0].asDict()}")


def utc_date_column(time: str) -> str:
    """Name of the partition column that holds the UTC date of a time column."""
    return f"{time}_utc_date"


class Tables:
    """The input tables of a report, by name. A table that is given as a function is read when first asked for."""

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self._frames = dict(frames)
        self._dimensions: dict[str, Dimension] = {}
        self._labels: Labels | None = None
        for df in self._frames.values():
            if isinstance(df, DataFrame):
                require_utc(df.sparkSession)
                break

    @classmethod
    def from_parquet(
        cls,
        spark: SparkSession,
        root: str,
        names: Sequence[str] | None = None,
        paths: Mapping[str, str] | None = None,
        dated: Mapping[str, str] | None = None,
    ) -> Tables:
        """Parquet folders `<root>/<name>` (or `paths[name]`), read with the declared schemas.

        `dated` maps a table to the time column whose UTC date it is partitioned by (folders
        `<time>_utc_date=2024-01-31`); look-backs on that time then read only the partitions they need.
        """
        require_utc(spark)
        paths, dated = paths or {}, dated or {}

        def reader(name: str) -> Callable[[], DataFrame]:
            days = [T.StructField(utc_date_column(dated[name]), T.DateType())] if name in dated else []
            schema = T.StructType([*SCHEMAS[name].fields, *days])
            return lambda: spark.read.schema(schema).parquet(paths.get(name, f"{root}/{name}"))

        return cls({name: reader(name) for name in names or SCHEMAS})

    @classmethod
    def from_catalog(cls, spark: SparkSession, table_map: Mapping[str, str]) -> Tables:
        """Catalog tables: logical name -> table name of one, two or three parts."""
        require_utc(spark)
        read = lambda name, table: lambda: conform(spark.table(table), SCHEMAS[name])
        return cls({name: read(name, table) for name, table in table_map.items()})

    def __getitem__(self, name: str) -> DataFrame:
        found = self._frames[name]
        if not isinstance(found, DataFrame):
            found = self._frames[name] = found()
        return found

    def sources(self) -> list[tuple[str, DataFrame | Callable[[], DataFrame]]]:
        """Names with their tables, or the functions that read them."""
        return list(self._frames.items())

    def with_table(self, name: str, df: DataFrame | Callable[[], DataFrame]) -> Tables:
        """These tables with another one; what is known about the others' keys and labels stays known."""
        other = Tables({**self._frames, name: df})
        other._dimensions = {n: dim for n, dim in self._dimensions.items() if n != name}
        other._labels = None if name == "system_option" else self._labels
        return other

    @property
    def labels(self) -> Labels:
        """The labels of coded columns, read when first asked for."""
        if self._labels is None:
            self._labels = Labels.read(self["system_option"])
        return self._labels

    def dimension(self, name: str) -> Dimension:
        """A dimension of UNIQUE_KEYS; whether its key repeats is looked up once, for all lookups of all reports."""
        if name not in self._dimensions:
            keys, rows = UNIQUE_KEYS[name]
            self._dimensions[name] = Dimension.counted(self[name].where(rows), keys)
        return self._dimensions[name]

    def check_unique(self, *names: str) -> None:
        """Raise when a dimension repeats a key that lookups rely on; all loaded dimensions by default."""
        for name in names or [n for n in UNIQUE_KEYS if n in self._frames]:
            keys, rows = UNIQUE_KEYS[name]
            assert_unique(self[name].where(rows), keys, name)
            self._dimensions[name] = Dimension(self[name].where(rows), keys, True)


def write_mart(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str] = (),
    table: bool = False,
    only_partitions: bool = False,
) -> None:
    """Replace a mart: a Parquet folder, or a catalog table.

    A report is a snapshot of its look-back, so the whole mart is replaced by default; `only_partitions` keeps the
    partitions that `df` has no rows for. The rebalance hint keeps files of even size and splits a partition value
    that holds most rows.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    mode = "dynamic" if only_partitions else "static"
    spark = df.sparkSession
    if table and only_partitions and spark.catalog.tableExists(target):
        # insertInto takes the mode from its session: a session of its own leaves other writers' setting alone.
        own = prepare(spark.newSession())
        own.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        view = f"mart_{uuid.uuid4().hex}"
        df.select(*spark.table(target).columns).createGlobalTempView(view)
        try:
            own.table(f"global_temp.{view}").write.insertInto(target, overwrite=True)
        finally:
            spark.catalog.dropGlobalTempView(view)
        return
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table:
        writer.saveAsTable(target)  # would keep a write option as a property of the table
    else:
        writer.option("partitionOverwriteMode", mode).save(target)


def read_mart(spark: SparkSession, source: str, table: bool = False) -> DataFrame:
    return spark.table(source) if table else spark.read.parquet(source)
