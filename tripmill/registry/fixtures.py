"""Trips, zones, vendors and ledgers derived from the test tables.

Everything here is computed by Spark from whole tables, so the work of a
registered query grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.align import align
from tripmill.operators.enrich import checked_lookup
from tripmill.operators.staging import stage_trips, stage_vendors, stage_zones
from tripmill.schemas import LINEAGE_COLUMNS, TRIP_COLUMNS
from tripmill.session import scratch_path

_kept: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept_path(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """Path of data written once per session; ``write(path)`` makes it."""
    at = (spark.conf.get("spark.app.id", "app"), sf_dir, label)
    if at not in _kept:
        path = scratch_path(spark, label)
        write(path)
        _kept[at] = path
    return _kept[at]


def source_trips(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """One trip per lineitem, as a source that lacks the optional columns.

    Orders meet their customers first, so that the lines are shuffled once. ``together``
    brings the trips of a cab type and month into the same tasks, by one more shuffle of
    the lines before the trips' columns are derived from them.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = (
        lines.join(
            orders.join(customers, F.col("o_custkey") == F.col("c_custkey")),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    cab_type = "CASE l_returnflag WHEN 'A' THEN 'yellow' WHEN 'N' THEN 'green' ELSE 'fhv' END"
    pickup = "o_orderdate + INTERVAL '1' MINUTE * (l_orderkey % 1440)"
    if together:
        placed = joined.withColumns({"_cab": F.expr(cab_type), "_month": F.trunc(F.expr(pickup), "MM")})
        joined = placed.hint("rebalance", F.col("_cab"), F.col("_month"))
    return joined.selectExpr(
        "CAST(l_suppkey % 2 + 1 AS INT) AS vendorid",
        f"{cab_type} AS cab_type",
        f"{pickup} AS pickup_datetime",
        "o_orderdate + INTERVAL '1' SECOND"
        " * ((l_orderkey % 1440 + l_partkey % 97 - 2) * 60 + l_suppkey % 60)"
        " AS dropoff_datetime",
        "IF(l_linestatus = 'O', ' N ', 'Y') AS store_and_fwd_flag",
        "CAST(l_linenumber % 6 + 1 AS BIGINT) AS ratecodeid",
        "c_nationkey * 6 AS pulocationid",
        "s_nationkey * 6 AS dolocationid",
        "IF(l_linenumber = 5 AND l_linestatus = 'F', NULL, CAST(l_linenumber AS BIGINT))"
        " AS passenger_count",
        "l_quantity - 1 AS trip_distance",
        "l_extendedprice - 2000 AS fare_amount",
        "0.5D AS extra",
        "0.5D AS mta_tax",
        "l_extendedprice * abs(l_discount) AS tip_amount",
        "0.0D AS tolls_amount",
        "0.3D AS improvement_surcharge",
        "l_extendedprice * (1 + abs(l_tax)) - 1000 AS total_amount",
        "l_partkey % 4 + 1 AS payment_type",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' + INTERVAL '1' DAY * (l_partkey % 3)"
        " AS ingestion_ts",
        "concat('batch_', CAST(l_partkey % 3 AS STRING)) AS batch_id",
        "'lineitem' AS source_file",
        "'first_load' AS migration_batch_id",
        "'spark' AS engine_type",
    )


def lake_trips(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """The trips with all 27 lake columns."""
    return align(source_trips(spark, sf_dir, together), spec=TRIP_COLUMNS + LINEAGE_COLUMNS)


def staged_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_trips(lake_trips(spark, sf_dir))


def source_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "n_nationkey * 6 AS locationid",
        "concat(' ', r_name) AS borough",
        "n_name AS zone",
        "CASE n_nationkey % 3 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone' ELSE 'Airports' END"
        " AS service_zone",
    )


def staged_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_zones(source_zones(spark, sf_dir))


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_lookup(staged_zones(spark, sf_dir), "location_id")


def zones_with_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones of which one is missing, so that some trips match nothing."""
    return staged_zones(spark, sf_dir).where("location_id <> 132")


def source_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in the role of vendors."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "CAST(s_suppkey AS INT) AS vendor_id",
        "concat(' ', s_name, ' ') AS vendor_name",
        "CASE s_suppkey % 3 WHEN 0 THEN 'Active ' WHEN 1 THEN 'suspended' ELSE 'inactive' END"
        " AS status",
    )


def changed_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later vendor list: some statuses changed, some vendors gone, some new."""
    vendors = stage_vendors(source_vendors(spark, sf_dir))
    changed = vendors.selectExpr(
        "vendor_id",
        "vendor_name",
        "IF(vendor_id % 10 = 0, 'closed', status) AS status",
    ).where("vendor_id % 7 <> 3")
    new = vendors.where("vendor_id % 9 = 0").selectExpr(
        "vendor_id + 10000000 AS vendor_id", "vendor_name", "'active' AS status"
    )
    return changed.unionByName(new)


def vendor_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation of a vendor per lineitem, in three batches that follow no order of time."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "CAST(l_suppkey AS INT) AS vendor_id",
        "concat('vendor ', CAST(l_suppkey AS STRING)) AS vendor_name",
        "CASE l_returnflag WHEN 'A' THEN 'active' WHEN 'R' THEN 'suspended' END AS status",
        "o_orderdate + INTERVAL '1' MINUTE * (l_orderkey % 1440) AS changed_at",
        "CAST(l_partkey % 3 AS INT) AS batch",
    )


def trip_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cab types and days that have trips."""
    trips = lake_trips(spark, sf_dir)
    return trips.select("cab_type", F.to_date("pickup_datetime").alias("day")).distinct()


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third trip day landed (after a failed attempt), every third failed."""
    days = trip_days(spark, sf_dir).selectExpr(
        "concat_ws('#', cab_type, date_format(day, 'yyyy_MM_dd')) AS slice_id",
        "dayofyear(day) % 3 AS kind",
    )
    failed = days.where("kind <= 1").selectExpr(
        "slice_id",
        "'batch_a' AS batch_id",
        "'FAILED' AS status",
        "'spark' AS engine",
        "TIMESTAMP_NTZ '2024-02-01 00:00:00' AS landed_at",
    )
    landed = days.where("kind = 0").selectExpr(
        "slice_id",
        "'batch_b' AS batch_id",
        "'LANDED' AS status",
        "'spark' AS engine",
        "TIMESTAMP_NTZ '2024-02-02 00:00:00' AS landed_at",
    )
    return failed.unionByName(landed)


def year_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-year requests for every cab type and year with trips."""
    years = trip_days(spark, sf_dir).selectExpr(
        "cab_type", "CAST(year(day) AS STRING) AS year"
    )
    return years.distinct().selectExpr(
        "cab_type", "year", "CAST(NULL AS STRING) AS month", "CAST(NULL AS STRING) AS day"
    )


def january_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for the first month of every year, with a padded month number."""
    return year_requests(spark, sf_dir).withColumn("month", F.lit("01"))
