from __future__ import annotations

from datetime import datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from tripmill.operators.align import Lineage, align, count_cast_failures
from tripmill.operators.staging import stage_trips, stage_vendors, stage_zones
from tripmill.schemas import LAKE_TRIPS, LINEAGE_COLUMNS, TRIP_COLUMNS, VENDORS
from tripmill.sources import read_seed

LINEAGE = Lineage("b", "slice/", "m", "SPARK", datetime(2024, 3, 1))
OPTIONAL = ["ehail_fee", "trip_type", "congestion_surcharge", "airport_fee"]
ARRIVAL = [c.name for c in LINEAGE_COLUMNS]


def test_alignment_gives_the_27_lake_columns_in_order(lake):
    source = lake({}).drop(*OPTIONAL, *ARRIVAL)
    aligned = align(source, LINEAGE)
    assert aligned.schema.simpleString() == LAKE_TRIPS.simpleString()
    assert len(aligned.columns) == 27
    row = aligned.first()
    assert [row[c] for c in OPTIONAL] == [None] * 4
    assert row["ingestion_ts"] == datetime(2024, 3, 1)


def test_a_missing_required_column_is_an_error(lake):
    with pytest.raises(ValueError, match="total_amount"):
        align(lake({}).drop("total_amount"), LINEAGE)


def test_cab_type_literal_overrides_the_source(lake):
    assert align(lake({}), cab_type="green").first()["cab_type"] == "green"


def test_lenient_alignment_loses_only_what_it_counts(lake):
    source = lake({}, {}).withColumn("ratecodeid", F.lit("n/a"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        align(source).collect()
    assert values(align(source, lenient=True), "ratecodeid") == [None, None]
    lost = count_cast_failures(source).first()
    assert (lost["ratecodeid"], lost["vendorid"]) == (2, 0)


def test_source_file_can_be_the_file_of_the_row(lake, tmp_path):
    path = str(tmp_path / "t")
    lake({}).drop("source_file").write.parquet(path)
    lineage = Lineage("b", F.col("_metadata.file_path"), "m", "SPARK")
    read = lake({}).sparkSession.read.parquet(path)
    assert align(read, lineage).first()["source_file"].endswith(".parquet")


def test_staging_renames_casts_and_cleans(lake):
    row = stage_trips(lake({"cab_type": " Yellow ", "store_and_fwd_flag": " N "})).first()
    assert row["cab_type"] == "yellow"
    assert row["store_and_fwd_flag"] == "n"
    assert row["pickup_location_id"] == 10
    staged = stage_trips(lake({}))
    assert len(staged.columns) == 27
    assert dict(staged.dtypes)["passenger_count"] == "int"


def test_zone_and_vendor_staging(spark):
    zones = spark.createDataFrame(
        [("7", " Queens", "Astoria ", "Boro Zone")],
        "locationid string, borough string, zone string, service_zone string",
    )
    assert tuple(stage_zones(zones).first()) == (7, "queens", "astoria", "boro zone")
    vendors = spark.createDataFrame([(1, " Big Co. ", " ACTIVE ")], VENDORS)
    assert tuple(stage_vendors(vendors).first()) == (1, "Big Co.", "active")


def test_seed(spark, tmp_path):
    path = tmp_path / "vendor.csv"
    path.write_text("vendor_id,vendor_name,status\n1,First Vendor,suspended\n2,Second Inc.,active\n")
    seed = read_seed(spark, str(path), VENDORS)
    assert values(seed, "vendor_id") == [1, 2]
    assert dict(seed.dtypes)["vendor_id"] == "int"


def test_column_lists_agree():
    assert [c.name for c in TRIP_COLUMNS + LINEAGE_COLUMNS] == LAKE_TRIPS.names
