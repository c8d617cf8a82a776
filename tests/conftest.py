"""Session and small literal inputs."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tripmill.operators.staging import stage_trips  # noqa: E402
from tripmill.schemas import LAKE_TRIPS  # noqa: E402
from tripmill.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> Iterator[SparkSession]:
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # plans are read by the tests, so they must not be shortened
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.debug.maxToStringFields": "200",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULT_TRIP = {
    "vendorid": 1,
    "cab_type": "yellow",
    "pickup_datetime": datetime(2024, 1, 5, 8, 0),
    "dropoff_datetime": datetime(2024, 1, 5, 8, 30),
    "store_and_fwd_flag": "N",
    "ratecodeid": 1,
    "pulocationid": 10,
    "dolocationid": 20,
    "passenger_count": 2,
    "trip_distance": 3.5,
    "fare_amount": 20.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 4.0,
    "tolls_amount": 0.0,
    "ehail_fee": None,
    "improvement_surcharge": 0.3,
    "total_amount": 25.3,
    "payment_type": 1,
    "trip_type": None,
    "congestion_surcharge": None,
    "airport_fee": None,
    "ingestion_ts": datetime(2024, 2, 1),
    "batch_id": "b1",
    "source_file": "f1",
    "migration_batch_id": "m1",
    "engine_type": "spark",
}


@pytest.fixture
def lake(spark) -> Callable[..., DataFrame]:
    """Lake trips from the fields that differ from a default trip."""

    def build(*changes: dict) -> DataFrame:
        rows = [tuple({**DEFAULT_TRIP, **c}[f.name] for f in LAKE_TRIPS.fields) for c in changes]
        return spark.createDataFrame(rows, LAKE_TRIPS)

    return build


@pytest.fixture
def staged(lake) -> Callable[..., DataFrame]:
    return lambda *changes: stage_trips(lake(*changes))


@pytest.fixture
def zones(spark) -> DataFrame:
    rows = [(10, "queens", "astoria", "boro zone"), (20, "manhattan", "soho", "yellow zone")]
    return spark.createDataFrame(
        rows, "location_id int, borough string, zone string, service_zone string"
    )


def values(df: DataFrame, column: str) -> list:
    return sorted((row[column] for row in df.collect()), key=lambda v: (v is None, v))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
