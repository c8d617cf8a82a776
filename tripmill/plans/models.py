"""The trip models as live views for SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmill.operators.dimensions import dim_date, dim_zone
from tripmill.operators.duplicates import duplicate_report
from tripmill.operators.enrich import checked_lookup, core_trips, fact_trips
from tripmill.operators.history import dim_current
from tripmill.operators.quality import dq_issue_summary, quarantine
from tripmill.operators.staging import stage_trips, stage_vendors, stage_zones
from tripmill.sinks import register_view
from tripmill.sources import date_spine


def trip_models(
    lake_trips: DataFrame,
    zones: DataFrame,
    vendors: DataFrame | None = None,
    vendor_history: DataFrame | None = None,
    core: DataFrame | None = None,
    fact: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every model by its table name. Stored core and fact tables may be given;
    otherwise they are computed from the lake table."""
    spark = lake_trips.sparkSession
    staged = stage_trips(lake_trips)
    staged_zones = stage_zones(zones)
    if core is None:
        core = core_trips(staged, checked_lookup(staged_zones, "location_id"))
    quarantined = quarantine(staged)
    models = {
        "stg_trip_data": staged,
        "stg_taxi_zone_lookup": staged_zones,
        "int_trip_data_core": core,
        "int_trip_data_quarantine": quarantined,
        "int_trip_data_dq_duplicates": duplicate_report(staged),
        "fact_trip": fact if fact is not None else fact_trips(core),
        "dim_date": dim_date(date_spine(spark)),
        "dim_taxi_zone": dim_zone(staged_zones),
        "dq_trip_issue_summary": dq_issue_summary(quarantined),
    }
    if vendors is not None:
        models["stg_vendor"] = stage_vendors(vendors)
    if vendor_history is not None:
        models["snap_vendor"] = vendor_history
        models["dim_vendor"] = dim_current(vendor_history)
    return models


def register_models(**sources: DataFrame) -> dict[str, DataFrame]:
    """Register every model as a temporary view; see :func:`trip_models`."""
    models = trip_models(**sources)
    return {name: register_view(df, name) for name, df in models.items()}
