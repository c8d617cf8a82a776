"""Materialisation: landing, promotion, keyed upsert, full refresh, views."""

from tripmill.sinks.landing import LandingPlan, land, plan_write, promote
from tripmill.sinks.tables import (
    materialize_table,
    register_view,
    sync_schema,
    written_copy,
)
from tripmill.sinks.upsert import upsert

__all__ = [
    "LandingPlan",
    "land",
    "materialize_table",
    "plan_write",
    "promote",
    "register_view",
    "sync_schema",
    "upsert",
    "written_copy",
]
