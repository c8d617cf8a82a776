"""Session defaults and the shared scratch folder.

The library never needs these defaults to be correct; they are what a cluster
job should start with so that AQE can coalesce, split skew and size files.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split a skewed join partition even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # large keyed state must not live on the executor heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "tripmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local folder; on a cluster
    such a folder would vanish with its executor, so that case is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="tripmill-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that no earlier run has used."""
    return f"{scratch_root(spark)}/tripmill/{label}-{uuid.uuid4().hex}"


@contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply SQL settings for the actions inside the block, then restore them."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
