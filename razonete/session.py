"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# SQL settings that may be set on a running session.
RUNTIME_CONF = {
    # A JSON object that repeats a key keeps the last value, as a dict would.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    # One document may own a third of all statements: let AQE split its join
    # partition even where a later aggregation then needs its own exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Whole document texts cross to Python in these batches.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    # A text may have many megabytes: a batch ends with the one that takes it over this size.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


# Settings that hold from the start of a session on.
STATIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Do not look up the call site of every column expression of a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the settings above, and let Python workers find this package where the driver has found it.

    A cluster whose nodes lack that folder needs the package installed or given with --py-files.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    root, environment = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def build_session(master: str | None = None, app: str = "razonete",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name in storage that the driver and all executors share.

    It lies below `spark.checkpoint.dir`, or where that is unset below the
    warehouse, for every kind of session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/razonete/{name}-{uuid.uuid4().hex}"
