"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Generated methods beyond this size are never compiled to machine code; wide projections do better split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Archives travel to Python as whole binary cells: bound a batch by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def build_session(app_name: str = "tablewright", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_root(application: str) -> str:
    """One temporary folder per local session."""
    return tempfile.mkdtemp(prefix="tablewright-")


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named in spark.checkpoint.dir.

    Only a local session may fall back to a machine-local folder; on a cluster the setting must be there,
    because executors on other machines have to see the same files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_root(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/tablewright/{label}-{uuid.uuid4().hex}"


def work_database(spark: SparkSession, label: str) -> str:
    """A fresh database whose managed tables live in the shared folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    folder = work_folder(spark, label)
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    return name

