"""File inventories and their classification."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.times import day_before


def inventory(spark: SparkSession, path: str, prefix: str | None = None, modified_before: date | None = None,
              glob: str | None = None) -> DataFrame:
    """name, path, size, last_modified of the files that are not empty. File contents are not read.

    modified_before keeps files last modified strictly before that day.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if modified_before:
        reader = reader.option("modifiedBefore", f"{modified_before.isoformat()}T00:00:00")
    files = reader.load(path).where(F.col("length") > 0).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "path", F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"))
    return files.where(F.startswith(F.col("name"), F.lit(prefix))) if prefix else files


def recent(files: DataFrame, as_of: date, column: str = "last_modified") -> DataFrame:
    """Files modified at or after yesterday's midnight."""
    return files.where(F.col(column) >= F.lit(f"{day_before(as_of)} 00:00:00").cast("timestamp"))


def load_types(name: Column) -> Column:
    """Every load type the name fits: fl for a full load, cr, upd and del for change files. Often one, maybe several."""
    change = F.contains(name, F.lit("change."))
    fits = [F.when(F.contains(name, F.lit("all.")), F.lit("fl"))]
    fits += [F.when(change & F.contains(name, F.lit(f"_{mark}_")), F.lit(mark)) for mark in ("cr", "upd", "del")]
    return F.array_compact(F.array(*fits))


def load_type(name: Column) -> Column:
    """The first load type the name fits, else NULL."""
    return F.get(load_types(name), F.lit(0))


def of_type(files: DataFrame, kind: str, column: str = "name") -> DataFrame:
    """Files of a load type; all keeps every file."""
    return files if kind == "all" else files.where(F.array_contains(load_types(F.col(column)), kind))
