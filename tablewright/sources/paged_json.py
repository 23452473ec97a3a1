"""Paged JSON responses landed as files, one page per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.schemas import page_schema


def read_pages(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Every page with its envelope and the source it belongs to (folder source=...). Pages are read in parallel.

    A page that is cut off or broken stops the read instead of vanishing.
    """
    schema = T.StructType(page_schema(record).fields + [T.StructField("source", T.StringType())])
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


_BROKEN = "__broken"
REJECTS = "source string, path string, page int, reason string, text string"


def sorted_out(spark: SparkSession, path: str, record: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Pages that can be read, as read_pages has them, and the others with their place (see REJECTS).

    A page that is cut off, holds a value that does not fit, or lacks its envelope is rejected as a whole and costs no
    other page. Its number is taken from its text where it can be found there.
    """
    fields = [*page_schema(record).fields, T.StructField("source", T.StringType()), T.StructField(_BROKEN, T.StringType())]
    pages = (spark.read.schema(T.StructType(fields)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BROKEN).json(path)
             .select("*", F.col("_metadata.file_path").alias("__path")))
    bare = F.col("page").isNull() | F.col("data").isNull() | F.col("hasMore").isNull()
    good = pages.where(F.col(_BROKEN).isNull() & ~bare).drop(_BROKEN, "__path")
    number = F.regexp_extract(_BROKEN, r'"page"\s*:\s*([0-9]{1,9})\b', 1)
    rejects = pages.where(F.col(_BROKEN).isNotNull() | bare).select(
        "source", F.col("__path").alias("path"), F.coalesce("page", F.nullif(number, F.lit("")).cast("int")).alias("page"),
        F.when(F.col(_BROKEN).isNull(), "no envelope").otherwise("broken").alias("reason"),
        F.coalesce(_BROKEN, F.to_json(F.struct("page", "pageSize", "totalCount", "hasMore", "data"))).alias("text"))
    return good, rejects


def gaps(pages: DataFrame) -> DataFrame:
    """source, first, last of the runs of page numbers that are not there; last is NULL where the end is missing.

    Pages run from 1 to the one that announces no more. Each page looks for the one after it, so no task goes through a
    source; only the edges of gaps, which are few, are lined up.
    """
    there = pages.groupBy("source", "page").agg(F.max("hasMore").alias("more")).where("page IS NOT NULL")
    begun = pages.select("source").distinct().select("source", F.lit(0).alias("page"), F.lit(True).alias("more"))
    after = there.unionByName(begun).where("more").select("source", (F.col("page") + 1).alias("page"))
    before = there.where("page > 1").select("source", (F.col("page") - 1).alias("page"))
    held = there.unionByName(begun).select("source", "page")
    edges = (_absent(after, held).select("source", "page", F.lit(True).alias("opens"))
             .unionByName(_absent(before, held).select("source", "page", F.lit(False).alias("opens"))))
    following = Window.partitionBy("source").orderBy("page", F.col("opens").desc())
    return (edges.withColumn("last", F.when(~F.lead("opens").over(following), F.lead("page").over(following)))
            .where("opens").select("source", F.col("page").alias("first"), "last"))


def _absent(wanted: DataFrame, held: DataFrame) -> DataFrame:
    """Pages that are not held; a source without a name is one of its own."""
    other = held.select(F.col("source").alias("__source"), F.col("page").alias("__page"))
    return wanted.join(other, F.col("source").eqNullSafe(F.col("__source")) & (F.col("page") == F.col("__page")), "left_anti")


def records_of(pages: DataFrame, tenant: str | None = None) -> DataFrame:
    """The records of all pages, stamped with the tenant they were pulled for."""
    stamp = F.col("source") if tenant is None else F.lit(tenant)
    return pages.select(F.inline("data"), stamp.alias("__tenant")).withColumnRenamed("__tenant", "tenantId")
