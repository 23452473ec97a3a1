"""Ordered pages, lookups and the two halves of an ordered list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.session import work_folder


def head_list(df: DataFrame, columns: list[str], order: str, size: int = 1000) -> DataFrame:
    """The first rows of a list, ordered by its record number."""
    return df.select(*columns).orderBy(order).limit(size)


def detail_page(df: DataFrame, where: Column, order: list[Column], offset: int = 0, size: int = 2000) -> DataFrame:
    """One page of a filtered list, for a caller who shows a page."""
    return df.where(where).orderBy(*order).offset(offset).limit(size)


def all_details(df: DataFrame, where: Column) -> DataFrame:
    """Every row of the filtered list; a pull of all pages is one scan, without paging."""
    return df.where(where)


def by_key(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def middle(df: DataFrame, key: str) -> object:
    """The key with the middle place in ascending order (the lower one of two), of any type that can be ordered.

    Keys are counted first, so a hot key is one row; ranges of keys are counted next, and only the range that holds
    the middle is sorted. None without keys.
    """
    spark = df.sparkSession
    path = work_folder(spark, "middle")
    (df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
     .repartitionByRange("key").withColumn("part", F.spark_partition_id()).write.parquet(path))
    counted = spark.read.parquet(path)
    left = -(-(counted.agg(F.sum("n")).first()[0] or 0) // 2)
    for part in counted.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # one row per range
        if left <= part["n"]:
            inside = counted.where(F.col("part") == part["part"]).withColumn("upto", F.sum("n").over(Window.partitionBy("part").orderBy("key")))
            return inside.where(F.col("upto") >= left).agg(F.min("key")).first()[0]
        left -= part["n"]
    return None


def halves(df: DataFrame, key: str, names: tuple[str, str] = ("first", "second"), column: str = "run") -> DataFrame:
    """Every row with the half of the list it is in. Equal keys stay together; rows without a key are in the second."""
    found = middle(df, key)
    first = F.lit(False) if found is None else F.coalesce(F.col(key) <= F.lit(found), F.lit(False))
    return df.withColumn(column, F.when(first, F.lit(names[0])).otherwise(F.lit(names[1])))


def run_half(df: DataFrame, key: str, second: bool) -> DataFrame:
    """First half of the list in ascending order, or the second half. The halves are disjoint and complete."""
    return halves(df, key, column="__half").where(F.col("__half") == ("second" if second else "first")).drop("__half")
