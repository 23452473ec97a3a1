"""Consecutive row ids by prefix sums: a range sort, counts per partition, offsets added.

No window spans the rows. They are written once with their place of arrival, which breaks ties, so equal rows are spread
over ranges like all others and a task that runs again finds the same rows. The driver sees one count per partition.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import work_folder

#: Bits of a row's place in its partition, as monotonically_increasing_id counts.
PLACE = (1 << 33) - 1


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, label: str) -> DataFrame:
    folder = work_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def ranged(df: DataFrame, order: list[Column], part: str, place: str, unique: bool = False) -> DataFrame:
    """The rows in files of consecutive ranges, with the number of their range and their place in it.

    `order` may name any sort; rows that it leaves tied follow one another as they came. Where it leaves none tied,
    `unique` saves the writing of their arrival.
    """
    arrival = free_name(df, "__arrival")
    rows = df if unique else written(df.withColumn(arrival, F.monotonically_increasing_id()), "rowid_rows")
    keys = order if unique else [*order, F.col(arrival)]
    placed = (rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(arrival)
              .withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE))}))
    return written(placed, "rowid_ranges")


def offsets(spark: SparkSession, counts: dict[int, int], part: str, offset: str, start: int = 0) -> DataFrame:
    """part, offset: the rows in front of each part. One row per part, so it can be broadcast whatever the rows."""
    parts = sorted(counts)
    before = accumulate((counts[p] for p in parts), initial=start)
    return F.broadcast(spark.createDataFrame(list(zip(parts, before)), f"`{part}` int, `{offset}` long"))


def numbered(df: DataFrame, order: list[Column], name: str = "row_id", start: int = 1) -> DataFrame:
    """The rows with ids start, start + 1, ... in the given order. A column of that name is replaced; an empty frame stays empty."""
    df = df.drop(name)
    part, place, offset = (free_name(df, n) for n in ("__part", "__place", "__offset"))
    rows = ranged(df, order, part, place)
    counts = {r[0]: r[1] for r in rows.groupBy(part).count().collect()}
    return (rows.join(offsets(df.sparkSession, counts, part, offset, start), part)
            .select(*df.columns, (F.col(offset) + F.col(place)).alias(name)))


def write_pages(df: DataFrame, order: list[Column], path: str, size: int = 1000, name: str = "row_id") -> None:
    """Numbered rows (from 1) as a page index: Parquet whose files hold consecutive ids, for reads by offset.

    Every row has its `page`; a file's footer bounds its ids and pages, so a read of one page opens few row groups.
    """
    rows = numbered(df.drop("page"), order, name)
    rows.withColumn("page", F.floor((F.col(name) - 1) / size) + 1).sortWithinPartitions(name).write.mode("overwrite").parquet(path)


def read_page(spark: SparkSession, path: str, offset: int, size: int, name: str = "row_id") -> DataFrame:
    """Rows offset + 1 to offset + size of a page index, by a filter that the scan takes."""
    return spark.read.parquet(path).where((F.col(name) > offset) & (F.col(name) <= offset + size))
