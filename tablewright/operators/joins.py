"""Joins of the collection flows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_chain(base: DataFrame, others: list[DataFrame], on: str) -> DataFrame:
    """Glue several frames to a base by a natural key. Frames must hold a key once, as attributes do."""
    return reduce(lambda left, right: left.join(right, on, "left"), others, base)


def pair_accounts(rows: DataFrame, accounts: DataFrame, key: str) -> DataFrame:
    """Attach the account's attributes to each of its rows. Spark broadcasts the accounts when they are small."""
    return rows.join(accounts, key)


def not_present(source: DataFrame, present: DataFrame, on: list[str]) -> DataFrame:
    """Rows of the source whose key is not there yet.

    What is present holds a key once, as an inventory does, so it joins as it is: AQE can then split a source key
    that fills much of the input, which it cannot when an aggregate stands in between.
    """
    return source.join(present.select(*on), on, "left_anti")


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_by_position(*frames: DataFrame) -> DataFrame:
    """Union by position, refused when the frames' headers differ."""
    headers = {tuple(f.columns) for f in frames}
    if len(headers) > 1:
        raise ValueError(f"headers differ: {sorted(headers)}")
    return reduce(DataFrame.union, frames)


def expected_rows(pages: DataFrame, source: str = "source") -> DataFrame:
    """Rows received against rows announced, per source."""
    return (pages.groupBy(source)
            .agg(F.sum(F.size("data")).alias("records"), F.max("totalCount").alias("totalCount"),
                 F.max("page").alias("page"), F.max_by("hasMore", "page").alias("hasMore"))
            .withColumn("complete", ~F.col("hasMore") & (F.col("records") >= F.col("totalCount"))))
