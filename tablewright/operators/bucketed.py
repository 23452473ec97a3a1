"""Tables laid out by key bucket: a merge reads and rewrites only the buckets its changes fall into, and never moves the rest.

A row's bucket is the hash of its key. It is the table's partition column, and each partition's files are of that one
bucket in Spark's own layout, so Spark knows the table as partitioned by the key: a join on the key leaves the table
where it is and sends the changes to it. Partitions let single buckets be read and replaced.

The merge is one full outer join over the touched buckets. Which ones those are is at most the number of buckets; that
list is all the driver sees. Keys of the table are unique, so buckets are even as soon as keys are many.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators import merge, tables

BUCKET = "__bucket"


def bucket_of(keys: list[Column], buckets: int) -> Column:
    """The bucket Spark's writer puts the key in."""
    return F.pmod(F.hash(*keys), F.lit(buckets)).cast("int")


def create(df: DataFrame, name: str, keys: str | list[str], buckets: int = 64) -> None:
    """Create the table, or replace it, with its rows in buckets of the keys. A key that comes twice is refused."""
    keys = merge.as_list(keys)
    merge.check_unique(df, keys)
    spark = df.sparkSession
    tables.recover(spark, name)
    there = spark.catalog.tableExists(name)
    rows = df.withColumn(BUCKET, bucket_of([F.col(k) for k in keys], buckets)).repartition(buckets, *keys)
    (rows.write.mode("overwrite").partitionBy(BUCKET).bucketBy(buckets, *keys).sortBy(*keys)
     .saveAsTable(f"{name}__new" if there else name))
    if there:
        tables.swap_in(spark, name)


def rows(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(BUCKET)


def layout(spark: SparkSession, name: str) -> tuple[list[str], int]:
    """Keys and number of buckets of a table."""
    keys = [c.name for c in spark.catalog.listColumns(name) if c.isBucket]
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
    if not keys or told is None:
        raise ValueError(f"table {name} has no buckets")
    return keys, int(told.data_type)


def merged(spark: SparkSession, name: str, changes: DataFrame, update: str | list[str] | None = merge.ALL, order: str | None = None) -> DataFrame:
    """The rows of the touched buckets after the merge. `changes` are of the table's columns and read twice."""
    keys, buckets = layout(spark, name)
    schema = {f.name: f.dataType for f in spark.table(name).schema.fields}
    spelled = {c.lower(): c for c in schema if c != BUCKET}
    unknown = [c for c in changes.columns if c.lower() not in spelled]
    if unknown:
        raise merge.UnknownColumns(f"the table has no column {unknown}")
    source = changes.select(*[F.col(f"`{c}`").cast(schema[spelled[c.lower()]]).alias(spelled[c.lower()]) for c in changes.columns])
    merge.check_unique(source, keys)
    updates = merge.infer_updates(source.columns, keys) if update == merge.ALL else [spelled.get(c.lower(), c) for c in merge.as_list(update)]
    if order and updates and order not in updates:
        updates.append(order)
    missing = [c for c in [*keys, *updates] if c not in source.columns]
    if missing:
        raise merge.UnknownColumns(f"the source has no column {missing}")

    touched = [r[0] for r in source.select(bucket_of([F.col(k) for k in keys], buckets)).distinct().collect()]
    target = spark.table(name).where(F.col(BUCKET).isin(touched)).withColumn("__held", F.lit(True))
    new = source.select(*[F.col(c).alias(f"__new_{c}") for c in source.columns], F.lit(True).alias("__found"))
    matched = reduce(lambda a, b: a & b, [target[k] == new[f"__new_{k}"] for k in keys])
    joined = target.join(new, matched, "full_outer")
    wins = F.col("__found") & F.col("__held")
    if order:
        wins = wins & merge.later(F.col(f"__new_{order}"), F.col(order))
    inserted = F.col("__held").isNull()

    def value(name: str) -> Column:
        held = F.col(f"`{name}`")
        fresh = F.col(f"__new_{name}") if name in source.columns else F.lit(None).cast(schema[name])
        taken = inserted | wins if name in updates else inserted
        return F.when(taken, fresh).otherwise(held).alias(name)

    out = joined.select(*[value(c) for c in schema if c != BUCKET])
    return out.withColumn(BUCKET, bucket_of([F.col(k) for k in keys], buckets))


def upsert(changes: DataFrame, name: str, update: str | list[str] | None = merge.ALL, order: str | None = None) -> None:
    """Merge changes into the table by its keys; only the buckets they fall into get new files.

    NULL keys match nothing and are inserted. With `order`, a row is updated only by a later change than the one it holds.
    """
    spark = changes.sparkSession
    stored = f"{name}__changes"
    tables.save(changes, stored, None)  # the merge reads them several times, always the same
    try:
        _replace(merged(spark, name, spark.table(stored), update, order), name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {stored}")


def _replace(df: DataFrame, name: str) -> None:
    """As tables.replace_partitions, without moving the rows: they are in their buckets already."""
    tables.replace_partitions(df, name, [BUCKET], rebalance=False)
