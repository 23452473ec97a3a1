"""Managed tables: create, overwrite, upsert, drop a column, compact.

Without a transactional format a table is replaced by writing <name>__new and renaming twice. The old copy is
never touched before the new one is complete; `recover` repairs an interrupted swap.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.names import qualified
from tablewright.operators import columns, merge
from tablewright.schemas import LAYERS
from tablewright.session import work_folder


def layer_table(layer: str, table: str, suffix: str | None = None) -> str:
    if layer.lower() not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}")
    return qualified(layer, table, suffix)


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def create_table(df: DataFrame | None, name: str, partition_by: list[str] | None = None,
                 as_of: date | None = None, **metadata: object) -> None:
    """Create the table or replace it. None is a no-op."""
    if df is None:
        return
    frame = columns.append_metadata(df, as_of, **metadata) if metadata else df
    spark = frame.sparkSession
    recover(spark, name)
    if spark.catalog.tableExists(name):
        save(frame, f"{name}__new", partition_by)
        swap_in(spark, name)
    else:
        save(frame, name, partition_by)


def overwrite_table(df: DataFrame | None, name: str, keep_previous: bool = False, as_of: date | None = None,
                    **metadata: object) -> bool:
    """Replace the rows of an existing table. An empty frame is refused and the table stays as it is."""
    if df is None:
        return False
    spark = df.sparkSession
    recover(spark, name)
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table {name} does not exist")
    frame = columns.append_metadata(df, as_of, **metadata) if metadata else df
    save(frame, f"{name}__new", partition_columns(spark, name))
    if spark.table(f"{name}__new").isEmpty():  # asked of the written copy, so the frame is computed once
        spark.sql(f"DROP TABLE {name}__new")
        return False
    swap_in(spark, name, keep_previous)
    return True


def drop_column(spark: SparkSession, name: str, column: str, keep_previous: bool = False) -> None:
    recover(spark, name)
    layout = partition_columns(spark, name)
    # files hold one partition each, so the rows need not move as long as the partitions stay the same
    save(spark.table(name).drop(column), f"{name}__new", [c for c in layout if c != column], column in layout)
    swap_in(spark, name, keep_previous)


def upsert_table(source: DataFrame | None, name: str, keys: str | list[str] | None = None,
                 update: str | list[str] | None = merge.ALL, declared: T.StructType | None = None,
                 partition_by: list[str] | None = None, as_of: date | None = None, order: str | None = None, **metadata: object) -> None:
    """Merge rows into the table, or create it from them when it is missing.

    With `order`, a match updates a row only if its order is later than the one the table holds (see merge.upsert).

    Keys default to the required fields of the declared schema. A partitioned table whose partition columns are not
    updated has only the touched partitions rewritten: those the source names, and those that hold a matching row.
    The source is written out once first, so its plan runs once however often the merge reads it.
    """
    if source is None:
        return
    spark = source.sparkSession
    rows = columns.append_metadata(source, as_of, **metadata) if metadata else source
    recover(spark, name)
    if not spark.catalog.tableExists(name):
        create_table(rows, name, partition_by)
        return
    keys = merge.as_list(keys) or merge.infer_keys(declared)
    updates = merge.infer_updates(rows.columns, keys) if update == merge.ALL else merge.as_list(update)
    changes = f"{name}__changes"
    save(rows, changes, None)
    try:
        _merge_into(name, spark.table(changes), keys, updates, order)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {changes}")


def _merge_into(name: str, rows: DataFrame, keys: list[str], updates: list[str], order: str | None) -> None:
    """Merge rows of a stored table: they are read several times, always the same, and their size is known."""
    spark = rows.sparkSession
    merge.check_unique(rows, keys)
    target, layout = spark.table(name), partition_columns(spark, name)
    if layout and not set(layout) & {*updates, order}:
        part = in_partitions(target, touched_partitions(target, rows, keys, layout), layout)
        replace_partitions(merge.upsert(part, rows, keys, updates, check=False, order=order), name, layout)
        return
    save(merge.upsert(target, rows, keys, updates, check=False, order=order), f"{name}__new", layout)
    swap_in(spark, name)


def touched_partitions(target: DataFrame, rows: DataFrame, keys: list[str], layout: list[str]) -> DataFrame:
    """Partition values a merge has to rewrite. Only keys and partition columns of the target are read for it."""
    named = rows.select(*layout)
    if not set(layout) <= set(keys):
        wanted = rows.select(*[F.col(k).alias(f"__{k}") for k in keys])
        named = named.unionByName(target.select(*dict.fromkeys([*layout, *keys])).join(
            wanted, [F.col(k) == F.col(f"__{k}") for k in keys], "left_semi").select(*layout))
    return named.distinct()


def in_partitions(target: DataFrame, touched: DataFrame, layout: list[str]) -> DataFrame:
    """Rows of the touched partitions. Their values are written out once and joined, so Spark prunes by them.

    Partitions of NULL are joined apart: pruning works on plain equality only.
    """
    path = work_folder(target.sparkSession, "touched")
    touched.select(*[F.col(c).alias(f"__{c}") for c in layout]).write.parquet(path)
    wanted = target.sparkSession.read.parquet(path)
    some_null = reduce(lambda a, b: a | b, [F.col(f"__{c}").isNull() for c in layout])
    held_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in layout])
    full = wanted.where(~some_null)
    plain = target.join(full, [target[c] == full[f"__{c}"] for c in layout], "left_semi")
    empty, apart = target.where(held_null), wanted.where(some_null)
    return plain.unionByName(empty.join(apart, [empty[c].eqNullSafe(apart[f"__{c}"]) for c in layout], "left_semi"))


def append_partitioned(df: DataFrame, name: str, partition_by: list[str]) -> None:
    """Append rows, creating database and table when needed; one rebalanced write per call."""
    spark = df.sparkSession
    if "." in name:
        ensure_database(spark, name.rsplit(".", 1)[0])
    writer = df.hint("rebalance", *partition_by).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def compact(spark: SparkSession, name: str, where: Column | None = None) -> None:
    """Rewrite the files of the chosen partitions (all by default) in balanced sizes.

    The rebalance hint lets AQE merge small pieces and split a partition that holds most rows. Chosen partitions that
    are in one file already stay as they are.
    """
    layout = partition_columns(spark, name)
    rows = spark.table(name)
    if not layout:
        save(rows.hint("rebalance"), f"{name}__new", [])
        swap_in(spark, name)
        return
    chosen = rows if where is None else rows.where(where)
    if where is not None and len(chosen.inputFiles()) <= 1:
        return  # the partitions asked for are in one piece already
    replace_partitions(chosen, name, layout)


def replace_partitions(df: DataFrame, name: str, layout: list[str], rebalance: bool = True) -> None:
    """Replace the partitions the frame holds rows of. Old files go only when the whole write commits."""
    conf = df.sparkSession.conf
    key = "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(key)
    conf.set(key, "dynamic")  # insertInto takes the mode from the session only
    try:
        (df.hint("rebalance", *layout) if rebalance else df).write.mode("overwrite").insertInto(name)
    finally:
        conf.set(key, before)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def swap_in(spark: SparkSession, name: str, keep_previous: bool = False) -> None:
    """Put <name>__new in the place of <name>."""
    previous = f"{name}__previous"
    spark.sql(f"DROP TABLE IF EXISTS {previous}")
    _rename(spark, name, previous)
    _rename(spark, f"{name}__new", name)
    if not keep_previous:
        spark.sql(f"DROP TABLE {previous}")


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    if partition_columns(spark, new):
        # partitions keep the paths they had before the rename until the catalog looks again
        spark.sql(f"MSCK REPAIR TABLE {new} SYNC PARTITIONS")


def recover(spark: SparkSession, name: str) -> None:
    """Repair a swap that stopped half way: the table comes back and a leftover copy goes."""
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}__previous"):
        _rename(spark, f"{name}__previous", name)
    if spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}__new"):
        spark.sql(f"DROP TABLE {name}__new")


def save(df: DataFrame, name: str, partition_by: list[str] | None, rebalance: bool = True) -> None:
    writer = (df.hint("rebalance", *partition_by) if partition_by and rebalance else df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
