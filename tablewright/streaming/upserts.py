"""Streaming upsert: every micro-batch goes through the table merge, so a repeated batch changes nothing.

With an order, files may arrive late: a change that is older than what the table holds is passed over, in whatever batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import merge, tables
from tablewright.streaming.ingest import finish


def latest_per_key(batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key inside a batch; partial aggregation keeps a hot key cheap.

    A NULL order comes before all others. Rows with a NULL key match nothing and all stay.
    """
    rest = [c for c in batch.columns if c not in keys]
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    last = (batch.where(keyed).groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.struct(F.col(order).isNotNull(), F.col(order))).alias("__last"))
            .select(*keys, "__last.*").select(*batch.columns))
    return last.unionByName(batch.where(~keyed))


def upsert_stream(spark: SparkSession, source: str, schema: T.StructType, table: str, keys: list[str],
                  checkpoint: str, order: str | None = None, partition_by: list[str] | None = None,
                  update: str | list[str] | None = merge.ALL, format: str = "parquet", files_per_batch: int = 1000, timeout: int | None = None) -> None:
    """Merge the files not seen before into the table, batch by batch in order of arrival.

    With `order`, several changes of one key inside a batch collapse to the last one, and a key is updated only by a later
    change than the one it holds, so the table is the same in whatever order the files come. Give `partition_by` columns that
    are part of the key: then a batch rewrites only the partitions it names instead of the whole table.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(batch, keys, order) if order else batch
        tables.upsert_table(rows, table, keys, update, partition_by=partition_by, order=order)

    run = (spark.readStream.format(format).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(source)
           .writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    finish(run, timeout)
