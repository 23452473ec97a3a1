"""Each new file once: the file source with a checkpoint, run over what is there and then stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ingest_new_files(spark: SparkSession, source: str, target: str, checkpoint: str, schema: T.StructType,
                     format: str = "parquet", files_per_batch: int = 1000, timeout: int | None = None,
                     **options: str) -> None:
    """Append the records of files not seen by earlier runs of the same checkpoint."""
    arrivals = (spark.readStream.format(format).schema(schema).options(**options)
                .option("maxFilesPerTrigger", files_per_batch).load(source))
    run = (arrivals.writeStream.format("parquet").option("path", target)
           .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finish(run, timeout)


def finish(run, timeout: int | None = None) -> None:
    """Wait until the stream has taken in what there was, however long that is unless a limit is given."""
    if timeout is None:
        run.awaitTermination()
    elif not run.awaitTermination(timeout):
        run.stop()
        raise TimeoutError(f"stream did not finish within {timeout} s")
    if run.exception() is not None:
        raise run.exception()


def landed(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target)
