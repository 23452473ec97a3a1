"""Archives as a stream of files: what comes twice under two names lands once.

An archive is known by the hash of its bytes, which the stream's state keeps; only path and hash are shuffled, never the
bytes. New ones are unpacked by the file moves, whose ledger records every member, so a batch that runs again finds its
members there. The state grows by one hash per archive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators import moves
from tablewright.streaming.ingest import finish

BINARY = "path string, modificationTime timestamp, length long, content binary"


def take_in(spark: SparkSession, source: str, target: str, ledger: str, checkpoint: str, run: str = "intake", files_per_batch: int = 1000,
            timeout: int | None = None) -> None:
    """Unpack the zip archives below `source` that no earlier run of the checkpoint has seen to table=/date=/ folders.

    The ledger's rows have run/<batch> as their run.
    """
    arrivals = (spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true")
                .option("maxFilesPerTrigger", files_per_batch).load(source))
    fresh = arrivals.select("path", F.sha2("content", 256).alias("sha256")).dropDuplicates(["sha256"])

    def unpack(batch: DataFrame, batch_id: int) -> None:
        moves.unpack_files(batch.sparkSession, batch.select(F.col("path").alias("source"), F.lit(target).alias("target")), ledger, f"{run}/{batch_id}")

    finish(fresh.writeStream.foreachBatch(unpack).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), timeout)
