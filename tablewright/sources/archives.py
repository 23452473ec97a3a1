"""Members of zip archives as rows.

No Spark reader opens zip members, so this is the one place where rows are made in Python. A task holds the
archive it works on and streams its members in chunks; nothing else is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_SCHEMA = "path string, member string, record_no bigint, fields array<string>"


def archives(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.zip").load(path).select("path", "content"))


def expand_records(packed: DataFrame, sep: str = ",", chunk_rows: int = 5000, chunk_chars: int = 8_000_000) -> DataFrame:
    """One row per delimited record of every member, with its number; number 0 is the header."""
    columns = ["path", "member", "record_no", "fields"]

    def members(batches):
        import csv
        import io
        import zipfile

        import pandas as pd

        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows, held = [], 0
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for info in archive.infolist():
                        if info.is_dir():
                            continue
                        with archive.open(info) as raw:
                            text = io.TextIOWrapper(raw, "utf-8", newline="")
                            for number, record in enumerate(csv.reader(text, delimiter=sep)):
                                rows.append((path, info.filename, number, record))
                                held += sum(map(len, record))
                                if len(rows) >= chunk_rows or held >= chunk_chars:
                                    yield pd.DataFrame(rows, columns=columns)
                                    rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    return packed.select("path", "content").mapInPandas(members, RECORD_SCHEMA)


def typed_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Data records cast to the schema; path and member stay in front. Empty text becomes NULL.

    Fields are found by the member's header, without regard to case, so their order in a member does not matter. A
    member that lacks a field of the schema is refused.
    """
    header = records.where(F.col("record_no") == 0).select(
        F.col("path").alias("__path"), F.col("member").alias("__member"), F.transform("fields", F.lower).alias("__names"))
    same = (records["path"] == F.col("__path")) & (records["member"] == F.col("__member"))

    def value(name: str) -> Column:
        at = F.array_position("__names", F.lit(name.lower()))
        lacks = F.raise_error(F.concat(F.lit(f"no field {name} in "), F.col("member"))).cast("string")
        return F.when(at > 0, F.get("fields", at.cast("int") - 1)).otherwise(lacks)

    fields = [F.nullif(value(f.name), F.lit("")).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return records.where(F.col("record_no") > 0).join(header, same).select("path", "member", *fields)
