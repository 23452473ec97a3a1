"""Shared parts of the registered queries: inputs and work files derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import work_folder

AS_OF = date(2024, 1, 15)
ARCHIVE_AS_OF = date(2000, 1, 1)
Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries with the SQL that must give the same rows."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(query: Query) -> Query:
            self.queries[name] = query
            if sql:
                self.sql[name] = sql
            return query

        return keep


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{table}.parquet")


def relaxed(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


#: Files a task keeps open at once while it writes pages; beyond them Spark sorts the rest of its pages by source.
OPEN_SOURCES = 32
#: Pages of a compressed file, which is read by one task: less than a split of plain text holds.
FILE_PAGES = 64


def write_pages(df: DataFrame, source: str, size: int = 1000) -> str:
    """Land a frame as paged JSON, one page per line, in compressed files of a bounded number of pages, in folders source=<value>.

    A page takes consecutive rows of one scan partition, so no page and no task grows with a large source: a task holds
    the page it fills and writes it where it is. Only a row per source is shuffled, for the totals.
    """
    spark = df.sparkSession
    final = work_folder(spark, "pages")
    part, chunk = F.shiftright("__place", 33), F.floor(F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) / size)
    record = [c for c in df.columns if c != source]

    def filled(batches):
        """Records (source, page, record) whose pages follow each other, as pages: source, page, data."""
        import pyarrow as pa

        held, current = {}, None

        def done():
            return pa.RecordBatch.from_pydict({"source": pa.array(list(held), pa.string()), "page": pa.array([current] * len(held), pa.int64()),
                                               "data": pa.array([",".join(r) for r in held.values()], pa.string())})

        for batch in batches:
            for source, page, record in zip(*(batch.column(c).to_pylist() for c in ("source", "page", "record"))):
                if page != current:
                    if held:
                        yield done()
                    held, current = {}, page
                held.setdefault(source, []).append(record)
        if held:
            yield done()

    placed = (df.withColumn("__place", F.monotonically_increasing_id())
              .select(F.col(source).cast("string").alias("source"), (part * F.lit(1 << 24) + chunk + 1).alias("page"),
                      F.to_json(F.struct(*record)).alias("record")))
    totals = placed.groupBy("source").agg(F.count("*").alias("totalCount"), F.max("page").alias("last"))
    fields = {"page": F.col("page"), "pageSize": F.lit(size), "totalCount": F.col("totalCount"),
              "hasMore": F.col("page") < F.col("last")}
    envelope = [x for k, v in fields.items() for x in (F.lit(f'"{k}":'), v.cast("string"), F.lit(","))]
    lines = placed.mapInArrow(filled, "source string, page long, data string").join(F.broadcast(totals), "source").select(
        "source", F.concat(F.lit("{"), *envelope, F.lit('"data":['), "data", F.lit("]}")).alias("value"))
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(OPEN_SOURCES))  # otherwise every task sorts its pages by source first
    try:
        lines.write.partitionBy("source").option("maxRecordsPerFile", FILE_PAGES).text(final, compression="gzip")
    finally:
        spark.conf.set(key, before)
    return final


def pack_records(df: DataFrame, member: str | None = None) -> DataFrame:
    """Rows packed into zip archives of CSV members, one archive per Arrow batch: path, content.

    member names the column with a row's member file; it is not packed itself.
    """
    header = [c for c in df.columns if c != member]

    def pack(batches):
        import csv
        import io
        import zipfile

        import pandas as pd
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                groups = batch.groupby(member) if member else [("records.csv", batch)]
                for name, rows in groups:
                    text = io.StringIO()
                    out = csv.writer(text)
                    out.writerow(header)
                    out.writerows(rows[header].itertuples(index=False))
                    archive.writestr(name, text.getvalue())
            yield pd.DataFrame({"path": [f"drop-{part}-{number}.zip"], "content": [packed.getvalue()]})

    return df.mapInPandas(pack, "path string, content binary")


def pack_members(df: DataFrame) -> DataFrame:
    """Rows (member, body) packed into zip archives, one per Arrow batch: path, content."""
    def pack(batches):
        import io
        import zipfile

        import pandas as pd
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                for member, body in zip(batch["member"], batch["body"]):
                    archive.writestr(member, body)
            yield pd.DataFrame({"path": [f"members-{part}-{number}.zip"], "content": [packed.getvalue()]})

    return df.select("member", "body").mapInPandas(pack, "path string, content binary")
