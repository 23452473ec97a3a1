"""Tables and columns the session knows, as DataFrames; warming and scanning of tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMN_SCHEMA = "COLUMN_NAME string, DATA_TYPE string, ORDINAL_POSITION int, IS_NULLABLE string"
WARM_SCHEMA = "table_name string, row_count bigint, ok boolean, error string"


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def tables(spark: SparkSession, database: str, first: int | None = None) -> DataFrame:
    """db.table names of a database in order, without the information schema; optionally the first few."""
    names = sorted(f"{database}.{t.name}" for t in spark.catalog.listTables(database) if not t.isTemporary)
    if database.lower() == "information_schema":
        names = []
    listed = spark.createDataFrame([(n,) for n in names], "table_name string").orderBy("table_name")
    return listed.limit(first) if first else listed


def column_metadata(df: DataFrame) -> DataFrame:
    """Name, type, ordinal (from 1) and nullability of the columns, in order. Metadata only, no data is read."""
    rows = [(f.name, f.dataType.simpleString(), i, "YES" if f.nullable else "NO")
            for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, COLUMN_SCHEMA).orderBy("ORDINAL_POSITION")


def nested_fields(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted names of every field of a definition."""
    names = []
    for f in schema.fields:
        names.append(prefix + f.name)
        if isinstance(f.dataType, T.StructType):
            names += nested_fields(f.dataType, f"{prefix}{f.name}.")
    return names


def _each(spark: SparkSession, names: list[str], work, threads: int) -> DataFrame:
    def attempt(name: str):
        try:
            return name, work(name), True, None
        except Exception as error:  # one bad table must not stop the others
            return name, None, False, str(error) or type(error).__name__

    with ThreadPoolExecutor(threads) as pool:
        return spark.createDataFrame(list(pool.map(attempt, names)), WARM_SCHEMA)


def warm_tables(spark: SparkSession, names: list[str], threads: int = 10) -> DataFrame:
    """Cache each table and read it once, several at a time. Failures are reported, not raised."""

    def cache(name: str) -> int:
        spark.catalog.cacheTable(name)
        return spark.table(name).count()

    return _each(spark, names, cache, threads)


def scan_tables(spark: SparkSession, names: list[str], threads: int = 10) -> DataFrame:
    """Read every row of each table, several tables at a time, to put load on the cluster."""

    def scan(name: str) -> int:
        seen = Observation()
        rows = spark.table(name)
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
        return seen.get["n"]

    return _each(spark, names, scan, threads)


def release(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        if spark.catalog.tableExists(name) and spark.catalog.isCached(name):
            spark.catalog.uncacheTable(name)
