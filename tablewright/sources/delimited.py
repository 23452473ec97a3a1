"""Delimited text with declared schemas."""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# Quotes are doubled, as in most exports, so a backslash is plain data wherever it stands.
TEXT_OPTIONS = {"header": "true", "escape": '"'}
# Quoted values may hold line breaks, and a value that does not fit its type stops the read instead of turning NULL.
READ_OPTIONS = {**TEXT_OPTIONS, "enforceSchema": "false", "multiLine": "true", "mode": "FAILFAST"}


def read_delimited(spark: SparkSession, paths: str | list[str], schema: T.StructType, sep: str = "|",
                   **options: str) -> DataFrame:
    """Many files in one read. A header that differs from the schema raises instead of shifting columns.

    Values that do not fit raise too; pass mode="PERMISSIVE" for NULL. A file is read by one task, because quoted
    values may hold line breaks: where none do, multiLine="false" lets Spark split large files.
    """
    return spark.read.schema(schema).option("sep", sep).options(**READ_OPTIONS).options(**options).csv(paths)


def write_delimited(df: DataFrame, path: str, sep: str = "|", **options: str) -> None:
    quoted = {"lineSep": "\n", **TEXT_OPTIONS}
    df.write.option("sep", sep).options(**quoted).options(**options).csv(path)


def headers(spark: SparkSession, paths: list[str], sep: str, threads: int = 16) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their header line. Only the first line of each file is read."""
    grouped = defaultdict(list)
    with ThreadPoolExecutor(threads) as pool:
        for path, line in zip(paths, pool.map(lambda p: _first_line(spark, p), paths)):
            grouped[tuple(c.strip('"') for c in line.split(sep))].append(path)
    return dict(grouped)


def _first_line(spark: SparkSession, path: str) -> str:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def read_mixed(spark: SparkSession, paths: list[str], types: dict[str, str], drop: list[str] | None = None,
               sep: str = "|") -> DataFrame:
    """Files with different headers: one read per distinct header, unwanted columns dropped, united by name.

    types gives the type of each known column; columns it does not name are read as text.
    """
    frames = []
    for header, files in sorted(headers(spark, paths, sep).items()):
        schema = T.StructType.fromDDL(", ".join(f"`{c}` {types.get(c, 'string')}" for c in header))
        frames.append(read_delimited(spark, files, schema, sep).drop(*(drop or [])))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_expected(spark: SparkSession, path: str, header: list[str], schema: T.StructType, sep: str = ",") -> DataFrame:
    """Records of a sheet export, refused when its schema lacks a column the caller counts on."""
    missing = [c for c in header if c not in schema.fieldNames()]
    if missing:
        raise ValueError(f"expected columns are missing: {missing}")
    return read_delimited(spark, path, schema, sep)


def redelimit(spark: SparkSession, source: str, target: str, schema: T.StructType, old: str = ",",
              new: str = "|") -> None:
    """Write the records again with another delimiter, to a path of their own."""
    write_delimited(read_delimited(spark, source, schema, old), target, new)
