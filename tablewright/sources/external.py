"""External SQL sources through any Spark reader that takes a query (jdbc and the like)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ReadRange:
    """Split of a remote table by a numeric or date column, so that many tasks read it."""

    column: str
    lower: object
    upper: object
    partitions: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": str(self.lower), "upperBound": str(self.upper),
                "numPartitions": str(self.partitions)}


@dataclass(frozen=True)
class ExternalSource:
    spark: SparkSession
    format: str
    options: dict[str, str] = field(default_factory=dict)

    def _reader(self, **extra: str) -> DataFrameReader:
        return self.spark.read.format(self.format).options(**self.options, **extra)

    def query(self, text: str) -> DataFrame:
        """Rows of a query the source runs itself."""
        return self._reader(query=text).load()

    def table(self, name: str, split: ReadRange | None = None) -> DataFrame:
        """A remote table; filters and columns chosen later are pushed to the source."""
        return self._reader(dbtable=name, **(split.options() if split else {})).load()

    def ping(self, text: str = "SELECT 1 AS one") -> bool:
        """Whether the source answers a trivial query."""
        try:
            self.query(text).limit(1).collect()
            return True
        except Exception:
            return False

    def tables(self, catalog_table: str = "INFORMATION_SCHEMA.TABLES") -> DataFrame:
        """schema.table names of the source, without its information schema."""
        listed = self.table(catalog_table)
        return (listed.where(F.upper("TABLE_SCHEMA") != "INFORMATION_SCHEMA")
                .select(F.concat_ws(".", "TABLE_SCHEMA", "TABLE_NAME").alias("table_name")))

    def columns(self, table: str, catalog_table: str = "INFORMATION_SCHEMA.COLUMNS") -> DataFrame:
        """Name, type, ordinal and nullability of a table's columns, in order."""
        return (self.table(catalog_table).where(F.col("TABLE_NAME") == table.upper())
                .select("COLUMN_NAME", "DATA_TYPE", "ORDINAL_POSITION", "IS_NULLABLE").orderBy("ORDINAL_POSITION"))
