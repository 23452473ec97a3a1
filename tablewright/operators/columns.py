"""Column-level shaping: metadata stamps, conforming to a schema, maps to columns, fills."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import times


def append_metadata(df: DataFrame, as_of: date | None = None, **metadata: object) -> DataFrame:
    """Add a text column __<key> per entry and the load day __Date (US Central today unless given)."""
    day = F.lit(as_of).cast("date") if as_of else times.central_today()
    return df.withColumns({**{f"__{k}": F.lit(str(v)) for k, v in metadata.items()}, "__Date": day})


def add_context(df: DataFrame, **values: object) -> DataFrame:
    """Add literal columns under their own names."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def load_date(df: DataFrame, column: str, name: str = "__Date") -> DataFrame:
    """Day taken from a timestamp text; NULL where the text is no timestamp."""
    return df.withColumn(name, times.timestamp_date(F.col(column)))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the schema's fields, cast to its types; fields the frame lacks become NULL.

    Names match without regard to case, as Spark's own do; of several the one spelled alike is taken.
    """
    loose = {f.name.lower(): f for f in reversed(df.schema.fields)}
    exact = {f.name: f for f in df.schema.fields}
    return df.select(*[_conformed(f, exact.get(f.name) or loose.get(f.name.lower())) for f in schema.fields])


def _conformed(field: T.StructField, source: T.StructField | None) -> Column:
    if source is None:
        return F.lit(None).cast(field.dataType).alias(field.name)
    column = F.col(f"`{source.name}`")
    return (column if source.dataType == field.dataType else column.try_cast(field.dataType)).alias(field.name)


def flatten_maps(df: DataFrame, keys: dict[str, tuple[str, ...]], types: dict[str, str] | None = None) -> DataFrame:
    """Replace map columns by one column <map>_<key> per key, cast where a type is given."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    flat = []
    for name, subkeys in keys.items():
        for key in subkeys:
            target = f"{name}_{key}"
            value = F.col(name)[key]
            flat.append((value.try_cast(types[target]) if types and target in types else value).alias(target))
    return df.select(*kept, *flat)


def extract_keys(df: DataFrame, column: str, names: dict[str, str]) -> DataFrame:
    """Add map entries as columns, keeping the map; columns that exist already stay as they are."""
    return df.withColumns({new: F.col(column)[key] for key, new in names.items() if new not in df.columns})


def fill_ids(df: DataFrame, columns: tuple[str, ...], target: str = "bigint") -> DataFrame:
    """NULL becomes 0, the column an integer."""
    return df.withColumns({c: F.coalesce(F.col(c).try_cast(target), F.lit(0).cast(target)) for c in columns})


def add_null_columns(df: DataFrame, columns: str | list[str]) -> DataFrame:
    names = [columns] if isinstance(columns, str) else columns
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in names])
