"""Value conversions: loose type names and text flags."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fragments of loose type names, first hit wins.
LOOSE_TYPES = (
    (("bit",), "binary"),
    (("bool",), "boolean"),
    (("decimal", "numeric"), "decimal(10,0)"),
    (("double", "money"), "double"),
    (("float",), "float"),
    (("int", "long"), "bigint"),
    (("char", "date", "string", "time"), "string"),
)
TRUE_WORDS = ("true", "yes", "1")
# End of fixed values.


def spark_type(name: str) -> str:
    """Spark type for a loose type name; decimal(p,s) and numeric(p,s) keep their digits."""
    text = name.strip().lower()
    exact = re.fullmatch(r"(?:decimal|numeric)\((\d+),(\d+)\)", text.replace(" ", ""))
    if exact:
        return f"decimal({exact[1]},{exact[2]})"
    return next((target for parts, target in LOOSE_TYPES if any(p in text for p in parts)), "string")


def cast_by_name(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns to loosely named types; values that do not fit become NULL."""
    known = df.schema
    return df.withColumns({c: _safe_cast(F.col(f"`{c}`"), known[c].dataType, spark_type(t)) for c, t in types.items()})


def _safe_cast(column: Column, source: T.DataType, target: str) -> Column:
    if target == "binary" and not isinstance(source, (T.StringType, T.BinaryType)):
        return column.cast("string").cast("binary")
    return column.try_cast(target)


def flag_from_text(column: Column) -> Column:
    return F.lower(column).isin(*TRUE_WORDS)
