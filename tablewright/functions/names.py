"""Text of names and paths, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def table_part(file_name: Column) -> Column:
    """Everything before the first dot."""
    return F.substring_index(file_name, ".", 1)


def file_part(file_name: Column) -> Column:
    """Everything after the first dot."""
    return F.substring(file_name, F.instr(file_name, F.lit(".")) + F.lit(1), F.length(file_name))


def save_date(file_name: Column) -> Column:
    """YYYYMMDD taken from the last dotted piece before the first underscore."""
    pieces = F.split(F.substring_index(file_name, "_", 1), "[.]")
    return F.replace(F.element_at(pieces, -1), F.lit("-"), F.lit(""))


def archive_month(day_text: Column) -> Column:
    return F.substring(day_text, 1, 6)


def name_date(file_name: Column) -> Column:
    """Date in the fourth dotted piece (YYYY-MM-DD); NULL when it is not there."""
    piece = F.get(F.split(file_name, "[.]"), F.lit(3))
    return F.to_date(F.try_to_timestamp(F.substring(piece, 1, 10), F.lit("yyyy-MM-dd")))


def normalised(name: Column) -> Column:
    return F.lower(F.replace(name, F.lit(" "), F.lit("")))


def hive_path(file_name: Column, **layers: Column) -> Column:
    """k1=v1/k2=v2/file, in the order given."""
    pieces = [F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in layers.items()]
    return F.concat_ws("/", *pieces, file_name)


def qualified(layer: str, table: str, suffix: str | None = None) -> str:
    return f"{layer}.{table}{'_' + suffix if suffix else ''}".lower()


def qualified_column(layer: Column, table: Column, suffix: Column | None = None) -> Column:
    name = table if suffix is None else F.concat_ws("_", table, suffix)
    return F.lower(F.concat_ws(".", layer, name))


def strip_leading_set(text: Column, characters: str) -> Column:
    """Drop leading characters as long as they are members of the set (not a prefix match)."""
    return F.ltrim(text, F.lit(characters))
