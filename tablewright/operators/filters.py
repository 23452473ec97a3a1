"""Row filters: incremental windows, active rows, per-dataset rules, names."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions import times
from tablewright.schemas import dataset_name

# Which request rules hold for which dataset.
DATASET_RULES = {
    "appointments": ("since",),
    "calls": ("after", "active"),
    "customers": ("active",),
    "tag-types": ("active",),
    "invoices": ("since",),
    "jobs": ("since",),
    "memberships": ("since", "active"),
}
NAME_MARKS = ("all.", "cr", "upd", "del")
# End of fixed values.


def modified_after(df: DataFrame, column: str, as_of: date) -> DataFrame:
    return df.where(times.after_yesterday(F.col(column), as_of))


def modified_since(df: DataFrame, column: str, as_of: date) -> DataFrame:
    return df.where(times.since_yesterday(F.col(column), as_of))


def active_only(df: DataFrame, column: str = "active") -> DataFrame:
    return df.where(F.col(column))


def dataset_rules(alias: str, as_of: date, modified: str = "modifiedOn", active: str = "active") -> list[Column]:
    rules = {
        "after": times.after_yesterday(F.col(modified), as_of),
        "since": times.since_yesterday(F.col(modified), as_of),
        "active": F.col(active),
    }
    return [rules[r] for r in DATASET_RULES[dataset_name(alias)]]


def incremental(df: DataFrame, alias: str, as_of: date, modified: str = "modifiedOn",
                active: str = "active") -> DataFrame:
    """Rows a pull of the dataset asks for on the given day."""
    return reduce(DataFrame.where, dataset_rules(alias, as_of, modified, active), df)


def misnamed(name: Column) -> Column:
    """True for a file name that carries none of the marks of a known load type."""
    return ~reduce(lambda a, b: a | b, [F.contains(name, F.lit(m)) for m in NAME_MARKS])


def with_token(df: DataFrame, column: str, token: str) -> DataFrame:
    return df.where(F.contains(F.col(column), F.lit(token)))


def without_token(df: DataFrame, column: str, token: str) -> DataFrame:
    return df.where(~F.contains(F.col(column), F.lit(token)))


def random_sample(df: DataFrame, fraction: float, seed: int, key: str | None = None) -> DataFrame:
    """About a fraction of the rows. With a key the same rows every time: those whose hash of key and seed is low."""
    if key is None:
        return df.where(F.rand(seed) <= fraction)
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    return df.where(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < int(fraction * (1 << 32)))
