"""Upsert as a pure DataFrame function.

A target row takes the source row with its key; a source row without a partner is inserted. NULL keys never
match. The merged rows have the target's columns and types; columns the target lacks are refused. The plan has one
shape: Spark's own estimates decide whether the source is broadcast, so that the target stays where it is, or both
sides are shuffled with the target on the side that AQE may split when a key is hot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALL = "all"
KEY_TYPES = (T.LongType, T.FloatType, T.StringType)


class DuplicateKeys(ValueError):
    pass


class UnknownColumns(ValueError):
    pass


def infer_keys(declared: T.StructType) -> list[str]:
    """Required long, float and string fields of a declared schema.

    Readers report every column as nullable, so the keys come from the declaration, never from a frame.
    """
    return [f.name for f in declared.fields if not f.nullable and isinstance(f.dataType, KEY_TYPES)]


def infer_updates(columns: list[str], keys: list[str]) -> list[str]:
    return [c for c in columns if c not in keys]


def as_list(names: str | list[str] | None) -> list[str]:
    return [] if names is None else [names] if isinstance(names, str) else list(names)


def check_unique(source: DataFrame, keys: list[str]) -> None:
    """A key that occurs twice in the source would match a target row twice: refuse it before any write."""
    repeated = source.where(_present(keys)).groupBy(*keys).count().where("count > 1").select(*keys)
    if not repeated.isEmpty():
        raise DuplicateKeys(f"source holds a merge key more than once, e.g. {repeated.first().asDict()}")


def upsert(target: DataFrame, source: DataFrame, keys: str | list[str], update: str | list[str] | None = ALL,
           check: bool = True, order: str | None = None) -> DataFrame:
    """Target after the merge. update: ALL (every non-key column), a column, a list, or None to insert only.

    With `order`, a match updates a row only if its order is later than the one the target holds; NULL comes before all
    others. So changes may arrive late, twice or in any order. The order itself is among the updated columns.
    """
    source, spelled = _named_as(target, source), {c.lower(): c for c in target.columns}
    keys = [spelled.get(k.lower(), k) for k in as_list(keys)]
    updates = infer_updates(source.columns, keys) if update == ALL else [spelled.get(c.lower(), c) for c in as_list(update)]
    order = spelled.get(order.lower(), order) if order else None
    if order and updates and order not in updates:
        updates.append(order)
    unknown = [c for c in [*keys, *updates] if c not in source.columns]
    if unknown:
        raise UnknownColumns(f"the source has no column {unknown}")
    if check:
        check_unique(source, keys)
    merged = _updated(target, source, keys, updates, order) if updates else target
    new = inserts(target, source, keys)
    return merged.unionByName(new.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in new.columns
                                           else F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields]))


def _named_as(target: DataFrame, source: DataFrame) -> DataFrame:
    """The source with its columns spelled as in the target, which must have them all."""
    spelled = {c.lower(): c for c in target.columns}
    unknown = [c for c in source.columns if c.lower() not in spelled]
    if unknown:
        raise UnknownColumns(f"the target has no column {unknown}")
    return source.select(*[F.col(f"`{c}`").alias(spelled[c.lower()]) for c in source.columns])


def inserts(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target does not hold. Rows with a NULL key go around the join, not through one task."""
    keyed = source.where(_present(keys))
    # The semi join leaves only the few target keys that match to be made distinct and compared.
    held = target.select(*keys).join(keyed.select(*keys), keys, "left_semi")
    new = keyed.join(held.distinct(), keys, "left_anti").select(*source.columns)
    return new.unionByName(source.where(~_present(keys)))


def later(new: Column, held: Column) -> Column:
    """The new order comes after the one that is held."""
    return new.isNotNull() & (held.isNull() | (new > held))


def _updated(target: DataFrame, source: DataFrame, keys: list[str], updates: list[str], order: str | None) -> DataFrame:
    new = source.where(_present(keys)).select(
        *[F.col(k).alias(f"__key_{k}") for k in keys],
        *[F.col(c).alias(f"__new_{c}") for c in updates],
        F.lit(True).alias("__found"))
    joined = target.join(new, [target[k] == new[f"__key_{k}"] for k in keys], "left")
    wins = F.col("__found")
    if order:
        wins = wins & later(F.col(f"__new_{order}").cast(target.schema[order].dataType), target[order])
    return joined.select(*[_value(c, target, wins, c in updates) for c in target.columns])


def _value(name: str, target: DataFrame, wins: Column, updated: bool) -> Column:
    if not updated:
        return target[name]
    return F.when(wins, F.col(f"__new_{name}").cast(target.schema[name].dataType)).otherwise(
        target[name]).alias(name)


def _present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
