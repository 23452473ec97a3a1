"""Arrays, maps, JSON and record text to flat rows, as expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import records
from tablewright.schemas import (CALL_DEEP_KEYS, CALL_SHALLOW_KEYS, ITEM_KEYS, ITEM_NESTED_KEYS, call_schema,
                                 invoice_item_schema)


def explode_ids(df: DataFrame, array: str, name: str, **kept: str) -> DataFrame:
    """One link row per element; empty and NULL arrays give none. kept maps new names to columns."""
    return df.select(*[F.col(source).alias(new) for new, source in kept.items()], F.explode(array).alias(name))


def explode_document(df: DataFrame, text: str, schema: T.StructType, array: str, order: str) -> DataFrame:
    """Elements of an array inside JSON documents, sorted by one of their fields."""
    return (df.select(F.explode(F.from_json(text, schema)[array]).alias(array))
            .select(f"{array}.*").orderBy(order))


def json_map(column: Column) -> Column:
    return F.from_json(column, T.MapType(T.StringType(), T.StringType()))


def explode_profiles(df: DataFrame, account: str, outer: str, inner: str) -> DataFrame:
    """One row per profile of accounts that hold properties that hold profiles; empty levels give no rows."""
    return (df.select(F.col(f"{account}.id").alias("id"), F.col(f"{account}.name").alias("Account"),
                      F.explode(f"{account}.{outer}").alias("p"))
            .select("id", "Account", F.col("p.name").alias("webProperty"), F.explode(f"p.{inner}").alias("v"))
            .select("id", "Account", "webProperty", F.col("v.name").alias("View"), F.col("v.id").alias("viewId")))


def parse_items(df: DataFrame, items: str = "items", invoice_id: str = "id", rejected: str | None = None) -> DataFrame:
    """One row per item of [{k=v, ...}, {...}] texts; rows without items give none.

    Keys are found at the item's own level, in any order and with any missing, so an item's type is not mixed up with the
    type inside one of its accounts. `rejected` names a column for the text of items that do not begin with a known key.
    """
    inside = records.unbraced(F.col(items), "[{", "}]")
    pieces = (df.where(F.col(items).isNotNull())
              .select(F.col(invoice_id).alias("invoiceId"), "tenantId", F.explode(F.split(inside, "\\}, \\{")).alias("item")))
    cut = pieces.withColumn("own", records.pieces(F.col("item")))
    own = cut.withColumn("own", records.in_order(F.col("item"), F.col("own"), ITEM_KEYS))
    texts = {k: records.value_at(F.col("own"), ITEM_KEYS, k) for k in ITEM_KEYS}
    inside = {f"of_{k}": F.nullif(texts[k], F.lit("null")) for k in ITEM_NESTED_KEYS}
    inner = own.withColumns(inside).withColumns({f"of_{k}": records.unbraced(F.col(f"of_{k}")) for k in ITEM_NESTED_KEYS})
    inner = inner.withColumns({f"in_{k}": records.pieces(F.col(f"of_{k}")) for k in ITEM_NESTED_KEYS})
    inner = inner.withColumns({f"in_{k}": records.in_order(F.col(f"of_{k}"), F.col(f"in_{k}"), keys) for k, keys in ITEM_NESTED_KEYS.items()})
    flat = {k: t for k, t in texts.items() if k not in ITEM_NESTED_KEYS}
    flat |= {f"{k}_{sub}": records.value_at(F.col(f"in_{k}"), keys, sub) for k, keys in ITEM_NESTED_KEYS.items() for sub in keys}
    # The word null stands for NULL.
    shown = [F.nullif(flat[c], F.lit("null")).alias(c) if c in flat else F.col(c) for c in invoice_item_schema().fieldNames()]
    return inner.select(*shown, *([records.rejected(F.col("item"), F.col("own")).alias(rejected)] if rejected else []))


def shallow_keys(df: DataFrame, column: str = "leadCall", keys: tuple[str, ...] = CALL_SHALLOW_KEYS) -> DataFrame:
    return df.withColumns({f"{column}_{k}": F.col(column)[k] for k in keys})


def deep_keys(df: DataFrame, column: str, parts: dict[str, tuple[str, ...]], rejected: str | None = None) -> DataFrame:
    """Entries of a map that hold {k=v, ...} text, as <column>_<entry>_<key> columns.

    `rejected` names a column for the texts, by entry, that do not begin with a known key.
    """
    texts = {part: F.col(f"__text_{part}") for part in parts}
    plain = {f"__text_{part}": records.unbraced(records.tidy(F.col(column)[part])) for part in parts}
    parsed = {f"__{part}": records.pieces(texts[part]) for part in parts}
    ordered = {f"__{part}": records.in_order(texts[part], F.col(f"__{part}"), keys) for part, keys in parts.items()}
    flat = {f"{column}_{part}_{k}": records.value_at(F.col(f"__{part}"), keys, k) for part, keys in parts.items() for k in keys}
    if rejected:
        entries = F.map_from_arrays(F.array(*map(F.lit, parts)), F.array(*[records.rejected(t, F.col(f"__{p}")) for p, t in texts.items()]))
        flat[rejected] = F.map_filter(entries, lambda _, v: v.isNotNull())
    return df.withColumns(plain).withColumns(parsed).withColumns(ordered).withColumns(flat).drop(*plain, *parsed)


def parse_calls(df: DataFrame) -> DataFrame:
    """Call records with every known entry of the call map as a column of its own."""
    wide = deep_keys(shallow_keys(df), "leadCall", CALL_DEEP_KEYS)
    return wide.select(*call_schema().fieldNames())
