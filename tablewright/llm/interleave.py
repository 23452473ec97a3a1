"""Sharding by proportional stratified interleaving.

The rows of every source are put in a seeded order and ranked; rank r of n rows stands at the fraction (r + phase) / n,
where the phase, between 0 and 1, belongs to source and seed and keeps small sources from all standing in the middle.
Sorted by fraction, each source is spread evenly over the whole list, so cutting the list into equal runs gives shards
that hold the mixture: a source's rows in a shard differ from its share by less than two, and the shards' row counts
by one at most (the law `rows`).

Two exchanges carry the rows. The first sorts them by source and seeded order into ranges, so a source that holds a third
of the rows, or equal rows that do, lies over many tasks; ranks come from counts per range and source. The second deals
rows by their fraction: fractions are evenly spread by construction, so its parts are equal without a sample. Shards
are runs of these parts. The driver sees one count per part, nothing that grows with documents or sources.

The seeded order depends on doc_id, text and seed; rows alike in both are interchangeable. A null source is a source of
its own, null doc_ids count as empty ones, a null text has no bytes. Columns named shard or slot are replaced, others stay,
whatever their names. An empty table gives no rows; with fewer rows than shards some shards are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import parts, stored
from tablewright.operators.rowids import free_name, offsets, ranged

SHARDS, SEED, LAW = 16, "shard-1", "rows"


def _hashed(text: Column, digits: int = 15) -> Column:
    """The first hexadecimal digits of the MD5 as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def _fraction(seed: str, source: Column, rank: Column, n: Column) -> Column:
    phase = _hashed(F.concat(source, F.lit(f":{seed}")), 12).cast("double") / float(1 << 48)
    return (rank.cast("double") + phase) / n.cast("double")


def placed(docs: DataFrame, shards: int = SHARDS, seed: str = SEED, source: str = "source", key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with their shard (from 0) and their slot in it (from 0), in files of consecutive slots."""
    spark, docs = docs.sparkSession, docs.drop("shard", "slot")
    stratum, order, tie, part, place = (free_name(docs, n) for n in ("__stratum", "__order", "__tie", "__part", "__place"))
    first, before, n, fraction, run, offset = (free_name(docs, x) for x in ("__first", "__before", "__n", "__fraction", "__run", "__offset"))
    rows = docs.withColumns({
        stratum: F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")),
        order: _hashed(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}"))),
        tie: _hashed(F.coalesce(F.col(text), F.lit("")))})
    rows = ranged(rows, [F.col(c) for c in (stratum, order, tie)], part, place)

    # Ranks: a source's rows in the ranges before, plus the place among those of its own range.
    ahead = Window.partitionBy(stratum).orderBy(part)
    counts = rows.groupBy(part, stratum).agg(F.min(place).alias(first), F.count("*").alias("count"))
    strata = stored(counts.select(
        part, stratum, first, (F.sum("count").over(ahead) - F.col("count")).alias(before),
        F.sum("count").over(Window.partitionBy(stratum)).alias(n)), "shard_strata")
    buckets = parts(spark)
    at = rows.join(strata, [part, stratum]).withColumn(
        fraction, _fraction(seed, F.col(stratum), F.col(before) + F.col(place) - F.col(first), F.col(n)))
    at = at.withColumn(run, F.least(F.floor(F.col(fraction) * buckets), F.lit(buckets - 1)).cast("int"))

    counted = {r[0]: r[1] for r in at.groupBy(run).count().collect()}
    total = sum(counted.values())
    dealt = at.repartitionById(buckets, F.col(run)).withColumn(
        place, F.row_number().over(Window.partitionBy(run).orderBy(fraction, stratum)) - 1)
    position = F.col(offset) + F.col(place)
    shard = F.expr(f"(`{offset}` + `{place}`) * {shards} div {max(total, 1)}")
    return (dealt.join(offsets(spark, counted, run, offset), run)
            .withColumn("shard", shard.cast("int"))
            .withColumn("slot", position - F.ceil(F.col("shard").cast("decimal(20,0)") * total / shards).cast("long"))
            .select(*docs.columns, "shard", "slot"))


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, seed: str = SEED, **columns: str) -> None:
    """One folder shard=k per shard, whose files hold consecutive slots in order."""
    (placed(docs, shards, seed, **columns).sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").partitionBy("shard").parquet(folder))


def mixture(docs: DataFrame, source: str = "source") -> DataFrame:
    """source, shard, rows, and the rows a shard of its size would hold by the source's share of the placed documents."""
    cells = stored(docs.groupBy(F.col(source).alias("source"), "shard").agg(F.count("*").alias("rows")), "shard_mixture")
    per_shard = cells.groupBy("shard").agg(F.sum("rows").alias("size"))
    per_source = cells.groupBy(F.col("source").alias("same")).agg(F.sum("rows").alias("of"))
    total = cells.agg(F.sum("rows")).first()[0] or 1
    return (cells.join(per_source, F.col("source").eqNullSafe(F.col("same"))).join(per_shard, "shard")
            .select("source", "shard", "rows", (F.col("of") * F.col("size") / total).alias("expected")))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of the placed documents."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return placed(docs).select(
        "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.lit(LAW).alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: CRC-32 by its table, byte by byte; the table is made from the reversed polynomial.
_CRC = r"""
crc_table AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(k, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY k) AS t
  FROM range(256) r(k))"""

SQL = rf"""
WITH {_CRC},
d AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS body, coalesce('=' || source, '') AS stratum,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}'), 1, 15))::BIGINT AS o,
    ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS tie
  FROM documents),
r AS MATERIALIZED (
  SELECT doc_id, body, stratum, row_number() OVER (PARTITION BY stratum ORDER BY o, tie) - 1 AS rank, count(*) OVER (PARTITION BY stratum) AS n FROM d),
p AS MATERIALIZED (
  SELECT doc_id, body, row_number() OVER (ORDER BY (rank::DOUBLE
      + ('0x' || substr(md5(stratum || ':{SEED}'), 1, 12))::BIGINT::DOUBLE / 281474976710656.0) / n::DOUBLE, stratum) - 1 AS position,
    count(*) OVER () AS total
  FROM r),
s AS (SELECT *, position * {SHARDS} // total AS shard FROM p)
SELECT doc_id, octet_length(encode(body))::BIGINT + 1 AS size,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32,
  '{LAW}' AS law, shard::INTEGER AS shard, (position - (shard * total + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM s, crc_table
"""
