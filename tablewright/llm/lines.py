"""Incremental line deduplication: sharded cuckoo filters backed by exact reference-count tables.

The index holds three tables. `postings` has each line key once per document that holds it; `counts` has the exact
number of documents and the smallest doc_id of each key; `filters` has a cuckoo filter per shard with the keys that at
least two documents hold. Documents can be inserted and deleted: only touched keys are counted anew and only touched
shards change their filter, by inserting and deleting fingerprints. Deduplication asks the filter first and confirms
what it lets through with the exact counts, so a false positive never drops a line.

Null and empty texts are one empty line. Rows with the same doc_id count as one document. A null doc_id counts as a
document that comes after all others. Keys are 128-bit hashes of the stripped, lower-cased line.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import parts, stored, utf8
from tablewright.llm.cuckoo import CuckooFilter

LEAST_CHARS = 10
#: Keys per shard and probes per task that a filter is sized for.
SHARD_KEYS, TASK_PROBES = 50_000, 100_000
BLANK = " \t\n\x0b\x0c\r"
LAST_ID = (1 << 63) - 1
KEY = ("hi", "lo")


@dataclass
class LineIndex:
    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int


def line_array(text: str = "text") -> Column:
    return F.split(utf8(text), "\n", -1)


def key_of(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(BLANK))
    return F.translate(stripped, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines_of(docs: DataFrame) -> DataFrame:
    """Lines that count: row (hash of the document's row), did, line number from 0, key."""
    numbered = docs.select(
        F.xxhash64("doc_id", "text").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("did"),
        F.posexplode(line_array()).alias("line", "raw"))
    return (numbered.select("row", "did", "line", key_of(F.col("raw")).alias("key"))
            .where(F.length("key") >= LEAST_CHARS)
            .select("row", "did", "line", F.xxhash64("key").alias("hi"), F.xxhash64(F.lit(7), F.reverse("key")).alias("lo")))


def _counted(postings: DataFrame) -> DataFrame:
    return postings.groupBy(*KEY).agg(F.count("*").alias("refs"), F.min("did").alias("first"))


def _shard(shards: int) -> Column:
    return F.pmod(F.col("hi"), F.lit(shards)).cast("int")


def _filters(counts: DataFrame, shards: int) -> DataFrame:
    def build(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["lo"].to_numpy(np.int64).view(np.uint64)
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "filter": [CuckooFilter.build(keys).dump()]})

    return (counts.where("refs >= 2").select(_shard(shards).alias("shard"), "lo")
            .groupBy("shard").applyInPandas(build, "shard int, filter binary"))


def build(lines: DataFrame) -> LineIndex:
    """Index of the lines of `lines_of`."""
    postings = stored(lines.groupBy(*KEY, "did").agg(F.count("*").alias("n")).drop("n"), "line_postings")
    counts = stored(_counted(postings), "line_counts")
    repeated = counts.where("refs >= 2").count()
    shards = max(parts(lines.sparkSession), -(-repeated // SHARD_KEYS))
    return LineIndex(postings, counts, stored(_filters(counts, shards), "line_filters"), shards)


def _changed(index: LineIndex, postings: DataFrame, touched: DataFrame) -> LineIndex:
    """The index over new postings, where only the touched keys can have other counts."""
    keys = touched.select(*KEY).distinct()
    fresh = stored(_counted(postings.join(keys, list(KEY), "left_semi")), "line_fresh")
    counts = stored(index.counts.join(keys, list(KEY), "left_anti").unionByName(fresh), "line_counts")
    before = index.counts.join(keys, list(KEY), "left_semi").where("refs >= 2").select(*KEY, F.lit(True).alias("was"))
    after = fresh.where("refs >= 2").select(*KEY, F.lit(True).alias("now"))
    moves = (before.join(after, list(KEY), "full")
             .select(_shard(index.shards).alias("shard"), "hi", "lo", F.col("was").isNotNull().alias("was"), F.col("now").isNotNull().alias("now"))
             .where("was <> now"))
    exact = counts.where("refs >= 2").select(_shard(index.shards).alias("shard"), "lo")

    def change(held: pd.DataFrame, moved: pd.DataFrame) -> pd.DataFrame:
        shard = int((held if len(held) else moved)["shard"].iloc[0])
        made = CuckooFilter.load(held["filter"].iloc[0]) if len(held) else CuckooFilter.build(np.empty(0, np.uint64))
        keys = moved["lo"].to_numpy(np.int64).view(np.uint64)
        made.delete(keys[moved["was"].to_numpy(bool)])
        new = keys[moved["now"].to_numpy(bool)]
        full = bool(len(new)) and not made.insert(new)
        return pd.DataFrame({"shard": [shard], "filter": [None if full else made.dump()]})

    changed = stored(index.filters.groupBy("shard").cogroup(moves.groupBy("shard"))
                     .applyInPandas(change, "shard int, filter binary"), "line_changed")
    full = changed.where("filter IS NULL").select("shard")

    def rebuild(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["lo"].to_numpy(np.int64).view(np.uint64)
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "filter": [CuckooFilter.build(keys).dump()]})

    rebuilt = exact.join(full, "shard", "left_semi").groupBy("shard").applyInPandas(rebuild, "shard int, filter binary")
    filters = stored(changed.where("filter IS NOT NULL").unionByName(rebuilt), "line_filters")
    return LineIndex(postings, counts, filters, index.shards)


def insert(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with more documents; documents it already holds change nothing."""
    held = lines_of(docs).select(*KEY, "did").distinct()
    new = stored(held.join(index.postings, [*KEY, "did"], "left_anti"), "line_new")
    return _changed(index, stored(index.postings.unionByName(new), "line_postings"), new)


def delete(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """The index without the documents whose doc_id is given."""
    gone = doc_ids.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("did")).distinct()
    lost = stored(index.postings.join(gone, "did", "left_semi").select(*KEY, "did"), "line_lost")
    left = stored(index.postings.join(gone, "did", "left_anti").select(*KEY, "did"), "line_postings")
    return _changed(index, left, lost)


def repeated_lines(index: LineIndex, lines: DataFrame) -> DataFrame:
    """row, did, line of the lines to drop. The filters answer first, the exact counts decide."""
    sharded = lines.select("*", _shard(index.shards).alias("shard"))
    largest = sharded.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    salts = 1 + largest // TASK_PROBES
    dealt = sharded.withColumn("salt", F.pmod(F.xxhash64("row", "line"), F.lit(salts)).cast("int"))
    copies = index.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def probe(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        columns = ["row", "did", "line", "hi", "lo"]
        if not len(held) or not len(asked):
            return asked[columns].iloc[:0]
        maybe = CuckooFilter.load(held["filter"].iloc[0]).contains(asked["lo"].to_numpy(np.int64).view(np.uint64))
        return asked.loc[maybe, columns]

    maybe = (dealt.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
             .applyInPandas(probe, "row long, did long, line int, hi long, lo long"))
    return maybe.join(index.counts.where("refs >= 2"), list(KEY)).where("did <> first").select("row", "did", "line")


def deduplicated(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text of the lines that stay."""
    gone = drops.distinct().groupBy("row", "did").agg(F.collect_list("line").alias("gone"))
    whole = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("did"))
    rows = whole.join(gone, ["row", "did"], "left").select("doc_id", line_array().alias("lines"), "gone", "text")
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")))
    text = F.when(F.col("gone").isNull(), utf8()).otherwise(
        F.array_join(F.transform(stay, lambda i: F.element_at("lines", i + 1)), "\n"))
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), text.alias("text"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """Build the index over the documents and drop their repeated lines."""
    lines = stored(lines_of(docs), "lines")
    return deduplicated(docs, stored(repeated_lines(build(lines), lines), "line_drops"))


SQL = r"""
WITH l AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
k AS (SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT l.doc_id, l.i, l.line, k.key IS NOT NULL AND l.doc_id <> k.first AS gone FROM l LEFT JOIN k ON l.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
