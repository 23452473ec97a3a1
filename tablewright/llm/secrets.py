"""Secret scans with corpus-wide ownership frequency, in DataFrame expressions only.

Base patterns give spans of three kinds. The method adds further candidates, long tokens of letters and digits, and
counts for the hash of every candidate value how many distinct repositories and owners hold it. A value that many
owners or many repositories hold is a widely copied example; one that a single owner holds in few repositories looks
live; others are shared. Long tokens that look live become spans of kind `owned`; base spans always stay.

Null texts are empty. A null owner or repository counts as one more owner or repository. Repeated rows are scanned each
for itself and do not raise a value's frequencies. A value found in a third of all rows is reduced to its distinct
(owner, repository) pairs before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import stored, utf8

KINDS = ("assign", "access", "hex")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The matches of both classes are whole runs, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Long tokens; those without a digit or without a letter are no candidates.
LONG = r"[A-Za-z0-9_-]{24,}"
#: Owners or repositories from which on a value is a widely copied example, and up to which it looks live.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 4
LIVE_OWNERS, LIVE_REPOSITORIES = 1, 2


def found(text: Column, pattern: str, value: int = 0) -> Column:
    """All leftmost matches in order: start, stop (code points, stop exclusive) and the text of a group."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    between = F.split(text, pattern, -1)
    rows = F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("gap"), whole.alias("hit"), groups.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,value:string>>").alias("all"))

    def step(done, row):
        begin = done["at"] + F.length(row["gap"])
        stop = begin + F.length(row["hit"])
        span = F.struct(begin.alias("start"), stop.alias("stop"), row["value"].alias("value"))
        return F.struct(stop.alias("at"), F.array_append(done["all"], span).alias("all"))

    walked = F.aggregate(rows, start, step, lambda done: done["all"])
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast("array<struct<start:int,stop:int,value:string>>"))


def scanned(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """One row per document: base spans by kind and further candidates. Written out, so texts are scanned once."""
    text = utf8()
    return stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        owner.cast("string").alias("owner"), repository.cast("string").alias("repository"),
        F.filter(found(text, ASSIGN, 2), lambda s: F.length(s["value"]) >= 8).alias("assign"),
        found(text, ACCESS).alias("access"), found(text, HEX).alias("hex"),
        F.filter(found(text, LONG), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")).alias("long"),
        F.monotonically_increasing_id().alias("row")), "secrets")


def candidates(scan: DataFrame) -> DataFrame:
    """One row per candidate: row, kind, start, stop, hash of the value, owner, repository."""
    def tagged(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"),
                                                    s["stop"].alias("stop"), F.sha2(s["value"], 256).alias("hash")))

    everything = F.concat(*map(tagged, (*KINDS, "long")))
    return (scan.select("row", "owner", "repository", F.explode(everything).alias("c"))
            .select("row", "owner", "repository", "c.*"))


def frequencies(found_values: DataFrame) -> DataFrame:
    """Per value hash: distinct repositories and owners, and whether it is an example or looks live."""
    null_safe = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")).alias(c) for c in ("owner", "repository")]
    pairs = found_values.select("hash", *null_safe).groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    owners = pairs.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return (owners.groupBy("hash").agg(F.sum("repositories").alias("n_repositories"), F.count("*").alias("n_owners"))
            .withColumn("standing", F.when((F.col("n_owners") >= EXAMPLE_OWNERS) | (F.col("n_repositories") >= EXAMPLE_REPOSITORIES), "example")
                        .when((F.col("n_owners") <= LIVE_OWNERS) & (F.col("n_repositories") <= LIVE_REPOSITORIES), "live")
                        .otherwise("shared")))


def secrets(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """Per document: spans as an array of (kind, start, stop, standing), base spans and live long tokens.

    A long token inside a base span adds nothing.
    """
    scan = scanned(docs, owner, repository)
    all_found = candidates(scan)
    standing = frequencies(all_found)
    judged = all_found.select("row", "kind", "start", "stop", "hash").join(standing, "hash")
    spans = (judged.where((F.col("kind") != "long") | (F.col("standing") == "live"))
             .groupBy("row").agg(F.collect_list(F.struct("start", "kind", "stop", "standing")).alias("spans")))
    joined = scan.select("row", "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]).join(spans, "row", "left")
    everything = F.coalesce("spans", F.array().cast("array<struct<start:int,kind:string,stop:int,standing:string>>"))
    base = F.filter(everything, lambda s: s["kind"] != "long")
    outside = F.filter(everything, lambda s: (s["kind"] == "long") & ~F.exists(
        base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    rank = F.create_map(*[x for i, k in enumerate((*KINDS, "long")) for x in (F.lit(k), F.lit(i))])
    ordered = F.array_sort(F.transform(F.concat(base, outside), lambda s: F.struct(
        s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["stop"].alias("stop"),
        F.when(s["kind"] == "long", "owned").otherwise(s["kind"]).alias("kind"), s["standing"].alias("standing"))))
    return joined.select("doc_id", *[f"n_{k}" for k in KINDS], ordered.alias("spans"))


def digest(found_secrets: DataFrame) -> DataFrame:
    """Spans as text, the hash of the base ones, and how many look live or are examples."""

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def standing(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["standing"] == name)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "owned")
    return found_secrets.select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        standing("live").alias("n_live"), standing("example").alias("n_example"))


SQL = r"""
WITH d AS (SELECT doc_id, source AS owner, concat_ws('/', source, lang) AS repository, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT doc_id, owner, repository, 'assign' AS kind, 0 AS rank, regexp_extract_all(text, a, 0) AS hits,
    regexp_extract_all(text, a, 2) AS vals, string_split_regex(text, a) AS gaps
  FROM d, (SELECT '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS a)
  UNION ALL
  SELECT doc_id, owner, repository, kind, rank, regexp_extract_all(text, r), regexp_extract_all(text, r), string_split_regex(text, r)
  FROM d, (VALUES ('access', 1, 'AKIA[A-Z0-9]{12,}'), ('hex', 2, '[0-9a-f]{32,}'), ('long', 3, '[A-Za-z0-9_-]{24,}')) p(kind, rank, r)),
s AS (
  SELECT doc_id, owner, repository, kind, rank, hits[i] AS hit, vals[i] AS val,
    length(array_to_string(gaps[1:i], '')) + length(array_to_string(hits[1:i - 1], '')) AS b
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m)),
c AS (
  SELECT *, b + length(hit) AS e FROM s
  WHERE CASE kind WHEN 'assign' THEN length(val) >= 8
    WHEN 'long' THEN regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Za-z]') ELSE true END),
n AS (
  SELECT val, count(DISTINCT coalesce('=' || owner, '')) AS owners,
    count(DISTINCT {'o': coalesce('=' || owner, ''), 'r': coalesce('=' || repository, '')}) AS repositories FROM c GROUP BY val),
f AS (
  SELECT val, CASE WHEN owners >= 3 OR repositories >= 4 THEN 'example' WHEN owners <= 1 AND repositories <= 2 THEN 'live'
    ELSE 'shared' END AS standing FROM n),
k AS (
  SELECT c.*, standing FROM c JOIN f ON c.val = f.val
  WHERE kind <> 'long' OR (standing = 'live' AND NOT EXISTS (
    SELECT 1 FROM c AS o WHERE o.doc_id = c.doc_id AND o.kind <> 'long' AND o.b < c.e AND c.b < o.e))),
g AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) FILTER (kind <> 'long') AS base,
    string_agg(CASE kind WHEN 'long' THEN 'owned' ELSE kind END || ':' || b || ':' || e, ',' ORDER BY b, rank) AS spans,
    count(*) FILTER (standing = 'live') AS n_live, count(*) FILTER (standing = 'example') AS n_example
  FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""
