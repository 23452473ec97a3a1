"""Registered queries: joins and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import bucketed, joins, merge, profile, tables
from tablewright.registry.common import Registry, load
from tablewright.session import work_database, work_folder
from tablewright.streaming import upserts

registry = Registry()

# The target holds the orders up to 1999, the source those from 1997 on with new prices and some NULLs.
TARGET_SQL = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderdate < timestamp '1999-01-01'"
SOURCE_SQL = """select o_orderkey, o_custkey, nullif(o_orderstatus, 'P') as o_orderstatus,
    o_totalprice * 2 as o_totalprice from orders where o_orderdate >= timestamp '1997-01-01'"""
UPSERT_SQL = f"""
    select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey, coalesce(s.o_custkey, t.o_custkey) as o_custkey,
           case when s.o_orderkey is not null then s.o_orderstatus else t.o_orderstatus end as o_orderstatus,
           case when s.o_orderkey is not null then s.o_totalprice else t.o_totalprice end as o_totalprice
    from ({TARGET_SQL}) t full join ({SOURCE_SQL}) s on s.o_orderkey = t.o_orderkey"""
FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def instant(text: str):
    return F.lit(text).cast("timestamp_ntz")


def target(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").where(F.col("o_orderdate") < instant("1999-01-01")).select(*FIELDS)


def source(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").where(F.col("o_orderdate") >= instant("1997-01-01")).select(
        "o_orderkey", "o_custkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        (F.col("o_totalprice") * 2).alias("o_totalprice"))


registry.add("merge_upsert", UPSERT_SQL)(
    lambda spark, sf: merge.upsert(target(spark, sf), source(spark, sf), "o_orderkey", ["o_orderstatus", "o_totalprice"]))

registry.add("merge_insert_only", f"""
    {TARGET_SQL} union all select * from ({SOURCE_SQL}) where o_orderkey not in (select o_orderkey from ({TARGET_SQL}))""")(
    lambda spark, sf: merge.upsert(target(spark, sf), source(spark, sf), "o_orderkey", None))

DECLARED = T.StructType([
    T.StructField("o_orderkey", T.LongType(), False), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType())])
registry.add("merge_infer_keys", UPSERT_SQL)(
    lambda spark, sf: merge.upsert(target(spark, sf), source(spark, sf), merge.infer_keys(DECLARED), ["o_orderstatus", "o_totalprice"]))

registry.add("merge_infer_updates", UPSERT_SQL)(
    lambda spark, sf: merge.upsert(target(spark, sf), source(spark, sf), "o_orderkey"))


@registry.add("merge_create", UPSERT_SQL)
def merge_create(spark: SparkSession, sf: str) -> DataFrame:
    """The first merge creates the table, the second changes it, repeating the second changes nothing."""
    name = f"{work_database(spark, 'merge')}.orders"
    tables.upsert_table(target(spark, sf), name, "o_orderkey")
    tables.upsert_table(source(spark, sf), name, "o_orderkey")
    tables.upsert_table(source(spark, sf), name, "o_orderkey")
    return spark.table(name)


@registry.add("merge_partitioned", UPSERT_SQL)
def merge_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Merge into a table partitioned by a column outside the key: only touched partitions are rewritten."""
    name = f"{work_database(spark, 'merge')}.orders"
    nation = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))

    def placed(df: DataFrame) -> DataFrame:
        return df.join(nation, "o_custkey", "left").select(*FIELDS, "nation")

    tables.upsert_table(placed(target(spark, sf)), name, "o_orderkey", partition_by=["nation"])
    tables.upsert_table(placed(source(spark, sf)), name, "o_orderkey", ["o_orderstatus", "o_totalprice"])
    return spark.table(name).select(*FIELDS)


@registry.add("merge_bucketed", f"""
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice, case when o_orderkey in (select o_orderkey from ({SOURCE_SQL})) then 2 else 1 end as change
    from ({UPSERT_SQL})""")
def merge_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Changes merged into a table in key buckets: the last of them first, then older ones, which change nothing."""
    name = f"{work_database(spark, 'bucketed')}.orders"
    bucketed.create(target(spark, sf).withColumn("change", F.lit(1)), name, "o_orderkey", 16)
    changes = source(spark, sf).withColumn("change", F.lit(2))
    older = changes.withColumns({"o_totalprice": F.lit(0.0), "change": F.lit(1)})
    for part in (changes.where("o_orderkey % 2 = 0"), changes, older, older.where("o_orderkey % 3 = 0")):
        bucketed.upsert(part, name, order="change")
    return bucketed.rows(spark, name)


registry.add("merge_in_order", f"""
    with m as (select t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice, s.o_orderkey as k, s.o_custkey as c, s.o_orderstatus as st,
                      s.o_totalprice as p from ({TARGET_SQL}) t full join ({SOURCE_SQL}) s on s.o_orderkey = t.o_orderkey)
    select coalesce(o_orderkey, k) as o_orderkey, coalesce(o_custkey, c) as o_custkey,
           case when o_orderkey is null or p > 200000 then st else o_orderstatus end as o_orderstatus,
           case when o_orderkey is null or p > 200000 then p else o_totalprice end as o_totalprice,
           case when k is null or (o_orderkey is not null and coalesce(p, 0) <= 200000) then 200000.0 else p end as at
    from m""")(
    lambda spark, sf: merge.upsert(
        target(spark, sf).withColumn("at", F.lit(200000.0)), source(spark, sf).withColumn("at", F.col("o_totalprice")), "o_orderkey",
        ["o_orderstatus", "o_totalprice"], order="at"))


@registry.add("stream_upsert", f"""
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice from ({UPSERT_SQL})
    union all select null, o_custkey, o_orderstatus, o_totalprice from orders where o_custkey % 50 = 0""")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Changes arriving as files, merged by runs of one stream; older ones come after the last, then a run finds nothing new.

    A key changes up to three times in a batch, once without an order; rows without a key are all inserted.
    """
    arrivals, checkpoint = work_folder(spark, "arrivals"), work_folder(spark, "checkpoint")
    name = f"{work_database(spark, 'stream')}.orders"

    def numbered(df: DataFrame, change: int | None) -> DataFrame:
        return df.select("*", (F.col("o_orderkey") % 4).alias("bucket"), F.lit(change).cast("int").alias("change"))

    first, last = numbered(target(spark, sf), 1), source(spark, sf)
    other = last.withColumns({"o_orderstatus": F.lit("old"), "o_totalprice": F.lit(-1.0)})
    keyless = load(spark, sf, "orders").where("o_custkey % 50 = 0").select(F.lit(None).cast("bigint").alias("o_orderkey"), *FIELDS[1:])
    changes = numbered(last, 9).unionByName(numbered(other, 8)).unionByName(numbered(other, None)).unionByName(numbered(keyless, 1))
    late = numbered(other, 7).unionByName(numbered(other, 9))
    for batch in (first, changes, late, None):
        if batch is not None:
            batch.write.mode("append").parquet(arrivals)
        upserts.upsert_stream(spark, arrivals, first.schema, name, ["o_orderkey", "bucket"], checkpoint, "change", ["bucket"])
    return spark.table(name).select(*FIELDS)


@registry.add("left_join_chain", """
    select d.doc_id, d.lang, l.quality, l.toxic, f.lines from documents d
    left join labels l using (doc_id)
    left join (select doc_id, length(text) - length(replace(text, chr(10), '')) as lines from documents
               where lang = 'en') f using (doc_id)""")
def left_join_chain(spark: SparkSession, sf: str) -> DataFrame:
    documents = load(spark, sf, "documents")
    lines = documents.where("lang = 'en'").select(
        "doc_id", (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("bigint").alias("lines"))
    return joins.left_join_chain(documents.select("doc_id", "lang"), [load(spark, sf, "labels"), lines], "doc_id")


@registry.add("pair_dimension", """
    select s_suppkey as "viewId", s_name as "Account", s_nationkey as "webProperty",
           cast(year(l_shipdate) as integer) as "Year", cast(month(l_shipdate) as integer) as "Month",
           l_returnflag as "defaultChannelGrouping", count(distinct l_orderkey) as "Users"
    from lineitem join supplier on s_suppkey = l_suppkey
    where l_shipdate >= timestamp '1995-01-01' and l_shipdate < timestamp '2002-01-01' group by all""")
def pair_dimension(spark: SparkSession, sf: str) -> DataFrame:
    accounts = load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("viewId"), F.col("s_name").alias("Account"), F.col("s_nationkey").alias("webProperty"))
    rows = profile.users_by_month(load(spark, sf, "lineitem"), "l_shipdate", "l_returnflag", "l_orderkey",
                                  "1995-01-01", "2001-12-31", ["l_suppkey"])
    return joins.pair_accounts(rows.withColumnRenamed("l_suppkey", "viewId"), accounts, "viewId")


registry.add("union_by_name", """
    select conv_id, turn, role, text, cast(null as varchar) as lang from conversations
    union all select doc_id, null, null, text, lang from documents""")(
    lambda spark, sf: joins.union_by_name(
        load(spark, sf, "conversations"),
        load(spark, sf, "documents").select("lang", "text", F.col("doc_id").alias("conv_id"))))

registry.add("union_by_position", """
    select conv_id, text from conversations where role = 'user'
    union all select conv_id, text from conversations where role <> 'user'""")(
    lambda spark, sf: joins.union_by_position(
        load(spark, sf, "conversations").where("role = 'user'").select("conv_id", "text"),
        load(spark, sf, "conversations").where("role <> 'user'").select("conv_id", "text")))
