"""Registered queries: columns, filters, scalars, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import names, times, values
from tablewright.operators import columns, filters, nested, paging, profile, rowids
from tablewright.registry.common import AS_OF, Registry, load
from tablewright.schemas import BUDGET_LIST_COLUMNS, dataset_name_column, dataset_table_column
from tablewright.session import work_folder

registry = Registry()

registry.add("typed_columns", """
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
    from lineitem""")(
    lambda spark, sf: profile.typed_columns(load(spark, sf, "lineitem"), "numeric"))

registry.add("ts_to_string", "select event_id, cast(ts as varchar) as ts, user_id, event_type, value, props from events")(
    lambda spark, sf: profile.timestamps_as_text(load(spark, sf, "events")))

registry.add("cast_by_name", """
    select p_partkey, try_cast(p_name as bigint) as p_name, p_brand, p_type, cast(p_size as varchar) as p_size,
           cast(p_retailprice as decimal(12,2)) as p_retailprice from part""")(
    lambda spark, sf: values.cast_by_name(load(spark, sf, "part"), {
        "p_partkey": "long", "p_name": "integer", "p_size": "real", "p_retailprice": "numeric(12,2)", "p_brand": "varchar"}))

CONFORMED = "c_custkey int, c_name string, c_nationkey bigint, c_acctbal decimal(12,2), c_phone string"
registry.add("conform_schema", """
    select cast(c_custkey as integer) as c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey,
           cast(c_acctbal as decimal(12,2)) as c_acctbal, cast(null as varchar) as c_phone from customer""")(
    lambda spark, sf: columns.conform(load(spark, sf, "customer"), T.StructType.fromDDL(CONFORMED)))

registry.add("append_metadata", """
    select *, 'web' as "__source", '7' as "__run", '2024-01-15' as "__Date", 'lake' as "SourceDatabase" from customer""")(
    lambda spark, sf: columns.add_context(
        columns.append_metadata(load(spark, sf, "customer"), AS_OF, source="web", run=7), SourceDatabase="lake",
    ).withColumn("__Date", F.col("__Date").cast("string")))


@registry.add("load_date_from_ts", """
    select o_orderkey, case when o_orderstatus = 'P' then null else cast(cast(o_orderdate as date) as varchar) end as "__Date"
    from orders""")
def load_date_from_ts(spark: SparkSession, sf: str) -> DataFrame:
    stamped = load(spark, sf, "orders").select("o_orderkey", F.when(
        F.col("o_orderstatus") == "P", F.lit("not read")).otherwise(F.col("o_orderdate").cast("string")).alias("ddsReadTime"))
    return columns.load_date(stamped, "ddsReadTime").select("o_orderkey", F.col("__Date").cast("string").alias("__Date"))


def event_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Events with maps made of their own columns."""
    return load(spark, sf, "events").select(
        "event_id",
        F.create_map(F.lit("id"), F.col("user_id").cast("string"), F.lit("name"), F.col("event_type")).alias("customer"),
        F.create_map(F.lit("number"), F.col("value").cast("string"), F.lit("type"), F.col("event_type")).alias("job"),
        nested.json_map(F.col("props")).alias("props"))


registry.add("flatten_map_columns", """
    select event_id, user_id as customer_id, event_type as customer_name, cast(null as varchar) as customer_tier,
           try_cast(event_type as integer) as job_type, cast(json_extract_string(props, '$.k') as integer) as props_k
    from events""")(
    lambda spark, sf: columns.flatten_maps(
        event_maps(spark, sf), {"customer": ("id", "name", "tier"), "job": ("type",), "props": ("k",)},
        {"customer_id": "bigint", "job_type": "int", "props_k": "int"}))

registry.add("extract_map_keys", """
    select event_id, json_extract_string(props, '$.k') as k, cast(null as varchar) as missing from events""")(
    lambda spark, sf: columns.extract_keys(
        event_maps(spark, sf), "props", {"k": "k", "other": "missing"}).select("event_id", "k", "missing"))


@registry.add("fill_and_cast", """
    select o_orderkey, cast(coalesce(case when o_orderstatus <> 'F' then floor(o_totalprice) end, 0) as bigint) as price,
           coalesce(case when o_orderstatus = 'O' then o_custkey end, 0) as buyer from orders""")
def fill_and_cast(spark: SparkSession, sf: str) -> DataFrame:
    gaps = load(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "F", F.floor("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_custkey")).alias("buyer"))
    return columns.fill_ids(gaps, ("price", "buyer"))


ALIAS_SQL = "case event_type when 'click' then 'I' when 'view' then 'jobs' when 'purchase' then 'Tag Types' when 'error' then 'ii' else event_type end"


@registry.add("alias_lookup", f"""
    select event_id, {ALIAS_SQL} as alias,
           case event_type when 'click' then 'invoices' when 'view' then 'jobs' when 'purchase' then 'tag-types'
                           when 'error' then 'invoice-items' end as dataset,
           case event_type when 'click' then 'invoice' when 'view' then 'job' when 'purchase' then 'tagtype'
                           when 'error' then 'invoice_item' end as table_name
    from events""")
def alias_lookup(spark: SparkSession, sf: str) -> DataFrame:
    alias = F.expr(ALIAS_SQL)
    return load(spark, sf, "events").select("event_id", alias.alias("alias")).select(
        "event_id", "alias", dataset_name_column(F.col("alias")).alias("dataset"),
        dataset_table_column(F.col("alias")).alias("table_name"))


registry.add("qualify_name", """
    select o_orderkey, lower('Bronze.' || o_orderpriority || '_' || o_orderstatus) as table_name from orders""")(
    lambda spark, sf: load(spark, sf, "orders").select("o_orderkey", names.qualified_column(
        F.lit("Bronze"), F.col("o_orderpriority"), F.col("o_orderstatus")).alias("table_name")))

registry.add("filter_predicates", """
    select l_orderkey, l_partkey, l_linenumber, l_quantity from lineitem
    where l_returnflag = 'R' and (case when l_linenumber = 3 then null else l_discount end) is not null
      and (case when l_linestatus = 'F' and l_linenumber = 2 then null else l_quantity > 10 end) is true
      and (l_shipdate < timestamp '1998-01-01') is false and nullif(l_linestatus, 'F') is null""")(
    lambda spark, sf: load(spark, sf, "lineitem").withColumns({
        "discount": F.when(F.col("l_linenumber") != 3, F.col("l_discount")),
        "many": F.when(~((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 2)), F.col("l_quantity") > 10),
        "early": F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"),
        "status": F.nullif(F.col("l_linestatus"), F.lit("F")),
    }).where((F.col("l_returnflag") == "R") & F.col("discount").isNotNull() & F.col("many") & ~F.col("early")
             & F.col("status").isNull()).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity"))


def activity(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").withColumn(
        "active", F.when(F.col("event_type") != "signup", F.col("value") > 20))


ACTIVE_SQL = "(event_type <> 'signup' and value > 20)"
registry.add("filter_active", f"select event_id, value from events where {ACTIVE_SQL}")(
    lambda spark, sf: filters.active_only(activity(spark, sf)).select("event_id", "value"))

registry.add("incremental_after", "select event_id from events where ts > timestamp '2024-01-13 23:59:59'")(
    lambda spark, sf: filters.modified_after(load(spark, sf, "events"), "ts", AS_OF).select("event_id"))

registry.add("incremental_on_or_after", "select event_id from events where ts >= timestamp '2024-01-14'")(
    lambda spark, sf: filters.modified_since(load(spark, sf, "events"), "ts", AS_OF).select("event_id"))

RULES_SQL = {
    "appointments": "ts >= timestamp '2024-01-14'",
    "calls": f"ts > timestamp '2024-01-13 23:59:59' and {ACTIVE_SQL}",
    "customers": ACTIVE_SQL,
    "tag-types": ACTIVE_SQL,
    "invoices": "ts >= timestamp '2024-01-14'",
    "jobs": "ts >= timestamp '2024-01-14'",
    "memberships": f"ts >= timestamp '2024-01-14' and {ACTIVE_SQL}",
}


@registry.add("incremental_rules", " union all ".join(
    f"select '{name}' as dataset, event_id from events where {rule}" for name, rule in RULES_SQL.items()))
def incremental_rules(spark: SparkSession, sf: str) -> DataFrame:
    events = activity(spark, sf)
    result = None
    for name in RULES_SQL:
        part = filters.incremental(events, name, AS_OF, "ts").select(F.lit(name).alias("dataset"), "event_id")
        result = part if result is None else result.unionByName(part)
    return result


registry.add("sample_fraction", f"""
    select event_id from events
    where ('0x' || substr(md5(cast(event_id as varchar) || ':7'), 1, 8))::bigint < {int(0.3 * (1 << 32))}""")(
    lambda spark, sf: filters.random_sample(load(spark, sf, "events"), 0.3, seed=7, key="event_id").select("event_id"))


@registry.add("split_runs", """
    with listing as (select case when p_partkey % 10 > 0 then p_name || '-' || p_partkey end as id, p_name from part),
    ranked as (select *, ntile(2) over (order by id) as run from listing where id is not null)
    select id, p_name, case run when 1 then 'first' else 'second' end as run from ranked
    union all select id, p_name, 'second' from listing where id is null""")
def split_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Both halves of a list with text ids, some of them missing."""
    key = F.concat_ws("-", "p_name", "p_partkey")
    listing = load(spark, sf, "part").select(F.when(F.col("p_partkey") % 10 > 0, key).alias("id"), "p_name")
    return paging.halves(listing, "id")


registry.add("name_filter_split", """
    select p_partkey, p_name, case when contains(p_name, 'ring') then 'mine' else 'other' end as side from part""")(
    lambda spark, sf: filters.with_token(load(spark, sf, "part"), "p_name", "ring").withColumn("side", F.lit("mine"))
    .unionByName(filters.without_token(load(spark, sf, "part"), "p_name", "ring").withColumn("side", F.lit("other")))
    .select("p_partkey", "p_name", "side"))

registry.add("page_offset_limit", """
    select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'O'
    order by o_orderkey desc limit 2000 offset 2000""")(
    lambda spark, sf: paging.detail_page(
        load(spark, sf, "orders"), F.col("o_orderstatus") == "O", [F.col("o_orderkey").desc()], 2000, 2000)
    .select("o_orderkey", "o_custkey", "o_totalprice"))

registry.add("page_all", "select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'O'")(
    lambda spark, sf: paging.all_details(load(spark, sf, "orders"), F.col("o_orderstatus") == "O")
    .select("o_orderkey", "o_custkey", "o_totalprice"))

registry.add("row_ids", """
    select l_orderkey, l_linenumber, l_shipdate, row_number() over (order by l_shipdate desc, l_orderkey, l_linenumber) as row_id
    from lineitem""")(
    lambda spark, sf: rowids.numbered(
        load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"),
        [F.col("l_shipdate").desc(), F.col("l_orderkey"), F.col("l_linenumber")]))


@registry.add("page_index", """
    select o_orderkey, o_totalprice, row_id, (row_id + 499) // 500 as page
    from (select *, row_number() over (order by o_totalprice, o_orderkey) as row_id from orders)
    where row_id <= 1200 or row_id > 2000""")
def page_index(spark: SparkSession, sf: str) -> DataFrame:
    """A page index written once; the rows up to one offset and all those after another."""
    path, orders = work_folder(spark, "page_index"), load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    rowids.write_pages(orders, [F.col("o_totalprice"), F.col("o_orderkey")], path, 500)
    return rowids.read_page(spark, path, 0, 1200).unionByName(rowids.read_page(spark, path, 2000, orders.count()))


def budgets(df: DataFrame) -> DataFrame:
    """Orders under the names of the budget list; fields orders do not have are NULL."""
    known: dict[str, Column] = {
        "RECORDNO": F.col("o_orderkey"), "BUDGETID": F.col("o_custkey").cast("string"),
        "DESCRIPTION": F.col("o_orderpriority"), "STATUS": F.col("o_orderstatus"),
        "WHENCREATED": F.col("o_orderdate").cast("string")}
    return df.select(*[known.get(c, F.lit(None).cast("string")).alias(c) for c in BUDGET_LIST_COLUMNS])


BUDGET_SQL = {"RECORDNO": "o_orderkey", "BUDGETID": "cast(o_custkey as varchar)", "DESCRIPTION": "o_orderpriority",
              "STATUS": "o_orderstatus", "WHENCREATED": "cast(o_orderdate as varchar)"}
registry.add("select_order_limit", "select " + ", ".join(
    f'{BUDGET_SQL.get(c, "cast(null as varchar)")} as "{c}"' for c in BUDGET_LIST_COLUMNS)
    + " from orders order by o_orderkey limit 1000")(
    lambda spark, sf: paging.head_list(budgets(load(spark, sf, "orders")), list(BUDGET_LIST_COLUMNS), "RECORDNO"))

registry.add("lookup_by_key", "select item_id, text from benchmark where item_id = 17")(
    lambda spark, sf: paging.by_key(load(spark, sf, "benchmark"), "item_id", 17).select("item_id", "text"))

registry.add("normalise_name", "select p_partkey, lower(replace(p_name, ' ', '')) as name from part")(
    lambda spark, sf: load(spark, sf, "part").select("p_partkey", names.normalised(F.col("p_name")).alias("name")))

FLAG_TEXT_SQL = "case event_type when 'click' then 'TRUE' when 'view' then 'Yes' when 'error' then '1' when 'signup' then 'no' end"
registry.add("str_to_bool", """
    select event_id, case event_type when 'click' then true when 'view' then true when 'error' then true
                                     when 'signup' then false end as flag from events""")(
    lambda spark, sf: load(spark, sf, "events").select(
        "event_id", values.flag_from_text(F.expr(FLAG_TEXT_SQL)).alias("flag")))

registry.add("strip_charset", "select c_custkey, ltrim(c_name, 'Cemorstu') as name from customer")(
    lambda spark, sf: load(spark, sf, "customer").select(
        "c_custkey", names.strip_leading_set(F.col("c_name"), "Cemorstu").alias("name")))

registry.add("central_date", """
    select event_id, cast(cast(timezone('America/Chicago', timezone('UTC', ts)) as date) as varchar) as day from events""")(
    lambda spark, sf: load(spark, sf, "events").select(
        "event_id", times.central_date(F.col("ts")).cast("string").alias("day")))


@registry.add("iso_to_utc", """
    select event_id, cast(date_trunc('second', ts) + interval 6 hour as varchar) as at_utc,
           cast(cast(ts as date) as varchar) as day from events""")
def iso_to_utc(spark: SparkSession, sf: str) -> DataFrame:
    """Events' times written with a -06:00 offset, and their days as YYYYMMDD, read back."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-06:00"))
    return load(spark, sf, "events").select(
        "event_id", times.iso_to_utc(text).cast("string").alias("at_utc"),
        times.compact_date(F.date_format("ts", "yyyyMMdd")).cast("string").alias("day"))
