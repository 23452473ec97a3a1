"""Registered queries: whole flows, composed of the operators."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import names
from tablewright.operators import columns, layout, named_files, nested
from tablewright.plans import flows
from tablewright.registry.common import ARCHIVE_AS_OF, AS_OF, Registry, load, pack_records, relaxed, write_pages
from tablewright.registry.nesting import (CALL_COLUMNS, CALL_ROWS_SQL, ITEMS_SQL, account_documents, call_records,
                                           invoice_texts)
from tablewright.registry.storage import KIND_SQL, MARK_SQL, TYPE_SQL
from tablewright.schemas import raw_schema
from tablewright.session import work_database, work_folder
from tablewright.sources import delimited

registry = Registry()


LEDGER_NAME_SQL = f"""'GLENTRY.acme.' || {KIND_SQL} || '.' || cast(cast(date_trunc('quarter', o_orderdate) as date) as varchar)
    || '_' || {MARK_SQL} || 'x.csv'"""


@registry.add("flow_ledger_load", f"""
    select o_orderkey as "RECORDNO", o_custkey as "ACCOUNTKEY", o_totalprice as "AMOUNT", o_orderstatus as "STATE",
           cast(o_orderdate as varchar) as "ddsReadTime", cast(cast(o_orderdate as date) as varchar) as "__Date", {TYPE_SQL} as kind
    from (select *, {LEDGER_NAME_SQL} as name from orders) where {TYPE_SQL} is not null""")
def flow_ledger_load(spark: SparkSession, sf: str) -> DataFrame:
    """Pipe files of every load type, told apart by their names alone, each type loaded to a table of its own."""
    folder, database = work_folder(spark, "ledger"), work_database(spark, "ledger")
    rows = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("RECORDNO"), F.col("o_custkey").alias("ACCOUNTKEY"), F.col("o_totalprice").alias("AMOUNT"),
        F.col("o_orderstatus").alias("STATE"), F.col("o_orderdate").cast("string").alias("ddsReadTime"),
        F.expr(LEDGER_NAME_SQL.replace("varchar", "string")).alias("name"))
    name = F.col("name")
    named_files.write_named(rows, folder, names.file_part(name), rows.columns[:-1], "|", table=names.table_part(name), date=names.save_date(name))
    loaded = []
    for kind in ("fl", "cr", "upd", "del"):
        flows.load_ledger(spark, folder, kind, rows.drop("name").schema, f"{database}.glentry_{kind}")
        loaded.append(spark.table(f"{database}.glentry_{kind}").withColumns({"__Date": F.col("__Date").cast("string"), "kind": F.lit(kind)}))
    return reduce(DataFrame.unionByName, loaded)


MEMBER_SQL = """'ORD' || o_orderstatus || '.acme.' || case o_orderpriority when '1-URGENT' then 'all' when '2-HIGH' then 'change'
    else 'misc' end || '.' || cast(cast(date_trunc('year', o_orderdate) as date) as varchar) || '_x.csv'"""


@registry.add("flow_file_drop", f"""
    select member as name, split_part(member, '.', 1) as "table",
           replace(list_last(string_split(split_part(member, '_', 1), '.')), '-', '') as date, count(*) as records,
           not (contains(member, 'all.') or contains(member, 'cr') or contains(member, 'upd') or contains(member, 'del')) as flagged,
           case when datediff('day', cast(split_part(split_part(member, '.', 4), '_', 1) as date), date '2000-01-01') > 30
                then 'archive' else 'keep' end as action
    from (select {MEMBER_SQL} as member from orders) group by member""")
def flow_file_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops of archives, the first one twice: unpacked, landed by table and day, checked, and split by age."""
    orders = load(spark, sf, "orders").withColumn("member", F.expr(MEMBER_SQL.replace("varchar", "string")))

    def packed(rows: DataFrame) -> DataFrame:
        return pack_records(rows.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus", "member"), "member")

    control = f"{work_database(spark, 'drop')}.problem_files"
    folder = work_folder(spark, "landed")
    for half, label in ((0, "early/"), (1, "late/"), (0, "early/")):
        drop = packed(orders.where(F.col("o_orderkey") % 2 == half)).withColumn("path", F.concat(F.lit(label), "path"))
        landed = flows.land_drop(drop, folder, control)
    counted = landed.where("record_no > 0").groupBy(F.col("member").alias("name"), "table", "date").count()
    flagged = spark.table(control).select(F.col("file_name").alias("name"), F.lit(True).alias("flagged"))
    return (layout.split_by_age(counted, ARCHIVE_AS_OF).join(flagged, "name", "left")
            .select("name", "table", "date", F.col("count").alias("records"),
                    F.coalesce("flagged", F.lit(False)).alias("flagged"), "action"))


def invoice_records(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as raw invoices, with their parties as maps."""
    def entry(**values):
        return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("string"))])

    texts = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("summary"), F.col("l_extendedprice").cast("string").alias("total"),
        entry(id=F.col("l_partkey"), name=F.col("l_linestatus")).alias("customer"),
        entry(id=F.col("l_suppkey"), name=F.col("l_returnflag")).alias("businessUnit"),
        entry(id=F.col("l_orderkey"), number=F.col("l_linenumber")).alias("batch"),
        entry(id=F.col("l_partkey"), number=F.col("l_linestatus"), type=F.lit("Install")).alias("job"),
        F.col("l_shipdate").cast("string").alias("modifiedOn"), F.col("l_returnflag").alias("tenantId"))
    return columns.conform(texts, relaxed(raw_schema("invoices")))


@registry.add("flow_api_invoices", """
    select l_orderkey as id, l_returnflag as summary, cast(l_extendedprice as varchar) as total, l_returnflag as "tenantId",
           l_linestatus as customer_name, l_partkey as customer_id, l_returnflag as "businessUnit_name",
           cast(l_suppkey as integer) as "businessUnit_id", cast(null as varchar) as batch_name, l_linenumber as batch_number,
           l_orderkey as batch_id, l_partkey as job_id, cast(null as integer) as job_number, 'Install' as job_type,
           cast(null as bigint) as "employeeInfo_id", cast(l_shipdate as varchar) as "modifiedOn"
    from lineitem""")
def flow_api_invoices(spark: SparkSession, sf: str) -> DataFrame:
    record = relaxed(raw_schema("invoices"))
    path = write_pages(invoice_records(spark, sf), "tenantId")
    record = type(record)([f for f in record.fields if f.name != "tenantId"])
    frame = flows.pull_dataset(spark, path, "i", record)
    return frame.select("id", "summary", "total", "tenantId", "customer_name", "customer_id", "businessUnit_name",
                        "businessUnit_id", "batch_name", "batch_number", "batch_id", "job_id", "job_number", "job_type",
                        "employeeInfo_id", "modifiedOn")


@registry.add("flow_api_jobs", """
    select o_orderkey as id, cast(o_orderkey as varchar) as "jobNumber", o_custkey as "customerId", o_orderstatus as "jobStatus",
           case when o_orderstatus = 'O' then o_custkey else 0 end as "recallForId", cast(0 as bigint) as "warrantyId",
           cast(0 as bigint) as "soldById", o_orderpriority as "tenantId",
           case when o_orderstatus = 'F' then cast(o_custkey as varchar) end as "generatedFromId",
           cast(null as varchar) as "generatedById", unnest([o_orderkey, o_custkey]) as "tagTypeId"
    from orders""")
def flow_api_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs with their missing ids filled, lead sources taken out of the map, and one row per tag."""
    jobs = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("jobNumber"), F.col("o_custkey").alias("customerId"),
        F.col("o_orderstatus").alias("jobStatus"), F.when(F.col("o_orderstatus") == "O", F.col("o_custkey")).alias("recallForId"),
        F.when(F.col("o_orderstatus") == "F", F.create_map(F.lit("jobId"), F.col("o_custkey").cast("string"))).alias("jobGeneratedLeadSource"),
        F.array("o_orderkey", "o_custkey").alias("tagTypeIds"), F.col("o_orderpriority").alias("tenantId"))
    raw = relaxed(raw_schema("jobs"))
    path = write_pages(columns.conform(jobs, raw), "tenantId")
    frame = flows.pull_dataset(spark, path, "j", type(raw)([f for f in raw.fields if f.name != "tenantId"]))
    kept = ["id", "jobNumber", "customerId", "jobStatus", "recallForId", "warrantyId", "soldById", "tenantId",
            "generatedFromId", "generatedById"]
    return nested.explode_ids(frame, "tagTypeIds", "tagTypeId", **{c: c for c in kept})


@registry.add("flow_api_items", ITEMS_SQL)
def flow_api_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items of invoices pulled in pages, one row each."""
    path = write_pages(invoice_texts(spark, sf), "tenantId")
    return flows.pull_dataset(spark, path, "ii", T.StructType.fromDDL("id bigint, items string"))


@registry.add("flow_api_tags", """
    select o_orderkey as "jobId", unnest([o_orderkey, o_custkey]) as "tagTypeId", o_orderpriority as "tenantId" from orders
    where o_orderstatus <> 'P'""")
def flow_api_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Tags of jobs pulled in pages, one row each; jobs without tags give none."""
    jobs = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("tenantId"),
        F.when(F.col("o_orderstatus") != "P", F.array("o_orderkey", "o_custkey")).alias("tagTypeIds"))
    path = write_pages(jobs, "tenantId")
    return flows.pull_dataset(spark, path, "jtt", T.StructType.fromDDL("id bigint, tagTypeIds array<bigint>")).select("jobId", "tagTypeId", "tenantId")


@registry.add("flow_raw_export", """
    select o_orderkey as "jobId", unnest([o_orderkey, o_custkey]) as "tagTypeId", 'org' || left(o_orderpriority, 1) as "tenantId",
           'organization=org' || left(o_orderpriority, 1) || '/table=job-tag-types/org' || left(o_orderpriority, 1)
           || '_job-tag-types_20240115.csv' as file
    from orders""")
def flow_raw_export(spark: SparkSession, sf: str) -> DataFrame:
    """Tags pulled in pages and exported to one named file per organisation; the export is done twice, the second replaces."""
    jobs = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("org"), F.substring("o_orderpriority", 1, 1)).alias("tenantId"),
        F.array("o_orderkey", "o_custkey").alias("tagTypeIds"))
    frame = flows.pull_dataset(spark, write_pages(jobs, "tenantId"), "jtt", T.StructType.fromDDL("id bigint, tagTypeIds array<bigint>"))
    folder = work_folder(spark, "raw")
    for rows in (frame.where("jobId % 2 = 0"), frame):
        flows.export_raw(rows.select("jobId", "tagTypeId", "tenantId"), folder, F.col("tenantId"), "jtt", AS_OF)
    back = spark.read.schema("jobId bigint, tagTypeId bigint, tenantId string").option("header", "true").option("recursiveFileLookup", "true").csv(folder)
    return back.withColumn("file", F.regexp_extract("_metadata.file_path", "/(organization=.*)$", 1))


@registry.add("flow_api_calls", CALL_ROWS_SQL)
def flow_api_calls(spark: SparkSession, sf: str) -> DataFrame:
    raw = relaxed(raw_schema("calls"))
    path = write_pages(columns.conform(call_records(spark, sf), raw), "tenantId")
    frame = flows.pull_dataset(spark, path, "c", type(raw)([f for f in raw.fields if f.name != "tenantId"]))
    return frame.select("id", "jobNumber", "projectId", "tenantId", *CALL_COLUMNS)


@registry.add("flow_analytics_upsert", """
    select cast(year(l_shipdate) as integer) as "Year", cast(month(l_shipdate) as integer) as "Month",
           l_returnflag as "defaultChannelGrouping", count(distinct l_orderkey) as "Users", s_name as "Account",
           'shop' as "webProperty", 'all-' || cast(s_suppkey as varchar) as "View", s_suppkey as "viewId",
           case when year(l_shipdate) < 1999 then '2024-01-14' else '2024-01-15' end as "__Date"
    from lineitem join supplier on s_suppkey = l_suppkey group by all""")
def flow_analytics_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two collections over the accounts; months collected again take the new counts and day."""
    table = f"{work_database(spark, 'analytics')}.users"
    accounts = nested.explode_profiles(
        account_documents(load(spark, sf, "supplier"), "s_suppkey", "s_name", F.lit(True)), "account", "properties", "profiles",
    ).drop("id")
    rows = load(spark, sf, "lineitem")
    for start, end, day in (("1995-01-01", "1999-06-15", date(2024, 1, 14)), ("1999-01-01", "2030-12-31", AS_OF)):
        frame = flows.collect_analytics(rows, accounts, "l_shipdate", "l_returnflag", "l_orderkey", "l_suppkey", start, end)
        flows.upsert_analytics(frame, table, day)
    return spark.table(table).withColumn("__Date", F.col("__Date").cast("string"))


@registry.add("flow_sheet_clone", """
    with mine as (select p_partkey, p_name, ntile(2) over (order by p_partkey) as half from part where contains(p_name, 'ring')),
    runs as (select p_partkey, p_name, case half when 1 then 'first' else 'second' end as run from mine
             union all select p_partkey, p_name, 'others' from part where not contains(p_name, 'ring'))
    select p_partkey as id, lower(replace(p_name, ' ', '')) || '.csv' as file_name, run from runs""")
def flow_sheet_clone(spark: SparkSession, sf: str) -> DataFrame:
    """Sheets chosen by name and run, header checked, and written under the folder of their run."""
    part, target = load(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), work_folder(spark, "sheets")
    source = work_folder(spark, "sheet_source")
    part.write.option("header", "true").csv(source)
    listing = delimited.read_expected(spark, source, ["id"], part.schema)
    for run, second in (("first", False), ("second", True), ("others", None)):
        layout.write_layout(flows.sheet_run(listing, "ring", second).select("id", "file_name"), f"{target}/run={run}",
                            {"table": "sheets"})
    return (spark.read.schema("id bigint, file_name string, run string, `table` string").option("header", "true")
            .csv(target).select("id", "file_name", "run"))


@registry.add("flow_budget_pull", """
    select o_orderkey, o_custkey, o_totalprice, '2024-01-15' as "metadata_Date" from orders where o_orderstatus = 'O'
    union all select o_orderkey, o_custkey, o_totalprice, '2024-01-16' from orders where o_orderstatus = 'F'""")
def flow_budget_pull(spark: SparkSession, sf: str) -> DataFrame:
    """Pulls of two days next to each other."""
    path = work_folder(spark, "budget")
    rows = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    flows.pull_budget(rows, F.col("o_orderstatus") == "O", path, AS_OF)
    flows.pull_budget(rows, F.col("o_orderstatus") == "F", path, AS_OF + timedelta(days=1))
    return (spark.read.schema("o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string, metadata_Date string")
            .option("header", "true").csv(path).drop("o_orderstatus"))
