"""Registered queries: files, delimited text, archives, paged JSON, managed tables, streams of files."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import names
from tablewright.operators import columns, filters, joins, layout, moves, profile, rowids, tables
from tablewright.operators import named_files as named_sink
from tablewright.registry.common import (ARCHIVE_AS_OF, AS_OF, Registry, load, pack_members, pack_records, write_pages)
from tablewright.session import work_database, work_folder
from tablewright.sources import archives, catalog, delimited, files, paged_json, stores
from tablewright.streaming import ingest, intake

registry = Registry()

PART_SQL = "select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part"


def write_csv(df: DataFrame, sep: str, label: str = "csv", **options: str) -> str:
    path = work_folder(df.sparkSession, label)
    delimited.write_delimited(df, path, sep, **options)
    return path


def external_table(spark: SparkSession, sf: str, database: str, table: str) -> str:
    """A table over the given file, without a copy."""
    name = f"{database}.{table}"
    spark.catalog.createTable(name, path=f"{sf.rstrip('/')}/{table}.parquet", source="parquet")
    return name


@registry.add("scan_table", "select o_orderkey, o_custkey, o_totalprice from orders")
def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    name = external_table(spark, sf, work_database(spark, "scan"), "orders")
    return catalog.scan_table(spark, name).select("o_orderkey", "o_custkey", "o_totalprice")


@registry.add("scan_csv_pipe", PART_SQL)
def scan_csv_pipe(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part")
    return delimited.read_delimited(spark, write_csv(part, "|"), part.schema, "|")


@registry.add("scan_csv_comma", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def scan_csv_comma(spark: SparkSession, sf: str) -> DataFrame:
    customer = load(spark, sf, "customer")
    return delimited.read_delimited(spark, write_csv(customer, ","), customer.schema, ",")


@registry.add("scan_csv_backslash", "select s_suppkey, s_name || chr(92) as s_name, s_acctbal from supplier")
def scan_csv_backslash(spark: SparkSession, sf: str) -> DataFrame:
    """Quoted names that end in a backslash, as some exports write them."""
    named = load(spark, sf, "supplier").select("s_suppkey", F.concat("s_name", F.lit("\\")).alias("s_name"), "s_acctbal")
    path = write_csv(named, ",", quoteAll="true")
    return delimited.read_delimited(spark, path, named.schema, ",")


@registry.add("scan_csv_drop_union", """
    select p_partkey, p_brand, cast(null as varchar) as p_type, p_size from part where p_size <= 25
    union all select p_partkey, null, p_type, p_size from part where p_size > 25""")
def scan_csv_drop_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two kinds of files with different headers in one folder tree."""
    part, folder = load(spark, sf, "part"), work_folder(spark, "mixed")
    delimited.write_delimited(part.where("p_size <= 25").select("p_partkey", "p_name", "p_brand", "p_size"), f"{folder}/small")
    delimited.write_delimited(part.where("p_size > 25").select("p_size", "p_type", "p_name", "p_partkey"), f"{folder}/large")
    paths = [f.path for f in files.inventory(spark, folder, glob="*.csv").select("path").collect()]
    mixed = delimited.read_mixed(spark, paths, {"p_partkey": "bigint", "p_size": "int"}, ["p_name"])
    return mixed.select("p_partkey", "p_brand", "p_type", "p_size")


@registry.add("scan_expected_header", PART_SQL)
def scan_expected_header(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part")
    return delimited.read_expected(spark, write_csv(part, ","), ["p_partkey", "p_retailprice"], part.schema)


@registry.add("csv_redelimit", """select doc_id, text, n_chars from documents""")
def csv_redelimit(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts with quotes and line breaks, written with commas and again with pipes."""
    documents = load(spark, sf, "documents").select("doc_id", "text", "n_chars")
    target = work_folder(spark, "redelimited")
    delimited.redelimit(spark, write_csv(documents, ","), target, documents.schema)
    return delimited.read_delimited(spark, target, documents.schema, "|")


@registry.add("add_null_columns", """
    select o_orderkey, o_orderstatus, cast(null as varchar) as note, cast(null as varchar) as reason from orders""")
def add_null_columns(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    widened = columns.add_null_columns(orders, ["note", "reason"])
    return delimited.read_delimited(spark, write_csv(widened, "|"), widened.schema, "|")


@registry.add("paged_json_ingest", """
    select o_orderkey, o_custkey, o_totalprice, o_orderpriority as "tenantId" from orders""")
def paged_json_ingest(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    path = write_pages(orders, "o_orderpriority")
    record = orders.drop("o_orderpriority").schema
    return paged_json.records_of(paged_json.read_pages(spark, path, record))


@registry.add("paged_completeness", """
    select o_orderpriority as source, count(*) as records, count(*) as "totalCount", false as "hasMore", true as complete
    from orders group by 1""")
def paged_completeness(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    pages = paged_json.read_pages(spark, write_pages(orders, "o_orderpriority"), orders.select("o_orderkey").schema)
    return joins.expected_rows(pages).drop("page")


NUMBERED_PAGES_SQL = """(select o_orderkey, left(o_orderpriority, 1) as source,
    (row_number() over (partition by o_orderpriority order by o_orderkey) - 1) // 50 + 1 as page from orders)"""


@registry.add("paged_quarantine", f"""
    with p as materialized {NUMBERED_PAGES_SQL}, broken as (select distinct source, page from p where page % 7 in (3, 4)),
    last as (select source, max(page) as page from p group by source)
    select o_orderkey, source, cast(page as integer) as page, 'kept' as state from p where page % 7 not in (3, 4)
    union all select null, source, cast(page as integer), 'broken' from broken
    union all select null, b.source, cast(b.page as integer), case when b.page + 1 >= l.page then 'gap without an end' else 'gap of 2' end
    from broken b join last l using (source) where b.page % 7 = 3""")
def paged_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of which two in seven are cut off: records of the others, the broken ones with their number, and the gaps they leave."""
    orders = load(spark, sf, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("source"))
    rows = rowids.numbered(orders, [F.col("source"), F.col("o_orderkey")])
    firsts = rows.groupBy("source").agg(F.min("row_id").alias("first"), F.max("row_id").alias("last"))
    page = (F.floor((F.col("row_id") - F.col("first")) / 50) + 1).cast("int")
    paged = (rows.join(firsts, "source").groupBy("source", page.alias("page"), (F.col("last") - F.col("first") + 1).alias("totalCount"))
             .agg(F.collect_list(F.struct("o_orderkey")).alias("data")))
    more = F.col("page") * 50 < F.col("totalCount")
    text = F.to_json(F.struct("page", F.lit(50).alias("pageSize"), "totalCount", more.alias("hasMore"), "data"))
    path = work_folder(spark, "quarantine")
    cut = F.when(F.col("page") % 7 > 4, text).when(F.col("page") % 7 < 3, text).otherwise(F.substring(text, F.lit(1), F.length(text) - 9))
    paged.select(cut.alias("value"), "source").write.partitionBy("source").text(path)

    good, bad = paged_json.sorted_out(spark, path, T.StructType.fromDDL("o_orderkey bigint"))
    none = F.lit(None).cast("bigint").alias("o_orderkey")
    kept = good.select(F.explode("data.o_orderkey").alias("o_orderkey"), "source", "page", F.lit("kept").alias("state"))
    missing = paged_json.gaps(good).select(none, "source", F.col("first").alias("page"), F.coalesce(
        F.concat(F.lit("gap of "), (F.col("last") - F.col("first") + 1).cast("string")), F.lit("gap without an end")).alias("state"))
    out = kept.unionByName(bad.select(none, "source", "page", F.col("reason").alias("state"))).unionByName(missing)
    return out.withColumn("page", F.col("page").cast("int"))


registry.add("column_metadata", """
    select column_name as "COLUMN_NAME", data_type as "DATA_TYPE", ordinal as "ORDINAL_POSITION", 'YES' as "IS_NULLABLE", n as "Nulls"
    from (values ('l_orderkey', 'bigint', 1), ('l_partkey', 'bigint', 2), ('l_suppkey', 'bigint', 3), ('l_linenumber', 'int', 4),
                 ('l_quantity', 'double', 5), ('l_extendedprice', 'double', 6), ('l_discount', 'double', 7), ('l_tax', 'double', 8),
                 ('l_returnflag', 'string', 9), ('l_linestatus', 'string', 10), ('l_shipdate', 'timestamp_ntz', 11))
         c(column_name, data_type, ordinal), (select count(*) - count(l_orderkey) as n from lineitem)""")(
    lambda spark, sf: catalog.column_metadata(load(spark, sf, "lineitem")).join(
        profile.null_counts(load(spark, sf, "lineitem")).select(F.col("ColumnName").alias("COLUMN_NAME"), "Nulls"), "COLUMN_NAME"))


def plain_name(column: str = "table_name") -> Column:
    return F.element_at(F.split(column, "\\."), -1)


@registry.add("catalog_tables", """
    select 'customer' as name, count(*) as records from customer union all select 'orders', count(*) from orders
    union all select 'supplier', count(*) from supplier""")
def catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The tables of a database with the rows each holds."""
    database = work_database(spark, "listed")
    for table in ("orders", "customer", "supplier"):
        external_table(spark, sf, database, table)
    listed = catalog.tables(spark, database)
    counted = [spark.table(r.table_name).select(F.lit(r.table_name).alias("table_name")) for r in listed.collect()]
    held = reduce(DataFrame.unionByName, counted).groupBy("table_name").agg(F.count("*").alias("records"))
    return listed.join(held, "table_name").select(plain_name().alias("name"), "records")


@registry.add("warm_tables", """
    select 'orders' as name, count(*) as row_count, true as ok from orders union all select 'customer', count(*), true from customer
    union all select 'lineitem', count(*), true from lineitem union all select 'missing', null, false""")
def warm_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables cached and read together; one that is missing is reported. The cache is released again."""
    database = work_database(spark, "warm")
    listed = [external_table(spark, sf, database, t) for t in ("orders", "customer", "lineitem")]
    report = catalog.warm_tables(spark, [*listed, f"{database}.missing"])
    catalog.release(spark, listed)
    return report.select(plain_name().alias("name"), "row_count", "ok")


@registry.add("scan_load", """
    select 'orders' as name, count(*) as row_count, true as ok from orders union all select 'lineitem', count(*), true from lineitem""")
def scan_load(spark: SparkSession, sf: str) -> DataFrame:
    database = work_database(spark, "scan_load")
    report = catalog.scan_tables(spark, [external_table(spark, sf, database, t) for t in ("orders", "lineitem")])
    return report.select(plain_name().alias("name"), "row_count", "ok")


FILE_SQL = "select o_orderstatus as status, count(*) as records from orders group by 1"


def filed(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """A folder of orders by status, and the rows read from each of its files."""
    path = work_folder(spark, "filed")
    orders = load(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    layout.write_layout(orders, path, by=["status"], format="parquet")
    read = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path"))
    return path, read.groupBy("path").agg(F.count("*").alias("records"))


def by_status(listed: DataFrame, held: DataFrame) -> DataFrame:
    return (listed.join(held, "path").groupBy(F.regexp_extract("path", "/status=([^/]*)/", 1).alias("status"))
            .agg(F.sum("records").alias("records")))


@registry.add("file_inventory", FILE_SQL)
def file_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by status, counted over the files that an inventory lists."""
    path, held = filed(spark, sf)
    return by_status(files.inventory(spark, path, glob="*.parquet"), held)


@registry.add("file_recent", FILE_SQL)
def file_recent(spark: SparkSession, sf: str) -> DataFrame:
    """The same over the recent files, which are all of them; none is recent a century on."""
    path, held = filed(spark, sf)
    listed = files.inventory(spark, path, glob="*.parquet")
    return by_status(files.recent(listed, date(1970, 1, 2)).unionByName(files.recent(listed, date(2124, 1, 1))), held)


KIND_SQL = "case o_orderstatus when 'F' then 'all' when 'O' then 'change' else 'misc' end"
MARK_SQL = "case o_orderpriority when '1-URGENT' then 'cr_' when '2-HIGH' then 'upd_' when '3-MEDIUM' then 'del_' else '' end"
NAME_SQL = (f"'GLENTRY.acme.' || {KIND_SQL} || '.' || cast(cast(o_orderdate as date) as varchar) || '_' || {MARK_SQL} "
            "|| cast(o_orderkey as varchar) || '.csv'")
TYPE_SQL = ("case when contains(name, 'all.') then 'fl' when contains(name, 'change.') and contains(name, '_cr_') then 'cr' "
            "when contains(name, 'change.') and contains(name, '_upd_') then 'upd' "
            "when contains(name, 'change.') and contains(name, '_del_') then 'del' end")


def named_files(spark: SparkSession, sf: str) -> DataFrame:
    """An inventory of file names, one per order."""
    return load(spark, sf, "orders").select("o_orderkey", F.expr(NAME_SQL.replace("varchar", "string")).alias("name"))


NAMES_SQL = f"(select o_orderkey, {NAME_SQL} as name from orders)"

registry.add("file_classify", f"""
    select name, kind, true as kept from (select name, {TYPE_SQL} as kind from {NAMES_SQL}) where kind in ('cr', 'fl')
    union all select name, {TYPE_SQL}, false from {NAMES_SQL}""")(
    lambda spark, sf: files.of_type(named_files(spark, sf), "cr").unionByName(files.of_type(named_files(spark, sf), "fl"))
    .withColumn("kept", F.lit(True)).unionByName(
        files.of_type(named_files(spark, sf), "all").withColumn("kept", F.lit(False)))
    .select("name", files.load_type(F.col("name")).alias("kind"), "kept"))

registry.add("filename_parts", f"""
    select name, split_part(name, '.', 1) as "table", substr(name, instr(name, '.') + 1) as file,
           replace(list_last(string_split(split_part(name, '_', 1), '.')), '-', '') as date
    from {NAMES_SQL}""")(
    lambda spark, sf: named_files(spark, sf).select(
        "name", names.table_part(F.col("name")).alias("table"), names.file_part(F.col("name")).alias("file"),
        names.save_date(F.col("name")).alias("date")))

registry.add("hive_path", f"""
    select name, 'org=acme/table=' || split_part(name, '.', 1) || '/key=' || cast(o_orderkey as varchar) || '/' || name as path
    from {NAMES_SQL}""")(
    lambda spark, sf: named_files(spark, sf).select("name", names.hive_path(
        F.col("name"), org=F.lit("acme"), table=names.table_part(F.col("name")), key=F.col("o_orderkey")).alias("path")))


@registry.add("file_validate", f"""
    select name as file_name, 'landing' as file_location, split_part(name, '.', 1) as table_name,
           replace(list_last(string_split(split_part(name, '_', 1), '.')), '-', '') as date
    from {NAMES_SQL} where not (contains(name, 'all.') or contains(name, 'cr') or contains(name, 'upd') or contains(name, 'del'))""")
def file_validate(spark: SparkSession, sf: str) -> DataFrame:
    """Misnamed files recorded in the control table; a second check of the same files adds nothing."""
    control = f"{work_database(spark, 'control')}.problem_files"
    name = F.col("name")
    bad = named_files(spark, sf).where(filters.misnamed(name)).select(
        name.alias("file_name"), F.lit("landing").alias("file_location"), names.table_part(name).alias("table_name"),
        names.save_date(name).alias("date"))
    for _ in range(2):
        tables.upsert_table(bad, control, ["file_name"])
    return spark.table(control)


@registry.add("zip_expand", "select doc_id, lang, source, text, n_chars from documents")
def zip_expand(spark: SparkSession, sf: str) -> DataFrame:
    """Documents packed into archives of CSV members and taken out again, whole texts included."""
    documents = load(spark, sf, "documents").select("doc_id", "lang", "source", "text", "n_chars")
    packed = pack_records(documents.select(*[F.col(c).cast("string").alias(c) for c in documents.columns]))
    return archives.typed_records(archives.expand_records(packed), documents.schema).drop("path", "member")


ARCHIVE_SQL = f"""select name, case when age > 30 then 'archive' else 'keep' end as action,
    case when age > 30 then 'date=' || substr(replace(list_last(string_split(split_part(name, '_', 1), '.')), '-', ''), 1, 6) end as folder
    from (select *, datediff('day', cast(split_part(split_part(name, '.', 4), '_', 1) as date), date '2000-01-01') as age from {NAMES_SQL})"""

registry.add("archive_split", ARCHIVE_SQL)(
    lambda spark, sf: layout.split_by_age(named_files(spark, sf), ARCHIVE_AS_OF).select("name", "action", "folder"))


#: Files of orders by kind and quarter, named as a ledger drop names them.
QUARTER_SQL = (f"'GL' || left(o_orderpriority, 1) || '.acme.' || {KIND_SQL} || '.' || "
               "cast(cast(date_trunc('quarter', o_orderdate) as date) as varchar) || '_x.csv'")
QUARTERS_SQL = f"(select o_orderkey, o_totalprice, {QUARTER_SQL} as name from orders)"
DAY_SQL = "replace(list_last(string_split(split_part(name, '_', 1), '.')), '-', '')"


def drop_files(spark: SparkSession, sf: str, folder: str, label: str = "") -> None:
    """Orders in files of their kind and quarter, each under its own name; a label goes in front of the file's ending."""
    name = F.replace(F.expr(QUARTER_SQL.replace("varchar", "string")), F.lit("_x.csv"), F.lit(f"_x{label}.csv"))
    named_sink.write_named(load(spark, sf, "orders").withColumn("name", name), folder, F.col("name"), ["o_orderkey", "o_totalprice"])


def file_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all files below a folder with the path they came from."""
    rows = spark.read.schema("o_orderkey bigint, o_totalprice double").option("header", "true").option("recursiveFileLookup", "true").csv(folder)
    return rows.select("o_orderkey", "o_totalprice", F.col("_metadata.file_path").alias("path"))


@registry.add("archive_restore", f"""
    with aged as (select *, datediff('day', cast(substr(split_part(name, '.', 4), 1, 10) as date), date '2000-01-01') > 30 as old
                  from {QUARTERS_SQL})
    select 'archived' as step, case when old then 'date=' || substr({DAY_SQL}, 1, 6) else 'live' end as folder, name, o_orderkey from aged
    union all select 'restored', 'live', name, o_orderkey from aged
    union all select 'restored', 'date=' || substr({DAY_SQL}, 1, 6), name, o_orderkey from aged where old""")
def archive_restore(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by the folder their file is in: after old files were archived (twice, the second moves none) and after all came back."""
    live, archived, path = (work_folder(spark, k) for k in ("live", "archived", "moves"))
    drop_files(spark, sf, live)

    def held(step: str) -> DataFrame:
        at = F.regexp_extract("path", "/(date=[0-9]+)/[^/]*$", 1)
        rows = file_rows(spark, live).unionByName(file_rows(spark, archived))
        kept = work_folder(spark, f"held_{step}")
        rows.select(F.lit(step).alias("step"), F.when(at == "", "live").otherwise(at).alias("folder"),
                    F.substring_index("path", "/", -1).alias("name"), "o_orderkey").write.parquet(kept)
        return spark.read.parquet(kept)

    for run in ("1", "2"):
        moves.archive_old(spark, live, archived, path, run, ARCHIVE_AS_OF)
    before = held("archived")
    moves.restore_all(spark, archived, live, path, "3")
    return before.unionByName(held("restored"))


@registry.add("ingest_new_files", f"""
    select split_part(name, '.', 1) as "table", {DAY_SQL} as date, substr(name, instr(name, '.') + 1) as file,
           case when contains(name, 'all.') then 'first' else 'second' end as run, 'copied' as state, o_orderkey, o_totalprice
    from {QUARTERS_SQL}""")
def ingest_new_files(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of full loads copied to table=/date=/, then all files; the rows of every copy with the run that made it."""
    source, full, target, path = (work_folder(spark, k) for k in ("drop", "full", "copied", "moves"))
    drop_files(spark, sf, source)
    listed = files.inventory(spark, source).select(F.col("path").alias("source"), F.concat(F.lit(f"{full}/"), "name").alias("target"))
    moves.copy_files(spark, listed.where(F.contains("target", F.lit("all."))), path, "0")
    for folder, run in ((full, "first"), (source, "second"), (source, "third")):
        moves.copy_new(spark, folder, target, path, run)
    made = moves.ledger(spark, path).where("state = 'copied' and run <> '0'").select("run", "state", F.col("target").alias("made"))
    rows = file_rows(spark, target)
    place = F.regexp_extract("path", "/(table=.*)$", 1)
    return (rows.join(made, place == F.regexp_extract("made", "/(table=.*)$", 1))
            .select(F.regexp_extract("path", "/table=([^/]*)/", 1).alias("table"), F.regexp_extract("path", "/date=([^/]*)/", 1).alias("date"),
                    F.substring_index("path", "/", -1).alias("file"), "run", "state", "o_orderkey", "o_totalprice"))


MEMBER_NAME_SQL = QUARTER_SQL.replace("'_x.csv'", "'_' || cast(floor(o_orderkey / 40000) as integer) || '.csv'")


@registry.add("archive_members", f"""
    select split_part(name, '.', 1) as "table", {DAY_SQL} as date, substr(name, instr(name, '.') + 1) as file, o_orderkey, o_totalprice
    from (select o_orderkey, o_totalprice, {MEMBER_NAME_SQL} as name from orders)""")
def archive_members(spark: SparkSession, sf: str) -> DataFrame:
    """Archives landed as files, their members taken out as files of their own; a second run finds them there."""
    zips, target, path = (work_folder(spark, k) for k in ("zips", "members", "moves"))
    stores.save(packed_orders(spark, sf), zips)
    for run in ("1", "2"):
        moves.unpack_new(spark, zips, target, path, run)
    return member_rows(spark, target)


def packed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """path, content of archives that hold orders by kind and quarter, in members of bounded size."""
    member = F.expr(MEMBER_NAME_SQL.replace("varchar", "string").replace("integer", "int"))
    lines = load(spark, sf, "orders").groupBy(member.alias("member")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_totalprice"))).alias("rows"))
    body = F.concat(F.lit("o_orderkey,o_totalprice\n"), F.array_join(F.transform("rows", lambda r: F.to_csv(r)), "\n"), F.lit("\n"))
    return pack_members(lines.select("member", body.alias("body")).repartition(4, "member").sortWithinPartitions("member"))


def member_rows(spark: SparkSession, target: str) -> DataFrame:
    return file_rows(spark, target).select(
        F.regexp_extract("path", "/table=([^/]*)/", 1).alias("table"), F.regexp_extract("path", "/date=([^/]*)/", 1).alias("date"),
        F.substring_index("path", "/", -1).alias("file"), "o_orderkey", "o_totalprice")


@registry.add("stream_archive_intake", f"""
    select split_part(name, '.', 1) as "table", {DAY_SQL} as date, substr(name, instr(name, '.') + 1) as file, o_orderkey, o_totalprice,
           1 as times from (select o_orderkey, o_totalprice, {MEMBER_NAME_SQL} as name from orders)""")
def stream_archive_intake(spark: SparkSession, sf: str) -> DataFrame:
    """A drop of archives sent twice under two names, taken in by runs of a stream; how often each member was unpacked."""
    zips, target, path, checkpoint, made = (work_folder(spark, k) for k in ("zips", "members", "moves", "checkpoint", "packed"))
    packed_orders(spark, sf).write.parquet(made)
    packed = spark.read.parquet(made)
    half = F.pmod(F.xxhash64("path"), F.lit(2)) == 0
    for sent in (packed.where(half), packed.withColumn("path", F.concat(F.lit("again-"), "path")), packed.where(~half)):
        stores.save(sent, zips)
        intake.take_in(spark, zips, target, path, checkpoint)
    times = moves.ledger(spark, path).where("step = 1").groupBy(F.regexp_extract("target", "/(table=.*)$", 1).alias("place")).agg(F.count("*").cast("int").alias("times"))
    rows = member_rows(spark, target)
    place = F.concat(F.lit("table="), rows["table"], F.lit("/date="), rows["date"], F.lit("/"), rows["file"])
    return rows.join(times, place == times["place"]).drop("place")


@registry.add("export_named", """
    select o_orderkey, case when day = '20240115' then o_totalprice else -o_totalprice end as o_totalprice,
           'organization=' || o_orderstatus || '/table=orders/' || o_orderstatus || '_orders_' || day || '.csv' as file, 'written' as state
    from orders, (values ('20240115'), ('20240116')) d(day)
    where o_orderstatus <> 'P' or day = '20240116'""")
def export_named(spark: SparkSession, sf: str) -> DataFrame:
    """Exports of organisations and days, each one file of its own name; a later run leaves files that are there."""
    path = work_folder(spark, "named")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("org"))
    first, again = orders.where("org <> 'P'"), orders.withColumn("o_totalprice", F.lit(0.0)).where("org = 'F'")
    second = orders.withColumn("o_totalprice", -F.col("o_totalprice"))
    for rows, day, over in ((first, "20240115", False), (again, "20240115", False), (again, "20240116", False), (second, "20240116", True)):
        report = named_sink.write_named(
            rows, path, F.concat("org", F.lit(f"_orders_{day}.csv")), ["o_orderkey", "o_totalprice"], overwrite=over,
            order=[F.col("o_orderkey")], organization=F.col("org"), table=F.lit("orders"))
    rows = file_rows(spark, path).withColumn("file", F.regexp_extract("path", "/(organization=.*)$", 1))
    state = report.select("name", "state").unionByName(report.select(F.regexp_replace("name", "20240116", "20240115").alias("name"), "state"))
    return rows.join(state, F.col("file") == F.col("name")).select("o_orderkey", "o_totalprice", "file", "state")


@registry.add("table_create", """select *, 'orders' as "__source", '2024-01-15' as "__Date" from orders""")
def table_create(spark: SparkSession, sf: str) -> DataFrame:
    """A table created from old orders and then replaced by all of them, with metadata."""
    name = f"{work_database(spark, 'create')}.orders"
    orders = load(spark, sf, "orders")
    tables.create_table(orders.where("o_orderstatus = 'F'"), name)
    tables.create_table(orders, name, as_of=AS_OF, source="orders")
    return spark.table(name).withColumn("__Date", F.col("__Date").cast("string"))


@registry.add("table_overwrite", "select doc_id, lang, source, n_chars from documents")
def table_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """An overwrite replaces the rows, an empty one is refused."""
    name = f"{work_database(spark, 'overwrite')}.documents"
    documents = load(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    tables.create_table(documents.where("lang = 'en'"), name)
    tables.overwrite_table(documents, name)
    tables.overwrite_table(documents.where(F.lit(False)), name)
    return spark.table(name)


@registry.add("table_drop_column", "select c_custkey, c_name, c_acctbal, c_mktsegment from customer")
def table_drop_column(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{work_database(spark, 'drop_column')}.customer"
    tables.create_table(load(spark, sf, "customer"), name, ["c_mktsegment"])
    tables.drop_column(spark, name, "c_nationkey")
    return spark.table(name)


@registry.add("table_compact", "select o_orderkey, o_custkey, o_orderstatus from orders")
def table_compact(spark: SparkSession, sf: str) -> DataFrame:
    """A partitioned table filled by several appends, then compacted."""
    name = f"{work_database(spark, 'compact')}.orders"
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    for priority in (F.col("o_orderpriority") < "3", F.col("o_orderpriority") >= "3"):
        tables.append_partitioned(orders.where(priority).drop("o_orderpriority"), name, ["o_orderstatus"])
    tables.compact(spark, name)
    return spark.table(name)


@registry.add("write_hive_layout", """
    select o_orderkey, o_totalprice, 'acme' as org, day, o_orderstatus as status
    from orders, (values ('2024-01-15'), ('2024-01-16')) d(day)
    where o_orderstatus <> 'P' or day = '2024-01-15'
    union all select -o_orderkey, o_totalprice, 'acme', '2024-01-17', 'F' from orders where o_orderstatus = 'F'""")
def write_hive_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Two days next to each other; the second write of a third day replaces only that day's folder."""
    path = work_folder(spark, "layout")
    rows = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"))
    done = rows.where("status = 'F'")
    for day, part in (("2024-01-15", rows), ("2024-01-16", rows.where("status <> 'P'")), ("2024-01-17", done),
                      ("2024-01-17", done.withColumn("o_orderkey", -F.col("o_orderkey")))):
        layout.write_layout(part, path, {"org": "acme", "day": day}, ["status"])
    return (spark.read.schema("o_orderkey bigint, o_totalprice double, org string, day string, status string")
            .option("header", "true").csv(path))


@registry.add("write_if_absent", """
    select s_suppkey, s_name, org from supplier, (values ('a'), ('b')) o(org)
    union all select s_suppkey, case when s_nationkey < 5 then s_name else 'other' end, 'by' || cast(s_nationkey as varchar)
    from supplier""")
def write_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """Two organisations, the first written twice; by nation, only the nations not there yet are written."""
    path = work_folder(spark, "absent")
    suppliers = load(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    named, other = suppliers.drop("s_nationkey"), F.lit("other")
    for org, rows in (("a", named), ("b", named), ("a", named.withColumn("s_name", other))):
        layout.write_layout(rows, f"{path}/fixed", {"org": org}, format="parquet", if_absent=True)
    for rows in (suppliers.where("s_nationkey < 5"), suppliers.withColumn("s_name", other)):
        layout.write_layout(rows, f"{path}/nations", by=["s_nationkey"], format="parquet", if_absent=True)
    fixed = spark.read.schema("s_suppkey bigint, s_name string, org string").parquet(f"{path}/fixed")
    nations = spark.read.schema("s_suppkey bigint, s_name string, s_nationkey string").parquet(f"{path}/nations")
    return fixed.unionByName(nations.select("s_suppkey", "s_name", F.concat(F.lit("by"), "s_nationkey").alias("org")))


@registry.add("stream_ingest_files", "select event_id, user_id, event_type, value from events")
def stream_ingest_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files arriving in two steps, ingested by three runs; the last finds nothing new."""
    arrivals, target, checkpoint = (work_folder(spark, f"stream_{k}") for k in ("arrivals", "target", "checkpoint"))
    events = load(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    early = F.col("event_type").isin("click", "view")
    for batch in (events.where(early), events.where(~early), None):
        if batch is not None:
            batch.write.mode("append").parquet(arrivals)
        ingest.ingest_new_files(spark, arrivals, target, checkpoint, events.schema)
    return ingest.landed(spark, target)
