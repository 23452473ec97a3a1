"""User-level flows, composed of the operators."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import names
from tablewright.operators import columns, filters, joins, layout, named_files, nested, paging, profile, tables
from tablewright.schemas import (INVOICE_MAP_KEYS, INVOICE_TYPED_KEYS, JOB_FILLED_IDS, LEAD_SOURCE_KEYS, dataset_name,
                                 dataset_schema)
from tablewright.session import work_folder
from tablewright.sources import archives, delimited, files, paged_json

PROFILE_PARTITIONS = ["__date", "SourceDatabase", "SourceTable"]


def store_profile(df: DataFrame, database: str, table: str, profile_db: str, as_of: date) -> list[str]:
    """Profile a frame and append each summary to its table; kinds without columns are skipped.

    Returns the names of the tables written. Only the partition of this run is compacted.
    """
    spark = df.sparkSession
    makers = {
        "bool_summary": ("bool", profile.bool_profile),
        "numeric_summary": ("numeric", profile.numeric_profile),
        "string_summary": ("string", profile.string_profile),
        "timestamp_summary": ("timestamp", profile.timestamp_profile),
        "unique_string_values_summary": ("string", profile.value_frequencies),
    }
    frames = {name: make(df) for name, (kind, make) in makers.items() if profile.columns_of_kind(df, kind)}
    if profile.columns_of_kind(df, "string") or profile.columns_of_kind(df, "numeric"):
        frames["distinct_values_summary"] = profile.distinct_value_summary(df)
    day, keys = F.lit(as_of).cast("date"), {"SourceDatabase": database.lower(), "SourceTable": table.lower()}

    def append(item: tuple[str, DataFrame]) -> None:
        stamped = profile.with_source(item[1], database, table).withColumn("__date", day)
        tables.append_partitioned(stamped, f"{profile_db}.{item[0]}", PROFILE_PARTITIONS)

    tables.ensure_database(spark, profile_db)
    with ThreadPoolExecutor(len(frames) or 1) as pool:
        list(pool.map(append, frames.items()))
    run = (F.col("__date") == day) & reduce(lambda a, b: a & b, [F.col(k) == v for k, v in keys.items()])
    for name in frames:
        tables.compact(spark, f"{profile_db}.{name}", run)
    return [f"{profile_db}.{name}" for name in frames]


def ledger_frame(spark: SparkSession, folder: str, kind: str, schema: T.StructType, sep: str = "|",
                 read_time: str = "ddsReadTime") -> DataFrame:
    """All files of a load type below a folder as one frame, with the load day of each row.

    The type is matched on the file name by the reader, so no file list passes through the driver.
    """
    globs = {"all": "*", "fl": "*all.*",
             **{k: f"{{*change.*_{k}_*,*_{k}_*change.*}}" for k in ("cr", "upd", "del")}}
    rows = delimited.read_delimited(spark, folder, schema, sep, pathGlobFilter=globs[kind], recursiveFileLookup="true")
    return columns.load_date(rows, read_time)


def mixed_ledger_frame(spark: SparkSession, folder: str, kind: str, types: dict[str, str], drop: list[str],
                       sep: str = "|", read_time: str = "ddsReadTime") -> DataFrame | None:
    """As ledger_frame, for files whose headers differ; None when there is no file of the type."""
    listed = files.of_type(files.inventory(spark, folder), kind).select("path").collect()  # file names only
    if not listed:
        return None
    rows = delimited.read_mixed(spark, [f.path for f in listed], types, drop, sep)
    return columns.load_date(rows, read_time)


def load_ledger(spark: SparkSession, folder: str, kind: str, schema: T.StructType, table: str) -> None:
    tables.create_table(ledger_frame(spark, folder, kind, schema), table)


def unpack_drop(packed: DataFrame) -> DataFrame:
    """Records of a drop of archives with the table, file and day their member names say."""
    member = F.col("member")
    return archives.expand_records(packed).withColumns({
        "table": names.table_part(member), "file": names.file_part(member), "date": names.save_date(member)})


def problem_files(drop: DataFrame, location: str) -> DataFrame:
    """Control rows for members whose names fit no load type."""
    seen = drop.select("member", "table", "date").distinct()
    return seen.where(filters.misnamed(F.col("member"))).select(
        F.col("member").alias("file_name"), F.lit(location).alias("file_location"),
        F.col("table").alias("table_name"), F.col("date").cast("string").alias("date"))


#: Folders that the archives of a table and day are dealt into.
DROP_FOLDERS = 8
DROP_LAYERS = ["table", "date", "drop"]


def land_drop(packed: DataFrame, target: str, control_table: str) -> DataFrame:
    """Unpack a drop, land it under table=/date=/drop=, record problem files, and return all landed records.

    drop= is one of a few folders, chosen by the archive's path, so their number does not grow with that of archives.
    Earlier drops stay, and an archive that comes again replaces itself: folders that hold rows of it are written anew with
    the rows of all other archives, and every other folder is only added to.
    """
    spark = packed.sparkSession
    records = unpack_drop(packed).withColumns({
        "table": F.nullif("table", F.lit("")), "date": F.nullif("date", F.lit("")),
        "drop": F.pmod(F.xxhash64("path"), F.lit(DROP_FOLDERS)).cast("string")})
    held = _landed(spark, target)
    if held is None:
        layout.write_layout(records, target, by=DROP_LAYERS, format="parquet", skip_empty=False)
    else:
        folder = work_folder(spark, "drop")
        records.write.parquet(folder)  # unpacked once, read several times
        _replace_archives(held, spark.read.schema(records.schema).parquet(folder), target)
    landed = _landed(spark, target).drop("drop")
    tables.upsert_table(problem_files(landed, target), control_table, ["file_name"])
    return landed


def _landed(spark: SparkSession, target: str) -> DataFrame | None:
    """All landed records, or None where nothing has landed."""
    try:
        return spark.read.schema(f"{archives.RECORD_SCHEMA}, file string, `table` string, date string, `drop` string").parquet(target)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _replace_archives(held: DataFrame, records: DataFrame, target: str) -> None:
    """Land records beside those held, without what is held of their archives in the same table and day."""
    def same(rows: DataFrame, others: DataFrame, by: list[str], how: str) -> DataFrame:
        named = others.select(*[F.col(c).alias(f"__{c}") for c in by]).distinct()
        return rows.join(named, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]), how)

    again = same(held.select("path", *DROP_LAYERS).distinct(), records, ["path", *DROP_LAYERS], "left_semi").select(*DROP_LAYERS).distinct()
    again = again.sparkSession.createDataFrame(again.collect(), again.schema)  # names of folders only
    if not again.isEmpty():
        stay = same(same(held, again, DROP_LAYERS, "left_semi"), records, ["path", *DROP_LAYERS], "left_anti")
        layout.write_layout(stay.unionByName(same(records, again, DROP_LAYERS, "left_semi")), target, by=DROP_LAYERS, format="parquet", skip_empty=False)
    layout.write_layout(same(records, again, DROP_LAYERS, "left_anti"), target, by=DROP_LAYERS, format="parquet", skip_empty=False, mode="append")


def dataset_frame(records: DataFrame, alias: str) -> DataFrame:
    """Typed flat frame of a dataset's records: one row per record, per item of an invoice, or per tag of a job."""
    name = dataset_name(alias)
    if name is None:
        raise ValueError(f"no dataset is called {alias}")
    if name == "invoice-items":
        return nested.parse_items(records)
    if name == "job-tag-types":
        links = nested.explode_ids(records, "tagTypeIds", "tagTypeId", jobId="id", tenantId="tenantId")
        return columns.conform(links, dataset_schema(name))
    if name == "invoices":
        records = columns.flatten_maps(records, INVOICE_MAP_KEYS, INVOICE_TYPED_KEYS)
    elif name == "jobs":
        records = columns.extract_keys(columns.fill_ids(records, JOB_FILLED_IDS), "jobGeneratedLeadSource",
                                       LEAD_SOURCE_KEYS)
    elif name == "calls":
        records = nested.parse_calls(records)
    schema = dataset_schema(name)
    return columns.conform(records, schema) if schema else records


def pull_dataset(spark: SparkSession, path: str, alias: str, record: T.StructType, rejects: str | None = None) -> DataFrame:
    """All records of the pages below path, refused when a source has fewer than it announced.

    With the name of a rejects table nothing is refused: pages that can be read are kept, the others are appended there.
    """
    if rejects:
        good, bad = paged_json.sorted_out(spark, path, record)
        tables.append_partitioned(bad, rejects, [])
        return dataset_frame(paged_json.records_of(good), alias)
    pages = paged_json.read_pages(spark, path, record)
    short = joins.expected_rows(pages).where("not complete").take(1)
    if short:
        raise ValueError(f"pages are missing: {short[0].asDict()}")
    return dataset_frame(paged_json.records_of(pages), alias)


def export_raw(frame: DataFrame, folder: str, organization: Column, alias: str, as_of: date) -> DataFrame:
    """One CSV file per organisation, organization=/table=/<organisation>_<dataset>_<YYYYMMDD>.csv, replaced if it is there.

    Returns what became of every file; an empty frame gives none.
    """
    name = dataset_name(alias)
    if name is None:
        raise ValueError(f"no dataset is called {alias}")
    file = F.concat(organization, F.lit(f"_{name}_{as_of:%Y%m%d}.csv"))
    return named_files.write_named(frame, folder, file, overwrite=True, organization=organization, table=F.lit(name))


def collect_analytics(rows: DataFrame, accounts: DataFrame, instant: str, channel: str, user: str, view: str,
                      start: str, end: str) -> DataFrame:
    """Users per month, channel and view, with the attributes of the view's account."""
    counted = profile.users_by_month(rows, instant, channel, user, start, end, [view])
    return joins.pair_accounts(counted.withColumnRenamed(view, "viewId"), accounts, "viewId")


def upsert_analytics(frame: DataFrame, table: str, as_of: date) -> None:
    """Merge counts into a table by year and month: only months that were collected again are rewritten."""
    keys = ["Year", "Month", "defaultChannelGrouping", "viewId"]
    stamped = columns.append_metadata(frame, as_of)
    tables.upsert_table(stamped, table, keys, ["Users", "__Date"], partition_by=["Year", "Month"])


def sheet_run(listing: DataFrame, token: str, second_run: Column | bool | None, key: str = "id", name: str = "name"
              ) -> DataFrame:
    """Sheets of a clone run with the file each one goes to.

    With a run given: sheets whose name holds the token, first or second half. With None: all the others.
    """
    if second_run is None:
        chosen = filters.without_token(listing, name, token)
    else:
        chosen = paging.run_half(filters.with_token(listing, name, token), key, bool(second_run))
    return chosen.withColumn("file_name", F.concat(names.normalised(F.col(name)), F.lit(".csv")))


def pull_budget(df: DataFrame, where: Column, path: str, as_of: date) -> DataFrame:
    """All detail rows of a budget, exported under the day of the pull and returned."""
    rows = paging.all_details(df, where)
    layout.write_layout(rows, path, {"metadata_Date": as_of.isoformat()}, format="csv")
    return rows
