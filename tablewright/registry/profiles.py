"""Registered queries: profiles."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators import profile, sketches
from tablewright.registry.common import AS_OF, Registry, load
from tablewright.plans import flows
from tablewright.session import work_database

registry = Registry()

LINES_SQL = """(select l_orderkey, l_partkey, l_quantity, l_extendedprice, l_tax,
    case when l_linenumber = 3 then null else l_discount end as l_discount,
    case when l_linestatus = 'F' and l_linenumber = 2 then null else l_returnflag = 'R' end as returned,
    l_shipdate >= timestamp '1998-01-01' as late,
    nullif(l_linestatus, 'F') as l_linestatus, l_returnflag, l_shipdate from lineitem)"""
NUMBERS = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_tax", "l_discount"]
TEXTS = ["l_linestatus", "l_returnflag"]
FLAGS = ["returned", "late"]


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with NULLs and booleans derived from its own columns."""
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_tax",
        F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("l_discount"),
        F.when(~((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 2)), F.col("l_returnflag") == "R").alias("returned"),
        (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).alias("late"),
        F.nullif(F.col("l_linestatus"), F.lit("F")).alias("l_linestatus"), "l_returnflag", "l_shipdate")


def per_column(names: list[str], select: str, source: str = LINES_SQL) -> str:
    return " union all ".join(
        "select '{c}' as \"ColumnName\", {body} from {source} t".format(c=c, body=select.replace("{c}", c), source=source)
        for c in names)


NULLS_SQL = """count(*) - count({c}) as "Nulls",
    cast(case when count(*) = 0 then null else 100.0 * (count(*) - count({c})) / count(*) end as decimal(5,2)) as "Null%" """
NUMERIC_SQL = NULLS_SQL + """, count({c}) as "Count", round(avg({c}), 4) as "Mean", round(stddev_samp({c}), 4) as "Stddev",
    cast(min({c}) as double) as "Min", cast(quantile_disc({c}, 0.25) as double) as "25%",
    cast(quantile_disc({c}, 0.5) as double) as "50%", cast(quantile_disc({c}, 0.75) as double) as "75%",
    cast(max({c}) as double) as "Max" """
DISTINCT_SQL = 'count(distinct {c}) + cast(count(*) > count({c}) as bigint)'
BOOL_SQL = """cast(count({c}) as bigint) as "Count", cast(count(*) filter ({c}) as bigint) as "True",
    cast(count(*) filter (not {c}) as bigint) as "False", """ + NULLS_SQL


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in ("Mean", "Stddev")})


registry.add("profile_row_count", 'select count(*) as "TotalRecords" from lineitem')(
    lambda spark, sf: profile.row_count(load(spark, sf, "lineitem")))

registry.add("profile_nulls", per_column(NUMBERS + FLAGS + TEXTS + ["l_shipdate"], NULLS_SQL))(
    lambda spark, sf: profile.null_counts(lines(spark, sf)))

registry.add("profile_bool", per_column(FLAGS, BOOL_SQL))(
    lambda spark, sf: profile.bool_profile(lines(spark, sf)))

registry.add("profile_numeric", per_column(NUMBERS, NUMERIC_SQL))(
    lambda spark, sf: rounded(profile.numeric_profile(lines(spark, sf))))

registry.add("profile_string", per_column(
    TEXTS, DISTINCT_SQL + ' as "Distinct", ' + NULLS_SQL + ', count({c}) as "Count"'))(
    lambda spark, sf: profile.string_profile(lines(spark, sf)))

registry.add("profile_timestamp", per_column(
    ["ts"], DISTINCT_SQL + ' as "Distinct", ' + NULLS_SQL + """, count({c}) as "Count",
    cast(min({c}) as varchar) as "Min", cast(max({c}) as varchar) as "Max" """, "events"))(
    lambda spark, sf: profile.timestamp_profile(load(spark, sf, "events")))

registry.add("distinct_value_summary", per_column(
    TEXTS + NUMBERS, 'count(*) as "TotalRecords", count({c}) as "TotalValues", ' + DISTINCT_SQL + ' as "DistinctCount"'))(
    lambda spark, sf: profile.distinct_value_summary(lines(spark, sf)))

FREQUENCY_SQL = " union all ".join(
    f"""select '{c}' as "ColumnName", {c} as "ColumnValue", count(*) as "DistinctCount" from documents group by {c}"""
    for c in ("text", "lang", "source"))
registry.add("value_frequencies", FREQUENCY_SQL)(
    lambda spark, sf: profile.value_frequencies(load(spark, sf, "documents")))

TRANSPOSED = ("count", "null%", "mean", "stddev")


@registry.add("profile_transpose", per_column(NUMBERS, """cast(count({c}) as double) as "Count",
    cast(cast(100.0 * (count(*) - count({c})) / count(*) as decimal(5,2)) as double) as "Null%",
    round(avg({c}), 4) as "Mean", round(stddev_samp({c}), 4) as "Stddev" """))
def profile_transpose(spark: SparkSession, sf: str) -> DataFrame:
    summary = profile.numeric_profile(lines(spark, sf)).select(
        "ColumnName", *[F.col(f"`{m.capitalize()}`").alias(m) for m in TRANSPOSED])
    rows = profile.metric_rows(summary, TRANSPOSED, NUMBERS)
    return rounded(profile.transpose_metrics(rows, TRANSPOSED))


NONE = {k: f'cast(null as {t}) as "{k}"' for k, t in {
    "Distinct": "bigint", "True": "bigint", "False": "bigint", "Min": "varchar", "Max": "varchar", "Mean": "double",
    "Stddev": "double", "25%": "double", "50%": "double", "75%": "double"}.items()}


def full_sql(kind: str, names: list[str], **own: str) -> str:
    parts = {**NONE, **{k: f'{v} as "{k}"' for k, v in own.items()}}
    return per_column(names, f"""'{kind}' as "Kind", count({{c}}) as "Count", {NULLS_SQL}, """ + ", ".join(parts.values()))


FULL_SQL = " union all ".join([
    full_sql("numeric", NUMBERS, **{
        "Distinct": DISTINCT_SQL, "Min": "cast(round(min({c}), 4) as varchar)", "Max": "cast(round(max({c}), 4) as varchar)",
        "Mean": "round(avg({c}), 4)", "Stddev": "round(stddev_samp({c}), 4)",
        **{f"{q}%": "cast(quantile_disc({c}, 0.%d) as double)" % q for q in (25, 50, 75)}}),
    full_sql("string", TEXTS, Distinct=DISTINCT_SQL),
    full_sql("timestamp", ["l_shipdate"], Distinct=DISTINCT_SQL, Min="cast(min({c}) as varchar)",
             Max="cast(max({c}) as varchar)"),
    full_sql("bool", FLAGS, **{"True": "count(*) filter ({c})", "False": "count(*) filter (not {c})"}),
])
# both engines write the bounds of numbers as double text
FULL_SQL = FULL_SQL.replace("cast(round(min(", "cast(cast(round(min(").replace("cast(round(max(", "cast(cast(round(max(").replace(
    ", 4) as varchar)", ", 4) as double) as varchar)")
registry.add("profile_full", FULL_SQL)(lambda spark, sf: rounded(profile.full_profile(lines(spark, sf))))

registry.add("users_by_month_channel", """
    select cast(year(ts) as integer) as "Year", cast(month(ts) as integer) as "Month",
           event_type as "defaultChannelGrouping", count(distinct user_id) as "Users"
    from events where ts >= timestamp '2024-01-01' and ts < timestamp '2024-02-01' group by 1, 2, 3""")(
    lambda spark, sf: profile.users_by_month(load(spark, sf, "events"), "ts", "event_type", "user_id",
                                             "2024-01-01", "2024-01-31"))

registry.add("first_valid", """
    select min_by(seg, c_custkey) as seg
    from (select c_custkey, nullif(c_mktsegment, 'HOUSEHOLD') as seg from customer) where seg is not null""")(
    lambda spark, sf: profile.first_valid(
        load(spark, sf, "customer").select(
            "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("seg")), "seg", "c_custkey"))



@registry.add("approx_distinct_summary", """
    select unnest(['l_orderkey', 'l_partkey', 'l_quantity', 'l_extendedprice', 'l_tax', 'l_discount', 'l_linestatus',
                   'l_returnflag']) as "ColumnName", (select count(*) from lineitem) as "TotalRecords", true as close""")
def approx_distinct_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Sketched counts that are within 5 % of the exact ones."""
    rough = profile.approx_distinct_summary(lines(spark, sf))
    exact = profile.distinct_value_summary(lines(spark, sf)).select("ColumnName", F.col("DistinctCount").alias("exact"))
    near = F.abs(F.col("DistinctCount") - F.col("exact")) <= F.col("exact") * 0.05
    return rough.join(exact, "ColumnName").select("ColumnName", "TotalRecords", near.alias("close"))


@registry.add("profile_united", """
    select c as "ColumnName", (select count(*) from lineitem) as "TotalRecords", (select count(*) from lineitem) as "TotalValues",
           true as distinct_close, true as quartiles_close, case c when 'l_returnflag' then (
               select max(n) from (select count(*) as n from lineitem group by l_returnflag)) end as most
    from (values ('l_orderkey'), ('l_quantity'), ('l_extendedprice'), ('l_returnflag')) v(c)""")
def profile_united(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches stored for three days, united without a rescan, held against exact counts and ranks within the stated bounds."""
    name, numbers = f"{work_database(spark, 'states')}.states", ["l_orderkey", "l_quantity", "l_extendedprice"]
    rows = load(spark, sf, "lineitem").select(*numbers, "l_returnflag")
    days = [AS_OF + timedelta(days=d) for d in range(3)]
    for n, day in enumerate(days):
        sketches.keep(sketches.state(rows.where(F.col("l_orderkey") % 3 == n), rows.columns), name, day)
    rough = {r.ColumnName: r for r in sketches.profile_of(spark, name, days[0], days[2]).collect()}  # one row per column
    ranks = [F.avg((F.col(c) <= rough[c][q]).cast("double")).alias(f"{c}{q}") for c in numbers for q in sketches.QUARTILES]
    below = [F.avg((F.col(c) < rough[c][q]).cast("double")).alias(f"{c}<{q}") for c in numbers for q in sketches.QUARTILES]
    exact = rows.agg(*ranks, *below, *[F.count_distinct(c).alias(f"{c}#") for c in rows.columns]).first()
    checked = [(c, r.TotalRecords, r.TotalValues, abs(r.DistinctCount - exact[f"{c}#"]) <= 0.03 * exact[f"{c}#"],
                all(exact[f"{c}<{q}"] - 0.01 <= share <= exact[f"{c}{q}"] + 0.01 for q, share in sketches.QUARTILES.items()) if c in numbers else True,
                r.Frequent[0]["count"] if r.Frequent else None) for c, r in rough.items()]
    return spark.createDataFrame(checked, "ColumnName string, TotalRecords long, TotalValues long, distinct_close boolean, quartiles_close boolean, most long")


STORED_COLUMNS = """, 'lake' as "SourceDatabase", 'lineitem' as "SourceTable", '2024-01-15' as "__date" """


@registry.add("profile_write", per_column(
    NUMBERS, NUMERIC_SQL + STORED_COLUMNS))
def profile_write(spark: SparkSession, sf: str) -> DataFrame:
    """Append the numeric profile to a partitioned summary table and read it back."""
    from tablewright.operators import tables

    name = f"{work_database(spark, 'profiles')}.numeric_summary"
    stamped = profile.with_source(rounded(profile.numeric_profile(lines(spark, sf))), "Lake", "LineItem").withColumn(
        "__date", F.lit(AS_OF).cast("date"))
    tables.append_partitioned(stamped, name, flows.PROFILE_PARTITIONS)
    return spark.table(name).withColumn("__date", F.col("__date").cast("string"))


FLOW_SQL = " union all ".join([
    per_column(NUMBERS, """'numeric_summary' as summary, count({c}) as value"""),
    per_column(TEXTS, "'string_summary' as summary, " + DISTINCT_SQL + " as value"),
    per_column(FLAGS, "'bool_summary' as summary, count(*) filter ({c}) as value"),
    per_column(["l_shipdate"], "'timestamp_summary' as summary, " + DISTINCT_SQL + " as value"),
    per_column(TEXTS + NUMBERS, "'distinct_values_summary' as summary, " + DISTINCT_SQL + " as value"),
    per_column(TEXTS, "'unique_string_values_summary' as summary, count(*) as value"),
])


QUARTILES = ("25%", "50%", "75%")


@registry.add("flow_profile", f'select "ColumnName", cast(value as double) as value, summary from ({FLOW_SQL})' + "".join(
    f' union all select "ColumnName", "{q}", \'{q}\' from ({per_column(NUMBERS, NUMERIC_SQL)})' for q in QUARTILES))
def flow_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Profile a table, store every summary, and read one figure per column from each stored table, and the quartiles."""
    database = work_database(spark, "flow_profile")
    written = flows.store_profile(lines(spark, sf), "lake", "lineitem", database, AS_OF)
    figure = {"numeric_summary": "Count", "string_summary": "Distinct", "bool_summary": "True",
              "timestamp_summary": "Distinct", "distinct_values_summary": "DistinctCount",
              "unique_string_values_summary": "DistinctCount"}
    frames = []
    for name in written:
        summary = name.split(".")[1]
        frames.append(spark.table(name).groupBy("ColumnName").agg(F.sum(F.col(figure[summary])).cast("double").alias("value"))
                      .withColumn("summary", F.lit(summary)))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    stored = spark.table(f"{database}.numeric_summary").select("ColumnName", *[F.col(f"`{q}`").alias(q) for q in QUARTILES])
    return result.unionByName(stored.unpivot(["ColumnName"], [F.col(f"`{q}`") for q in QUARTILES], "summary", "value"))
