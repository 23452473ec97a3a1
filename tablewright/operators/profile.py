"""Column profiles: one row per column. Only the bounds of quantiles reach the driver; all else is one lazy plan.

Counts and moments of all columns are one plain aggregate, which Spark compiles as a whole.

Distinct values are counted per column: group by the value, then count the groups. Each branch reads only its own
column, so over columnar files all branches together read every column once, no row is replicated the way several
distinct aggregates in one plan would, and a value that fills a third of the rows collapses before the shuffle.

Quantiles are exact at any size: small sketches, merged in two steps, propose brackets, and only the values in a
bracket that exact counts have confirmed are sorted.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sketches only propose brackets: their rank error stays well inside the margin, and exact counts check them.
SKETCH_SIZE, SKETCH_MARGIN = 1000, 0.015
# Values that one task sorts at the end, and rounds of narrowing; 30 brackets of 3% each reach it from any size.
SORTED_VALUES, MOST_ROUNDS = 200_000, 30
QUANTILES = (0.25, 0.5, 0.75)
QUANTILE_NAMES = ("25%", "50%", "75%")

KINDS = {
    "bool": (T.BooleanType,),
    "numeric": (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType),
    "string": (T.StringType,),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
}
NUMERIC_COLUMNS = ("Nulls", "Null%", "Count", "Mean", "Stddev", "Min", *QUANTILE_NAMES, "Max")


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, KINDS[kind])]


def typed_columns(df: DataFrame, kind: str) -> DataFrame:
    return df.select(*[_col(c) for c in columns_of_kind(df, kind)])


def timestamps_as_text(df: DataFrame) -> DataFrame:
    names = columns_of_kind(df, "timestamp")
    return df.withColumns({c: _col(c).cast("string") for c in names}) if names else df


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("TotalRecords"))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """ColumnName, Nulls, Null% for every column, in one pass."""
    names = columns or df.columns
    counted = df.select(*[_col(c) for c in names]).agg(
        F.count("*").alias("rows"), *[F.count(_col(c)).alias(f"n{i}") for i, c in enumerate(names)])
    return _one_row_each(counted, names, lambda i: {
        **_nulls(F.col("rows"), F.col(f"n{i}")),
    })


def bool_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = columns or columns_of_kind(df, "bool")
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(names):
        aggs += [F.count_if(_col(c)).alias(f"t{i}"), F.count_if(~_col(c)).alias(f"f{i}")]
    return _one_row_each(df.select(*[_col(c) for c in names]).agg(*aggs), names, lambda i: {
        "Count": F.col(f"t{i}") + F.col(f"f{i}"),
        "True": F.col(f"t{i}"),
        "False": F.col(f"f{i}"),
        **_nulls(F.col("rows"), F.col(f"t{i}") + F.col(f"f{i}")),
    })


def numeric_profile(df: DataFrame, columns: list[str] | None = None, groups: int | None = None) -> DataFrame:
    """Nulls, Null%, Count, Mean, Stddev, Min, 25%, 50%, 75%, Max per numeric column."""
    names = columns or columns_of_kind(df, "numeric")
    counted = df.select(*[_col(c) for c in names]).agg(
        F.count("*").alias("rows"), *[a for i, c in enumerate(names) for a in _moments(i, c)])
    rows = _one_row_each(counted, names, lambda i: {
        **_nulls(F.col("rows"), F.col(f"n{i}")),
        "Count": F.col(f"n{i}"),
        "Mean": F.col(f"mean{i}"),
        "Stddev": F.col(f"stddev{i}"),
        "Min": F.col(f"min{i}"),
        "Max": F.col(f"max{i}"),
    })
    return rows.join(quantiles(df, names, groups), "ColumnName").select(
        "ColumnName", *[_col(c) for c in NUMERIC_COLUMNS])


def _moments(i: int, name: str) -> list[Column]:
    x = _col(name).cast("double")
    return [F.count(_col(name)).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"stddev{i}"),
            F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]


def quantiles(df: DataFrame, columns: list[str], groups: int | None = None) -> DataFrame:
    """Exact 25%, 50% and 75% per numeric column: the smallest value that such a share of the values does not exceed.

    NULL for a column without values; NaN is the largest value. A sketch proposes a bracket around each quantile, exact
    counts confirm or refuse it, and the bracket is narrowed until its values are few enough to be sorted by one task.
    Only bounds and counts reach the driver, a few numbers per column.
    """
    narrowed = _brackets(df, columns, groups)
    wanted = [b for b in narrowed if b.need and b.found is None]
    known = {(b.column, b.share): b.found for b in narrowed}
    names = df.sparkSession.createDataFrame(
        [(c, *[known[c, share] for share in QUANTILES]) for c in columns], ", ".join(["ColumnName string", *[f"`{q}` double" for q in QUANTILE_NAMES]]))
    if not wanted:
        return names
    any_inside = reduce(lambda a, b: a | b, [b.inside() for b in wanted])
    held = F.array_compact(F.array(*[F.when(b.inside(), F.struct(F.lit(k).alias("k"), b.value().alias("x"))) for k, b in enumerate(wanted)]))
    counted = (df.where(any_inside).select(F.explode(held).alias("h")).select("h.k", "h.x").groupBy("k", "x").agg(F.count("*").alias("n"))
               .withColumn("upto", F.sum("n").over(Window.partitionBy("k").orderBy("x"))))
    need = F.element_at(F.array(*[F.lit(b.need) for b in wanted]), F.col("k") + 1)
    place = F.struct(*[F.element_at(F.array(*[F.lit(getattr(b, a)) for b in wanted]), F.col("k") + 1).alias(a) for a in ("column", "share")])
    found = counted.where((F.col("upto") >= need) & (F.col("upto") - F.col("n") < need)).select(place.alias("p"), "x")
    wide = found.groupBy(F.col("p.column").alias("ColumnName")).agg(*[
        F.max(F.when(F.col("p.share") == share, F.col("x"))).alias(f"__{name}") for share, name in zip(QUANTILES, QUANTILE_NAMES)])
    return names.join(F.broadcast(wide), "ColumnName", "left").select(
        "ColumnName", *[F.coalesce(_col(name), _col(f"__{name}")).alias(name) for name in QUANTILE_NAMES])


@dataclass
class _Bracket:
    """Bounds (None: open; values on them are outside) around one quantile of one column, and the place it has among the values inside.

    `found` is the quantile itself where a bound was it.
    """

    column: str
    share: float
    need: int
    held: int
    low: float | None = None
    high: float | None = None
    found: float | None = None

    def value(self) -> Column:
        return _col(self.column).cast("double")

    def inside(self) -> Column:
        x = self.value()
        bounds = [x.isNotNull()] + ([x > self.low] if self.low is not None else []) + ([x < self.high] if self.high is not None else [])
        return reduce(lambda a, b: a & b, bounds)


def _brackets(df: DataFrame, columns: list[str], groups: int | None) -> list[_Bracket]:
    """Brackets narrowed until few values are inside. A bound that many values share is the quantile or leaves the bracket, so
    columns of few values, which cannot be narrowed by rank, end as soon as others."""
    counts = df.agg(*[F.count(_col(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    found = [_Bracket(c, share, -(-counts[i] * round(100 * share) // 100), counts[i]) for i, c in enumerate(columns) for share in QUANTILES]
    salts = groups or max(1, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    for _ in range(MOST_ROUNDS):
        wide = [b for b in found if b.found is None and b.held > SORTED_VALUES]
        if not wide:
            break
        # Quantiles of a column share a sketch until their brackets part.
        spans = {(b.column, b.low, b.high): b for b in wide}
        sketch_of = {span: f"s{k}" for k, span in enumerate(spans)}
        finite = {sketch_of[span]: F.when(b.inside() & ~F.isnan(b.value()), b.value()) for span, b in spans.items()}
        sketches = (df.groupBy((F.spark_partition_id() % salts).alias("salt"))
                    .agg(*[F.kll_sketch_agg_double(x, F.lit(SKETCH_SIZE)).alias(s) for s, x in finite.items()])
                    .agg(*[F.kll_merge_agg_double(s).alias(s) for s in finite]))

        def bound(b: _Bracket, share: float) -> Column:
            sketch = F.col(sketch_of[b.column, b.low, b.high])
            return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(min(1.0, max(0.0, share)))))

        at = sketches.select(*[bound(b, b.need / b.held + side * SKETCH_MARGIN).alias(f"{name}{k}")
                               for k, b in enumerate(wide) for side, name in ((-1, "low"), (1, "high"))]).first()
        tried = [(b, at[f"low{k}"], at[f"high{k}"]) for k, b in enumerate(wide)]
        checks = df.agg(*[F.count_if(b.inside() & test).alias(f"{name}{k}") for k, (b, low, high) in enumerate(tried) for name, test in (
            ("below", b.value() < F.lit(low)), ("low", b.value() <= F.lit(low)), ("under", b.value() < F.lit(high)), ("upto", b.value() <= F.lit(high)))]).first()
        for k, (b, low, high) in enumerate(tried):
            below, at_low, under, upto = (checks[f"{name}{k}"] for name in ("below", "low", "under", "upto"))
            if low is None or not below < b.need <= upto:
                continue
            if b.need <= at_low:
                b.found = low
            elif b.need > under:
                b.found = high
            else:
                b.need, b.held, b.low, b.high = b.need - at_low, under - at_low, low, high
    return found


def string_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct (NULL counts as one value), Nulls, Null%, Count per string column."""
    return distinct_counts(df, columns or columns_of_kind(df, "string")).select(
        "ColumnName", "Distinct", *_null_columns(), F.col("values").alias("Count"))


def timestamp_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return distinct_counts(df, columns or columns_of_kind(df, "timestamp")).select(
        "ColumnName", "Distinct", *_null_columns(), F.col("values").alias("Count"), "Min", "Max")


def distinct_value_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """TotalRecords, TotalValues (without NULL) and DistinctCount (with NULL) of string and numeric columns."""
    names = columns or columns_of_kind(df, "string") + columns_of_kind(df, "numeric")
    return distinct_counts(df, names).select(
        "ColumnName", F.col("rows").alias("TotalRecords"), F.col("values").alias("TotalValues"),
        F.col("Distinct").alias("DistinctCount"),
    ).orderBy(F.col("DistinctCount").desc(), "ColumnName")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """ColumnName, rows, values (not NULL), Distinct (NULL is a value), Min and Max as text."""
    n = F.col("n")
    return reduce(DataFrame.unionByName, [
        df.select(_col(c).alias("value")).groupBy("value").agg(F.count("*").alias("n")).agg(
            F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), n)), F.lit(0)).alias("values"),
            F.count("*").alias("Distinct"),
            F.min("value").cast("string").alias("Min"),
            F.max("value").cast("string").alias("Max"),
        ).withColumn("ColumnName", F.lit(c))
        for c in columns])


#: Relative standard deviation of sketched distinct counts; five of them are 5 %.
SKETCH_RSD = 0.01


def approx_distinct_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Same shape from HyperLogLog sketches: no row is replicated, one small buffer per column and task."""
    names = columns or columns_of_kind(df, "string") + columns_of_kind(df, "numeric")
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(names):
        aggs += [F.count(_col(c)).alias(f"n{i}"), F.approx_count_distinct(_col(c), SKETCH_RSD).alias(f"d{i}")]
    return _one_row_each(df.select(*[_col(c) for c in names]).agg(*aggs), names, lambda i: {
        "TotalRecords": F.col("rows"),
        "TotalValues": F.col(f"n{i}"),
        "DistinctCount": F.col(f"d{i}") + (F.col("rows") > F.col(f"n{i}")).cast("bigint"),
    })


def value_frequencies(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """How often each value of each string column occurs; NULL is a value of its own."""
    names = columns or columns_of_kind(df, "string")
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(c).alias("ColumnName"), _col(c).alias("ColumnValue"))
        .groupBy("ColumnName", "ColumnValue").agg(F.count("*").alias("DistinctCount"))
        for c in names])


def full_profile(df: DataFrame) -> DataFrame:
    """Every profile on one shared layout: one row per boolean, numeric, string or timestamp column."""
    kind_of = {c: kind for kind in KINDS for c in columns_of_kind(df, kind)}
    names = list(kind_of)
    numbers = [c for c, kind in kind_of.items() if kind == "numeric"]
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(names):
        if kind_of[c] == "numeric":
            aggs += _moments(i, c)
        else:
            aggs.append(F.count(_col(c)).alias(f"n{i}"))
        if kind_of[c] == "bool":
            aggs += [F.count_if(_col(c)).alias(f"t{i}"), F.count_if(~_col(c)).alias(f"f{i}")]
        if kind_of[c] == "timestamp":
            aggs += [F.min(_col(c)).alias(f"min{i}"), F.max(_col(c)).alias(f"max{i}")]

    def metrics(i: int) -> dict[str, Column]:
        kind = kind_of[names[i]]

        def only(column: str, *kinds: str) -> Column:
            return F.col(f"{column}{i}") if kind in kinds else F.lit(None)

        return {
            "Kind": F.lit(kind),
            "Count": F.col(f"n{i}"),
            **_nulls(F.col("rows"), F.col(f"n{i}")),
            "True": only("t", "bool").cast("bigint"),
            "False": only("f", "bool").cast("bigint"),
            "Mean": only("mean", "numeric").cast("double"),
            "Stddev": only("stddev", "numeric").cast("double"),
            "Min": only("min", "numeric", "timestamp").cast("string"),
            "Max": only("max", "numeric", "timestamp").cast("string"),
        }

    result = _one_row_each(df.select(*[_col(c) for c in names]).agg(*aggs), names, metrics)
    valued = [c for c in names if kind_of[c] != "bool"]
    if valued:
        result = result.join(distinct_counts(df, valued).select("ColumnName", "Distinct"), "ColumnName", "left")
    if numbers:
        result = result.join(quantiles(df, numbers), "ColumnName", "left")
    missing = {c: F.lit(None).cast("bigint" if c == "Distinct" else "double")
               for c in ("Distinct", *QUANTILE_NAMES) if c not in result.columns}
    return result.withColumns(missing) if missing else result


def with_source(df: DataFrame, database: str, table: str) -> DataFrame:
    return df.withColumns({"SourceDatabase": F.lit(database.lower()), "SourceTable": F.lit(table.lower())})


def metric_rows(profile: DataFrame, metrics: tuple[str, ...], columns: list[str]) -> DataFrame:
    """Turn a profile (a row per column) into a row per metric and a column per profiled column."""
    long = profile.select("ColumnName", *[_col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ["ColumnName"], [_col(m) for m in metrics], "summary", "value")
    return long.groupBy("summary").pivot("ColumnName", columns).agg(F.first("value"))


def transpose_metrics(rows: DataFrame, metrics: tuple[str, ...], label: str = "summary") -> DataFrame:
    """Turn a row per metric into a row per column; metric names come out in title case."""
    columns = [c for c in rows.columns if c != label]
    wide = (rows.unpivot([label], [_col(c) for c in columns], "ColumnName", "value")
            .groupBy("ColumnName").pivot(label, list(metrics)).agg(F.first("value")))
    return wide.select("ColumnName", *[_col(m).alias(m.title() if m.isalpha() else m.capitalize()) for m in metrics])


def first_valid(df: DataFrame, column: str, order: str) -> DataFrame:
    """First value of a column that is not NULL, in the given order."""
    return df.where(_col(column).isNotNull()).agg(F.min_by(_col(column), _col(order)).alias(column))


def users_by_month(df: DataFrame, instant: str, channel: str, user: str, start: str, end: str,
                   by: list[str] | None = None) -> DataFrame:
    """Distinct users per year, month and channel of a date range (both ends included).

    Users are made distinct before they are counted, so a month that holds most rows is spread by user.
    """
    t = _col(instant)
    in_range = (t >= F.lit(start).cast("timestamp_ntz")) & (
        t < (F.lit(end).cast("date") + F.expr("interval 1 day")).cast("timestamp_ntz"))
    return (df.where(in_range)
            .select(F.year(t).alias("Year"), F.month(t).alias("Month"), _col(channel).alias("defaultChannelGrouping"),
                    *[_col(c) for c in by or []], _col(user).alias("user"))
            .distinct()
            .groupBy("Year", "Month", "defaultChannelGrouping", *(by or []))
            .agg(F.count("user").alias("Users")))


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _nulls(rows: Column, n: Column) -> dict[str, Column]:
    return {"Nulls": rows - n, "Null%": F.try_divide(F.lit(100) * (rows - n), rows).cast("decimal(5,2)")}


def _null_columns() -> list[Column]:
    return [c.alias(k) for k, c in _nulls(F.col("rows"), F.col("values")).items()]


def _one_row_each(aggregated: DataFrame, names: list[str], metrics) -> DataFrame:
    """Spread the single aggregate row into one row per column."""
    structs = [
        F.struct(F.lit(c).alias("ColumnName"), *[v.alias(k) for k, v in metrics(i).items()])
        for i, c in enumerate(names)
    ]
    return aggregated.select(F.inline(F.array(*structs)))
