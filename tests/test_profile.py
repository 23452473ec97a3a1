import math
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tablewright.operators import profile
from tablewright.plans import flows
from tablewright.registry.common import AS_OF

SCHEMA = "id bigint, small smallint, price double, name string, ok boolean, at timestamp, at_plain timestamp_ntz, raw binary, tags array<string>, `odd name` int"


def sample(spark):
    t = datetime(2024, 1, 1, 12)
    return spark.createDataFrame([
        (1, 1, 1.5, "a", True, t, t, b"x", ["q"], 1),
        (2, 1, None, "a", None, None, t, b"y", [], 2),
        (3, None, 2.5, None, False, t, None, None, None, None),
        (4, 2, 3.5, "b", True, t, t, b"z", ["r"], 4),
    ], SCHEMA)


def rows(df, key="ColumnName"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_kinds_leave_out_binary_and_complex_columns(spark):
    df = sample(spark)
    assert profile.columns_of_kind(df, "numeric") == ["id", "small", "price", "odd name"]
    assert profile.columns_of_kind(df, "timestamp") == ["at", "at_plain"]
    assert profile.typed_columns(df, "string").columns == ["name"]
    assert dict(profile.timestamps_as_text(df).dtypes)["at"] == "string"


def test_null_counts_and_percent(spark):
    found = rows(profile.null_counts(sample(spark), ["id", "name", "odd name"]))
    assert found["name"]["Nulls"] == 1 and found["name"]["Null%"] == Decimal("25.00")
    assert found["id"]["Nulls"] == 0
    assert found["odd name"]["Nulls"] == 1


def test_bool_profile(spark):
    assert rows(profile.bool_profile(sample(spark)))["ok"] == {
        "ColumnName": "ok", "Count": 3, "True": 2, "False": 1, "Nulls": 1, "Null%": Decimal("25.00")}


def test_numeric_profile(spark):
    found = rows(profile.numeric_profile(sample(spark)))["price"]
    assert (found["Count"], found["Mean"], found["Min"], found["50%"], found["Max"]) == (3, 2.5, 1.5, 2.5, 3.5)
    assert math.isclose(found["Stddev"], 1.0)


def test_numeric_profile_over_many_partitions_matches_exact_quantiles(spark):
    df = spark.range(0, 20_000, numPartitions=16).select((F.col("id") * 7919 % 20_000).alias("v"))
    found = rows(profile.numeric_profile(df, groups=3))["v"]
    assert (found["25%"], found["50%"], found["75%"]) == (4999.0, 9999.0, 14999.0)
    assert math.isclose(found["Mean"], 9999.5)


def test_quantiles_of_a_large_input_are_exact(spark):
    n = 1_000_003
    df = spark.range(0, n, numPartitions=8).select((F.col("id") * 7919 % n).alias("v"), F.lit(7).alias("same"), F.lit(None).cast("int").alias("none"))
    found = rows(profile.quantiles(df, ["v", "same", "none"]))
    for name, percent in (("25%", 25), ("50%", 50), ("75%", 75)):
        assert found["v"][name] == -(-n * percent // 100) - 1
        assert found["same"][name] == 7.0 and found["none"][name] is None


def test_quantiles_hold_nan_and_open_ends(spark):
    df = spark.sql("select if(id % 2 = 0, double('NaN'), if(id % 3 = 0, double('-Infinity'), double(id))) as v from range(600000)")
    found = rows(profile.quantiles(df, ["v"]))["v"]
    assert math.isnan(found["75%"]) and found["25%"] == df.where("not isnan(v)").agg(F.sort_array(F.collect_list("v"))[149_999]).first()[0]


def test_quantiles_between_two_frequent_values_need_few_rounds(spark, monkeypatch):
    """A quarter of the values is at the edge of one that holds a quarter, so no sketch can part it from the next."""
    monkeypatch.setattr(profile, "MOST_ROUNDS", 2)
    df = spark.range(0, 1_600_000, numPartitions=4).select((F.col("id") % 4).alias("v"), F.when(F.col("id") % 4 < 3, F.col("id") % 4).otherwise(F.col("id")).alias("w"))
    narrowed = profile._brackets(df, ["v", "w"], None)
    assert all(b.found is not None or b.held <= profile.SORTED_VALUES for b in narrowed)
    found = rows(profile.quantiles(df, ["v", "w"]))
    for name in "vw":
        assert [found[name][q] for q in profile.QUANTILE_NAMES] == [0, 1, 2]


def test_string_profile_counts_null_as_a_value(spark):
    found = rows(profile.string_profile(sample(spark)))["name"]
    assert (found["Distinct"], found["Nulls"], found["Count"]) == (3, 1, 3)


def test_timestamp_profile_takes_both_timestamp_types(spark):
    found = rows(profile.timestamp_profile(sample(spark)))
    assert found["at"]["Nulls"] == 1 and found["at_plain"]["Distinct"] == 2
    assert found["at"]["Min"] == "2024-01-01 12:00:00"


def test_distinct_summary_is_ordered_and_approximation_agrees(spark):
    df = sample(spark)
    exact = profile.distinct_value_summary(df).collect()
    assert [r.DistinctCount for r in exact] == sorted((r.DistinctCount for r in exact), reverse=True)
    near = rows(profile.approx_distinct_summary(df))
    assert {r.ColumnName: r.DistinctCount for r in exact} == {k: v["DistinctCount"] for k, v in near.items()}


def test_frequencies_sum_to_the_rows(spark):
    df = sample(spark)
    assert profile.value_frequencies(df).agg(F.sum("DistinctCount")).first()[0] == df.count()
    assert profile.value_frequencies(df).where("ColumnValue is null").first().DistinctCount == 1


def test_empty_input(spark):
    empty = sample(spark).where("false")
    assert rows(profile.null_counts(empty))["id"]["Null%"] is None
    assert rows(profile.numeric_profile(empty))["price"]["25%"] is None
    assert rows(profile.string_profile(empty))["name"]["Distinct"] == 0
    assert profile.full_profile(empty).count() == 8


def test_full_profile_has_one_row_per_profiled_column(spark):
    found = rows(profile.full_profile(sample(spark)))
    assert set(found) == {"id", "small", "price", "name", "ok", "at", "at_plain", "odd name"}
    assert found["ok"]["True"] == 2 and found["ok"]["Distinct"] is None
    assert found["price"]["50%"] == 2.5 and found["name"]["Mean"] is None
    only_text = profile.full_profile(sample(spark).select("name", "ok"))
    assert set(only_text.columns) == set(profile.full_profile(sample(spark)).columns)


def test_transpose_there_and_back(spark):
    metrics = ("Count", "Mean", "Null%")
    df = profile.numeric_profile(sample(spark))
    back = rows(profile.transpose_metrics(profile.metric_rows(df, metrics, ["id", "price"]), metrics))
    assert back["price"]["Mean"] == 2.5 and back["price"]["Count"] == 3.0 and back["price"]["Null%"] == 25.0


def test_first_valid_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id int, label string")
    assert profile.first_valid(df, "label", "id").first()[0] == "x"
    assert profile.first_valid(df.where("label is null"), "label", "id").first()[0] is None


def test_users_by_month_includes_the_last_day(spark):
    df = spark.createDataFrame([
        (datetime(2024, 1, 31, 23), "a", 1), (datetime(2024, 1, 2), "a", 1), (datetime(2024, 2, 1), "a", 2)],
        "at timestamp_ntz, channel string, user int")
    found = profile.users_by_month(df, "at", "channel", "user", "2024-01-01", "2024-01-31").collect()
    assert [(r.Year, r.Month, r.Users) for r in found] == [(2024, 1, 1)]


def test_stored_profiles_append_and_compact(spark, database):
    df = sample(spark)
    for _ in range(2):
        written = flows.store_profile(df, "Lake", "Sample", database, AS_OF)
    assert sorted(n.split(".")[1] for n in written) == [
        "bool_summary", "distinct_values_summary", "numeric_summary", "string_summary", "timestamp_summary",
        "unique_string_values_summary"]
    table = spark.table(f"{database}.numeric_summary")
    assert table.count() == 8 and len(table.inputFiles()) == 1
    assert table.first().SourceTable == "sample"
    assert not any(n.endswith("bool_summary") for n in flows.store_profile(df.drop("ok"), "lake", "other", database, AS_OF))


def test_sketched_counts_are_within_five_percent(spark):
    df = spark.range(5000).selectExpr(*[f"id * {k} + {k} as c{k}" for k in range(1, 25)])
    counts = [r.DistinctCount for r in profile.approx_distinct_summary(df).collect()]
    assert len(counts) == 24 and all(abs(n - 5000) <= 250 for n in counts)
