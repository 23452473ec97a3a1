from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablewright.functions import names, times, values
from tablewright.operators import filters, paging


def value(spark, column, text, kind="string"):
    return spark.createDataFrame([(text,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize("name,table,file,day", [
    ("GL.acme.all.2024-01-05_77.csv", "GL", "acme.all.2024-01-05_77.csv", "20240105"),
    ("plain", "plain", "plain", "plain"),
    ("A.b_c.d", "A", "b_c.d", "b")])
def test_file_name_parts(spark, name, table, file, day):
    assert value(spark, names.table_part, name) == table
    assert value(spark, names.file_part, name) == file
    assert value(spark, names.save_date, name) == day


def test_name_date_of_odd_names_is_null(spark):
    assert value(spark, names.name_date, "a.b.c.2024-02-30_x") is None
    assert value(spark, names.name_date, "a.b") is None
    assert value(spark, names.name_date, "a.b.c.2024-02-29_x") == date(2024, 2, 29)


def test_leading_set_is_not_a_prefix(spark):
    assert value(spark, lambda c: names.strip_leading_set(c, "ABC"), "CABBAGE") == "GE"


def test_paths_and_names(spark):
    assert value(spark, lambda c: names.hive_path(c, a=F.lit(1), b=F.lit("x")), "f.csv") == "a=1/b=x/f.csv"
    assert value(spark, names.normalised, "My Sheet 1") == "mysheet1"
    assert value(spark, lambda c: names.qualified_column(F.lit("Gold"), c), "T") == "gold.t"
    assert names.qualified("Gold", "T", "X") == "gold.t_x"


@pytest.mark.parametrize("name,target", [
    ("bit", "binary"), ("Boolean", "boolean"), ("numeric", "decimal(10,0)"), ("decimal(12, 3)", "decimal(12,3)"),
    ("money", "double"), ("float", "float"), ("bigint", "bigint"), ("point", "bigint"), ("varchar(20)", "string"),
    ("date", "string"), ("timestamp", "string"), ("real", "string")])
def test_loose_type_names(name, target):
    assert values.spark_type(name) == target


def test_casts_give_null_instead_of_failing(spark):
    df = spark.createDataFrame([("x", "12.345", 5)], "a string, b string, c int")
    out = values.cast_by_name(df, {"a": "int", "b": "decimal(6,2)", "c": "bit"}).first()
    assert out.a is None and str(out.b) == "12.35" and bytes(out.c) == b"5"


def test_text_flags(spark):
    assert [value(spark, values.flag_from_text, t) for t in ("TRUE", "Yes", "1", "no", "", None)] == [
        True, True, True, False, False, None]


def test_central_day_changes_at_five_or_six(spark):
    day = lambda t: value(spark, times.central_date, t, "timestamp_ntz")
    assert day(datetime(2024, 1, 1, 5, 59)) == date(2023, 12, 31) and day(datetime(2024, 1, 1, 6)) == date(2024, 1, 1)
    assert day(datetime(2024, 7, 1, 5)) == date(2024, 7, 1)


def test_iso_offset(spark):
    assert value(spark, lambda c: times.iso_to_utc(c).cast("string"), "2024-01-01T00:30:00-06:00") == "2024-01-01 06:30:00"
    assert value(spark, times.iso_to_utc, "no time") is None
    assert value(spark, times.compact_date, "20240229") == date(2024, 2, 29)


def test_incremental_bounds_for_both_timestamp_types(spark):
    stamps = ["2024-01-13 23:59:59", "2024-01-13 23:59:59.5", "2024-01-14 00:00:00"]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast(kind).alias("at"))
        assert filters.modified_after(df, "at", date(2024, 1, 15)).count() == 2
        assert filters.modified_since(df, "at", date(2024, 1, 15)).count() == 1


def test_active_drops_null_and_false(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "active boolean")
    assert filters.active_only(df).count() == 1


def test_misnamed(spark):
    named = {n: value(spark, filters.misnamed, n) for n in ("x.all.y", "a_cr_b", "update", "model", "other")}
    assert named == {"x.all.y": False, "a_cr_b": False, "update": False, "model": False if "del" in "model" else True, "other": True}


@pytest.mark.parametrize("n", [0, 1, 2, 7, 10, 1001])
def test_halves_are_disjoint_complete_and_ordered(spark, n):
    df = spark.range(n).select((F.col("id") * 3 - 50).alias("id"))
    first = sorted(r.id for r in paging.run_half(df, "id", False).collect())
    second = sorted(r.id for r in paging.run_half(df, "id", True).collect())
    assert len(first) == (n + 1) // 2 and first + second == sorted(i * 3 - 50 for i in range(n))


def test_halves_of_text_ids_with_nulls_and_a_hot_key(spark):
    df = spark.createDataFrame([("e",)] * 50 + [("a",), ("x",), (None,)], "id string")
    assert {(r.id, r.run, r["count"]) for r in paging.halves(df, "id").groupBy("id", "run").count().collect()} == {
        ("a", "first", 1), ("e", "first", 50), ("x", "second", 1), (None, "second", 1)}
    assert paging.halves(df.where("id is null"), "id").collect() == [(None, "second")]
    sparse = spark.range(2000).select((F.col("id") * 10_000_019).alias("id"))
    assert paging.run_half(sparse, "id", False).count() == 1000


def test_pages_together_are_the_whole_list(spark):
    df = spark.range(25).withColumn("v", F.col("id") % 2)
    pages = [paging.detail_page(df, F.col("v") == 1, [F.col("id").desc()], o, 5).collect() for o in (0, 5, 10)]
    assert [r.id for p in pages for r in p] == [r.id for r in paging.all_details(df, F.col("v") == 1).orderBy(F.desc("id")).collect()]


def test_sample_share(spark):
    kept = filters.random_sample(spark.range(10_000), 0.3, 1).count()
    assert 2_700 < kept < 3_300
