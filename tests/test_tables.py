from datetime import date

import pytest
from pyspark.sql import functions as F

from tablewright.operators import layout, tables


def people(spark, n=3):
    return spark.createDataFrame([(i, f"n{i}", "x" if i % 2 else "y") for i in range(n)], "id int, name string, side string")


def test_create_replaces_and_none_does_nothing(spark, database):
    name = f"{database}.people"
    tables.create_table(None, name)
    assert not spark.catalog.tableExists(name)
    tables.create_table(people(spark, 2), name)
    tables.create_table(people(spark, 5), name, as_of=date(2024, 1, 2), source="s")
    row = spark.table(name).first().asDict()
    assert spark.table(name).count() == 5 and row["__source"] == "s" and row["__Date"] == date(2024, 1, 2)


def test_a_table_may_be_replaced_by_its_own_rows(spark, database):
    name = f"{database}.people"
    tables.create_table(people(spark, 5), name)
    tables.create_table(spark.table(name).where("id < 3"), name)
    assert spark.table(name).count() == 3


def test_overwrite_refuses_empty_and_missing(spark, database):
    name = f"{database}.people"
    with pytest.raises(ValueError):
        tables.overwrite_table(people(spark), name)
    tables.create_table(people(spark), name)
    assert tables.overwrite_table(people(spark).where("false"), name) is False
    assert tables.overwrite_table(None, name) is False
    assert spark.table(name).count() == 3
    assert tables.overwrite_table(people(spark, 7), name, keep_previous=True)
    assert spark.table(name).count() == 7 and spark.table(f"{name}__previous").count() == 3


@pytest.mark.parametrize("partition_by", [None, ["side"]])
def test_drop_column_can_keep_the_previous_table(spark, database, partition_by):
    name = f"{database}.people"
    tables.create_table(people(spark), name, partition_by)
    tables.drop_column(spark, name, "name", keep_previous=True)
    assert set(spark.table(name).columns) == {"id", "side"} and spark.table(name).count() == 3
    previous = spark.table(f"{name}__previous")
    assert "name" in previous.columns and previous.count() == 3


def test_recovery_from_an_interrupted_swap(spark, database):
    name = f"{database}.people"
    tables.create_table(people(spark), name, ["side"])
    tables.create_table(people(spark, 9), f"{name}__new")
    tables.recover(spark, name)  # the table is there: the leftover copy goes
    assert not spark.catalog.tableExists(f"{name}__new") and spark.table(name).count() == 3
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__previous")
    tables.recover(spark, name)  # stopped between the renames: the table comes back
    assert spark.table(name).count() == 3


def test_compaction_keeps_rows_and_leaves_fewer_files(spark, database):
    name = f"{database}.people"
    for _ in range(4):
        tables.append_partitioned(people(spark, 20), name, ["side"])
    before = len(spark.table(name).inputFiles())
    tables.compact(spark, name, F.col("side") == "x")
    assert len(spark.table(name).where("side = 'x'").inputFiles()) == 1
    assert len(spark.table(name).inputFiles()) < before and spark.table(name).count() == 80
    plain = f"{database}.plain"
    tables.create_table(people(spark, 20).repartition(5), plain)
    tables.compact(spark, plain)
    assert spark.table(plain).count() == 20 and len(spark.table(plain).inputFiles()) == 1


def test_layer_names(spark):
    assert tables.layer_table("Bronze", "Invoice", "Raw") == "bronze.invoice_raw"
    with pytest.raises(ValueError):
        tables.layer_table("copper", "invoice")


def test_layout_keeps_key_order_and_skips_empty(spark, folder):
    path = folder()
    assert layout.write_layout(people(spark), path, {"org": "o1", "day": "d1"}, ["side"])
    files = spark.read.option("header", "true").csv(path).inputFiles()
    assert all("/org=o1/day=d1/side=" in f for f in files)
    assert layout.write_layout(people(spark).where("false"), folder()) is False


def test_archive_and_keep_are_the_whole_input(spark):
    names = ["T.a.b.2023-12-01_1.csv", "T.a.b.2024-01-10_1.zip", "T.a.b.2023-01-10_9.txt", "short.csv", "T.a.b.2023-12-16_2.csv"]
    items = spark.createDataFrame([(n,) for n in names], "name string")
    none = items.where("false")
    fresh, live = layout.archive(items, none, date(2024, 1, 15))
    assert {r.name: r.folder for r in fresh.collect()} == {names[0]: "date=202312", names[2]: "date=202301"}
    assert {r.name for r in live.collect()} == {names[1], names[3], names[4]}
    again, _ = layout.archive(items, fresh, date(2024, 1, 15))
    assert again.count() == 0
    restored = layout.restore(fresh, live.unionByName(items.where(F.col("name") == names[0])))
    assert sorted(r.name for r in restored.collect()) == sorted(set(names) - {names[2]})


def test_age_by_modification_time(spark):
    items = spark.createDataFrame([("a.zip", "2023-12-01"), ("b.zip", "2024-01-14")], "name string, at string").withColumn(
        "at", F.col("at").cast("timestamp"))
    marked = layout.split_by_age(items, date(2024, 1, 15), modified="at")
    assert {r.name: r.action for r in marked.collect()} == {"a.zip": "archive", "b.zip": "keep"}
