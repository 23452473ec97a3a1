"""Merges guarded by an order, and tables in key buckets."""

import itertools
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablewright.operators import bucketed, merge, tables


def shown(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


CHANGES = [(1, "a", 5), (1, "b", 7), (2, "c", 1), (2, "d", None), (3, "e", 2), (1, "f", 7)]


def test_changes_in_any_order_give_the_same_table(spark):
    """Each change a batch of its own, in many orders; of two with equal order the first to come stays."""
    start = [(1, "old", 4), (4, "kept", None), (None, "x", 1)]
    expected = sorted([(1, "b", 7), (4, "kept", None), (None, "x", 1), (2, "c", 1), (3, "e", 2)], key=repr)
    for perm in list(itertools.permutations(CHANGES[:5]))[::17]:
        table = spark.createDataFrame(start, "k int, v string, at int")
        for change in perm:
            table = spark.createDataFrame(shown(merge.upsert(table, spark.createDataFrame([change], table.schema), "k", order="AT")), table.schema)
        assert shown(table) == expected


def test_the_order_is_updated_with_the_rest(spark):
    table = spark.createDataFrame([(1, "a", 1)], "k int, v string, at int")
    assert shown(merge.upsert(table, spark.createDataFrame([(1, "b", 2)], table.schema), "k", ["v"], order="at")) == [(1, "b", 2)]
    assert shown(merge.upsert(table, spark.createDataFrame([(1, "b", 1)], table.schema), "k", order="at")) == [(1, "a", 1)]
    assert shown(merge.upsert(table, spark.createDataFrame([(1, "b", None)], table.schema), "k", order="at")) == [(1, "a", 1)]
    with pytest.raises(merge.UnknownColumns):
        merge.upsert(table, spark.createDataFrame([(1, "b")], "k int, v string"), "k", order="at")


def test_partitioned_table_takes_no_older_change(spark, database):
    name = f"{database}.t"
    tables.upsert_table(spark.createDataFrame([(1, "p", "a", 5), (2, "q", "b", 5)], "k int, part string, v string, at int"), name, ["k", "part"], partition_by=["part"])
    tables.upsert_table(spark.createDataFrame([(1, "p", "late", 4), (2, "q", "new", 6)], "k int, part string, v string, at int"), name, ["k", "part"], order="at")
    assert shown(spark.table(name).select("k", "v", "at")) == [(1, "a", 5), (2, "new", 6)]


def files(spark, name):
    return {Path(f.split(":", 1)[1]) for f in spark.table(name).inputFiles()}


def test_only_touched_buckets_get_new_files(spark, database):
    name = f"{database}.b"
    bucketed.create(spark.range(400).select("id", F.lit("old").alias("v")), name, "id", 16)
    before = files(spark, name)
    changes = spark.createDataFrame([(7, "new"), (1000, "added"), (None, "keyless")], "id long, v string")
    touched = {r[0] for r in changes.select(bucketed.bucket_of([F.col("id")], 16)).collect()}
    stamps = {f: f.stat().st_mtime_ns for f in before}
    bucketed.upsert(changes, name)
    after = files(spark, name)
    kept = {f for f in before if int(f.parent.name.split("=")[1]) not in touched}
    assert len(kept) >= 13 and kept <= after and all(f.stat().st_mtime_ns == stamps[f] for f in kept)
    assert not {f for f in before - kept} & after
    rows = {tuple(r) for r in bucketed.rows(spark, name).collect()}
    assert rows == {(k, "new" if k == 7 else "old") for k in range(400)} | {(1000, "added"), (None, "keyless")}


def test_the_table_is_not_shuffled_for_a_merge(spark, database):
    name = f"{database}.b"
    bucketed.create(spark.range(3000).select("id", F.lit(1).alias("v")), name, ["id"], 8)
    changes = spark.range(100).select(F.col("id").cast("int").alias("ID"), F.lit(2).alias("v"))
    tables.save(changes, f"{name}_c", None)
    plan = bucketed.merged(spark, name, spark.table(f"{name}_c"))._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("FullOuter"):]
    sides = [part for part in join.split("FileScan") if "Bucketed: true" in part]
    assert len(sides) == 1 and "SelectedBucketsCount" in sides[0]
    held = join[:join.index("Bucketed: true")]
    assert join.count("Exchange hashpartitioning") == 1 and ("Exchange" not in held or "__new_" in held.split("Exchange", 1)[1][:200])
    joined = bucketed.merged(spark, name, spark.table(f"{name}_c"))
    assert joined.where("v = 2").count() == 100


@pytest.mark.parametrize("keys", [["a"], ["a", "b"]])
def test_against_a_plain_merge(spark, database, keys):
    name = f"{database}.m"
    start = spark.range(300).select((F.col("id") * 3).alias("a"), F.concat(F.lit("k"), F.col("id") % 7).alias("b"), F.col("id").cast("double").alias("v"), F.lit(3).alias("at"))
    change = spark.range(400).select((F.col("id") * 2).cast("int").alias("A"), F.concat(F.lit("k"), F.col("id") % 5).alias("b"), F.lit(None).cast("float").alias("v"), (F.col("id") % 6).cast("int").alias("at"))
    bucketed.create(start, name, keys, 4)
    bucketed.upsert(change, name, order="at")
    plain = merge.upsert(start, change, keys, order="at")
    assert shown(bucketed.rows(spark, name).select("a", "b", "v", "at")) == shown(plain.select("a", "b", "v", "at"))
    bucketed.upsert(change, name, update=None)
    assert shown(bucketed.rows(spark, name).select("a", "b", "v", "at")) == shown(plain.select("a", "b", "v", "at"))


def test_what_does_not_fit_is_refused(spark, database):
    name = f"{database}.r"
    bucketed.create(spark.range(10).toDF("k"), name, "k", 2)
    with pytest.raises(merge.DuplicateKeys):
        bucketed.upsert(spark.createDataFrame([(1,), (1,)], "k long"), name)
    with pytest.raises(merge.UnknownColumns):
        bucketed.upsert(spark.createDataFrame([(1, 2)], "k long, z int"), name)
    tables.create_table(spark.range(3).toDF("k"), f"{database}.plain")
    with pytest.raises(ValueError):
        bucketed.upsert(spark.range(1).toDF("k"), f"{database}.plain")
    assert bucketed.rows(spark, name).count() == 10
    bucketed.create(spark.range(4).toDF("k"), name, "k", 4)
    assert bucketed.rows(spark, name).count() == 4 and bucketed.layout(spark, name) == (["k"], 4)
