import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tablewright.operators import merge, tables

SCHEMA = "k bigint, g string, v int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute(target, source, keys, updates):
    """Row by row merge over (k, g, v) tuples."""
    names = ("k", "g", "v")
    at = [names.index(k) for k in keys]
    key = lambda r: tuple(r[i] for i in at)
    new = {key(r): r for r in source if None not in key(r)}
    out = [tuple(new[key(r)][i] if key(r) in new and n in updates else r[i] for i, n in enumerate(names)) for r in target]
    held = {key(r) for r in target if None not in key(r)}
    return sorted(out + [r for r in source if key(r) not in held], key=repr)


@pytest.mark.parametrize("limit", ["10485760", "-1"])
@pytest.mark.parametrize("keys,update", [(["k"], ["v"]), (["k"], merge.ALL), (["k", "g"], "v"), (["k"], None)])
def test_against_brute_force_with_and_without_broadcast(spark, limit, keys, update):
    random.seed(3)
    target = [(random.choice([*range(40), None]), random.choice("abc"), random.randrange(100)) for _ in range(300)]
    source = [(k, "b", random.choice([None, k])) for k in range(20, 60)] + [(None, "n", 1), (None, "n", 1)]
    updates = [c for c in ("k", "g", "v") if c not in keys] if update == merge.ALL else merge.as_list(update)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        assert got(merge.upsert(frame(spark, target), frame(spark, source), keys, update)) == brute(
            target, source, keys, updates)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_hot_key_in_the_target(spark):
    target = [(7, "a", i) for i in range(2000)] + [(i, "b", i) for i in range(100, 4100)]
    source = [(7, "z", -1), (1, "new", 1)]
    assert got(merge.upsert(frame(spark, target), frame(spark, source), "k")) == brute(target, source, ["k"], ["g", "v"])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(st.tuples(st.integers(0, 6), st.sampled_from("ab"), st.integers(0, 3)), min_size=1, max_size=8),
       source=st.dictionaries(st.integers(0, 8), st.integers(0, 3), min_size=1, max_size=6))
def test_twice_is_once(spark, target, source):
    changes = frame(spark, [(k, "s", v) for k, v in source.items()])
    once = merge.upsert(frame(spark, target), changes, "k")
    assert got(once) == got(merge.upsert(once, changes, "k"))


def test_null_in_the_source_overwrites(spark):
    merged = merge.upsert(frame(spark, [(1, "a", 5)]), frame(spark, [(1, None, None)]), "k")
    assert got(merged) == [(1, None, None)]


def test_duplicate_source_keys_are_refused(spark):
    with pytest.raises(merge.DuplicateKeys):
        merge.upsert(frame(spark, [(1, "a", 5)]), frame(spark, [(2, "a", 1), (2, "b", 1)]), "k")


def test_inferred_keys_are_required_long_float_and_string(spark):
    declared = T.StructType.fromDDL(
        "a bigint not null, b float not null, c string not null, d int not null, e bigint, f double not null")
    assert merge.infer_keys(declared) == ["a", "b", "c"]
    assert merge.infer_updates(["a", "x", "b"], ["a", "b"]) == ["x"]


def test_table_merge_creates_then_updates_and_stamps(spark, database):
    name = f"{database}.t"
    tables.upsert_table(None, name, "k")
    assert not spark.catalog.tableExists(name)
    tables.upsert_table(frame(spark, [(1, "a", 1)]), name, "k", run=5)
    tables.upsert_table(frame(spark, [(1, "b", 2), (2, "c", 3)]), name, ["k"], "v", run=6)
    rows = [r.asDict() for r in spark.table(name).collect()]
    assert sorted((r["k"], r["g"], r["v"], r["__run"]) for r in rows) == [(1, "a", 2, "5"), (2, "c", 3, "6")]


def test_partitioned_table_rewrites_only_touched_partitions(spark, database):
    name = f"{database}.t"
    target = [(1, "a", 1), (2, "b", 2), (3, None, 3), (4, None, 4)]
    tables.upsert_table(frame(spark, target), name, ["k", "g"], partition_by=["g"])
    before = {f for f in spark.table(name).where("g = 'a'").inputFiles()}
    source = [(2, "b", 20), (5, "c", 5), (6, None, 6)]
    tables.upsert_table(frame(spark, source), name, ["k", "g"])
    assert got(spark.table(name).select("k", "g", "v")) == brute(target, source, ["k", "g"], ["v"])
    assert {f for f in spark.table(name).where("g = 'a'").inputFiles()} == before


def test_partition_column_outside_the_key(spark, database):
    name = f"{database}.t"
    target = [(1, "a", 1), (2, "b", 2), (3, None, 3), (4, "c", 4), (None, "b", 9)]
    tables.upsert_table(frame(spark, target), name, "k", partition_by=["g"])
    before = set(spark.table(name).where("g = 'c'").inputFiles())
    source = [(2, "a", 20), (3, "a", 30), (5, "d", 5), (None, "a", 7)]  # keys found in other partitions than named
    tables.upsert_table(frame(spark, source), name, "k", "v")
    assert got(spark.table(name).select("k", "g", "v")) == brute(target, source, ["k"], ["v"])
    assert set(spark.table(name).where("g = 'c'").inputFiles()) == before


def test_a_row_may_move_to_another_partition(spark, database):
    name = f"{database}.t"
    target = [(1, "a", 1), (2, "b", 2)]
    tables.upsert_table(frame(spark, target), name, "k", partition_by=["g"])
    tables.upsert_table(frame(spark, [(1, "z", 10)]), name, "k")
    assert got(spark.table(name).select("k", "g", "v")) == [(1, "z", 10), (2, "b", 2)]


def test_small_source_moves_no_target_row(spark, folder):
    path = folder()
    spark.range(100_000).selectExpr("id as k", "'x' as g", "1 as v").write.parquet(path)
    changes = folder()
    frame(spark, [(5, "y", 2), (-1, "new", 3)]).write.parquet(changes)
    merged = merge.upsert(spark.read.parquet(path), spark.read.parquet(changes), "k")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    update = plan[plan.index("Union"):plan.index("LeftAnti")] if "LeftAnti" in plan else plan
    assert "BroadcastHashJoin" in update and "LeftOuter" in update
    assert merged.where("k = 5").first().v == 2 and merged.count() == 100_001


def test_merged_rows_keep_the_target_types(spark, database):
    source = spark.createDataFrame([(1.0, "a", 2.0), (2.0, "b", 3.0)], "k double, G string, v double")
    target = frame(spark, [(1, "x", 1)])
    merged = merge.upsert(target, source, "k")
    assert merged.schema == target.schema and got(merged) == [(1, "a", 2), (2, "b", 3)]
    tables.upsert_table(target, f"{database}.typed", "k")
    tables.upsert_table(source, f"{database}.typed", "k")
    assert [f.dataType for f in spark.table(f"{database}.typed").schema] == [f.dataType for f in target.schema]


def test_unknown_columns_are_refused(spark):
    target, source = frame(spark, [(1, "a", 1)]), frame(spark, [(1, "a", 1)])
    with pytest.raises(merge.UnknownColumns):
        merge.upsert(target, source.withColumn("more", source.v), "k")
    with pytest.raises(merge.UnknownColumns):
        merge.upsert(target, source, "k", ["v", "more"])


def test_merge_is_the_same_without_broadcasts(spark):
    target, source = [(1, "a", 1), (None, "b", 2)], [(1, "c", 3), (2, "d", 4), (None, "e", 5)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = got(merge.upsert(frame(spark, target), frame(spark, source), "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert merged == brute(target, source, ["k"], ["g", "v"])
