"""Sharding: one law, the mixture in every shard, and edge cases. Its SQL is checked with the other queries."""

from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tablewright.llm import interleave

SCHEMA = "doc_id long, text string, source string"


def check(rows, total, shards=16):
    """Every row once, slots gapless from 0, counts at most one apart."""
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert sum(sizes) == total and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def brute(rows, shards=16):
    """The same list, sorted in one place."""
    from hashlib import md5

    def number(text, digits=15):
        return int(md5(text.encode()).hexdigest()[:digits], 16)

    strata = {}
    for doc_id, text, source in rows:
        name = "" if source is None else "=" + source
        strata.setdefault(name, []).append((number(f"{'' if doc_id is None else doc_id}:{interleave.SEED}"), number(text or ""), doc_id, text or ""))
    line = []
    for name, members in strata.items():
        phase = number(f"{name}:{interleave.SEED}", 12) / float(1 << 48)
        line += [((r + phase) / len(members), name, *m[2:]) for r, m in enumerate(sorted(members, key=lambda m: m[:2]))]
    line.sort(key=lambda x: x[:2])
    out, total = [], len(line)
    for p, (_, _, doc_id, text) in enumerate(line):
        shard = p * shards // total
        out.append((doc_id, len(text.encode()) + 1, crc32(text.encode()), shard, p - -(-shard * total // shards)))
    return Counter(out)


def digested(frame):
    return Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in interleave.digest(frame).collect())


def test_agrees_with_one_sorted_list(spark, documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.select("doc_id", "text", "source").collect()]
    assert digested(documents) == brute(rows)


def test_every_shard_holds_the_mixture(spark, documents):
    more = documents.unionByName(documents.withColumn("source", F.concat("source", F.lit("-2"))))
    placed = interleave.placed(more)
    check(placed.collect(), more.count())
    cells = interleave.mixture(placed).collect()
    assert cells and all(abs(r.rows - r.expected) < 2 for r in cells)


def test_edges(spark):
    hot = [(7, "same", "hot")] * 500
    rows = hot + [(None, None, None), (1, "", "a"), (1, "", "a"), (2, "é" * 3, "a"), (None, "x", "b"), (3, None, None)] + [(k, f"t{k}", f"s{k}") for k in range(10, 60)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert digested(frame) == brute(rows)
    assert interleave.digest(frame.where("false")).collect() == []
    few = interleave.digest(frame.where("doc_id in (2, 3)")).collect()
    assert sorted((r.size, r.slot) for r in few) == [(1, 0), (7, 0)]
    check(few, 2)
    long = spark.createDataFrame([(1, "x" * 3_000_000, "a"), (2, "y", "a")], SCHEMA)
    assert sorted(r.size for r in interleave.digest(long).collect()) == [2, 3_000_001]


def test_other_columns_stay_whatever_their_names(spark):
    names = ["__part", "__place", "__stratum", "__offset", "__RUN", "lang"]
    frame = spark.createDataFrame([(k, "t", "a") for k in range(40)], SCHEMA).withColumns({n: F.col("doc_id") + 1000 for n in names} | {"shard": F.lit("old"), "slot": F.lit(None)})
    placed = interleave.placed(frame)
    assert placed.columns == ["doc_id", "text", "source", *names, "shard", "slot"]
    rows = placed.collect()
    check(rows, 40)
    assert all(r[n] == r.doc_id + 1000 for r in rows for n in names)


def test_seed_changes_the_order_only(spark, documents):
    one, two = ({r.doc_id: (r.shard, r.slot) for r in interleave.placed(documents, seed=s).collect()} for s in ("a", "b"))
    assert one != two and one.keys() == two.keys() and sorted(one.values()) == sorted(two.values())


def test_written_shards_read_back_in_order(spark, documents, folder):
    path = folder("shards")
    interleave.write_shards(documents, path, 4)
    back = spark.read.parquet(path)
    assert back.count() == documents.count()
    files = back.select("shard", "slot", F.col("_metadata.file_path").alias("file")).collect()
    by = {}
    for r in files:
        by.setdefault(r.file, []).append((r.shard, r.slot))
    assert all([s for _, s in v] == list(range(v[0][1], v[0][1] + len(v))) for v in by.values())
    check(files, documents.count(), 4)


def test_rows_of_a_hot_source_lie_over_many_ranges(spark):
    frame = spark.createDataFrame([(1, "same", "hot")], SCHEMA).select(F.explode(F.sequence(F.lit(1), F.lit(4000))), "*").drop("col").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from tablewright.operators.rowids import ranged
        sizes = [r["count"] for r in ranged(frame, [F.col("source"), F.col("doc_id")], "p", "at").groupBy("p").count().collect()]
        assert len(sizes) >= 3 and max(sizes) < 2500
        check(interleave.placed(frame).collect(), 4000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_any_number_of_shards(spark, documents, shards):
    check(interleave.placed(documents, shards).collect(), documents.count(), shards)
