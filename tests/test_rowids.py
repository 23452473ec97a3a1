"""Row ids by prefix sums."""

from pyspark.sql import functions as F

from tablewright.operators import rowids


def test_ids_follow_the_order_without_a_window(spark):
    frame = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id").alias("row_id"), F.lit("x").alias("__part"))
    ids = rowids.numbered(frame.repartition(7), [F.col("k").desc()])
    assert "Window" not in ids._jdf.queryExecution().toString()
    rows = sorted(ids.collect(), key=lambda r: r.row_id)
    assert [r.row_id for r in rows] == list(range(1, 5001))
    assert [r.k for r in rows] == sorted((r.k for r in rows), reverse=True)
    assert ids.columns == ["k", "__part", "row_id"]


def test_equal_and_null_keys(spark):
    frame = spark.createDataFrame([(None,), (2,), (2,), (None,), (1,)], "k int")
    rows = sorted(rowids.numbered(frame, [F.col("k")], "n", 0).collect(), key=lambda r: r.n)
    assert [(r.k, r.n) for r in rows] == [(None, 0), (None, 1), (1, 2), (2, 3), (2, 4)]
    assert rowids.numbered(frame.where("false"), [F.col("k")]).collect() == []


def test_one_hot_key_is_spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = rowids.ranged(spark.range(9000).select(F.lit(1).alias("k")).repartition(5), [F.col("k")], "p", "at")
        sizes = [r["count"] for r in rows.groupBy("p").count().collect()]
        assert len(sizes) >= 3 and max(sizes) < 6000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_page_index_is_read_by_offset(spark, folder):
    path = folder("pages")
    rowids.write_pages(spark.range(2500).select((F.col("id") * 7 % 2503).alias("k")), [F.col("k")], path, 1000)
    page = rowids.read_page(spark, path, 2000, 1000)
    plain = sorted(k * 7 % 2503 for k in range(2500))
    assert [r.k for r in page.orderBy("row_id").collect()] == plain[2000:]
    assert {r.page for r in page.collect()} == {3}
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(row_id,2000)" in plan
