"""The physical plans that matter at scale."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tablewright.operators import filters, joins, nested, paging, profile
from tablewright.registry import all_queries
from tablewright.registry.common import load
from tablewright.sources import files

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    events = load(spark, SF, "events")
    for df, pushed in (
            (paging.by_key(events, "event_id", 5).select("event_id"), "EqualTo(event_id,5)"),
            (filters.modified_since(events, "ts", date(2024, 1, 15)).select("event_id"), "GreaterThanOrEqual(ts"),
            (filters.modified_after(events, "ts", date(2024, 1, 15)).select("event_id"), "GreaterThan(ts")):
        text = plan(df)
        assert pushed in text and "props" not in text


def test_distinct_counts_read_one_column_per_branch_without_expand(spark):
    text = plan(profile.distinct_counts(load(spark, SF, "orders"), ["o_orderstatus", "o_custkey"]))
    assert "ReadSchema: struct<o_orderstatus:string>" in text and "ReadSchema: struct<o_custkey:bigint>" in text
    assert "Expand" not in text


def test_counts_of_all_columns_are_one_scan(spark):
    text = plan(profile.null_counts(load(spark, SF, "lineitem")))
    assert text.count("FileScan") == 1


def test_quantiles_sort_only_the_values_inside_brackets(spark):
    text = plan(profile.quantiles(load(spark, SF, "lineitem"), ["l_tax"]))
    assert text.count("FileScan") == 1 and "Window" in text


def test_record_text_is_read_without_python_or_shuffle(spark):
    from tablewright.registry import nesting

    for df in (nested.parse_items(nesting.invoice_texts(spark, SF)), nested.parse_calls(nesting.call_records(spark, SF))):
        text = plan(df)
        assert "Python" not in text and "Exchange" not in text and "Join" not in text


def test_inventory_does_not_read_contents(spark):
    text = plan(files.inventory(spark, SF))
    assert "content" not in text.split("ReadSchema")[1]


def test_users_are_made_distinct_before_they_are_counted(spark):
    df = profile.users_by_month(load(spark, SF, "events"), "ts", "event_type", "user_id", "2024-01-01", "2024-01-31")
    text = plan(df)
    assert "Expand" not in text and "PushedFilters" in text and "GreaterThanOrEqual(ts" in text


def test_anti_join_keeps_the_source_on_the_streamed_side(spark):
    orders = load(spark, SF, "orders")
    text = plan(joins.not_present(orders, orders.where("o_orderstatus = 'F'"), ["o_orderkey"]))
    assert "LeftAnti" in text and "Cartesian" not in text


@pytest.mark.parametrize("key", ["merge_upsert", "pair_dimension", "left_join_chain", "split_runs", "profile_full",
                                 "parse_items", "users_by_month_channel", "archive_split"])
def test_no_pair_products_and_no_row_at_a_time_python(spark, key):
    text = plan(all_queries()[key](spark, SF))
    assert "CartesianProduct" not in text and "BatchEvalPython" not in text and "BroadcastNestedLoopJoin" not in text


def test_column_metadata_needs_no_scan(spark):
    from tablewright.sources import catalog

    assert "FileScan" not in plan(catalog.column_metadata(load(spark, SF, "orders")))


def test_random_sample_is_a_plain_filter(spark):
    text = plan(filters.random_sample(load(spark, SF, "events"), 0.3, 1).select(F.col("event_id")))
    assert "Exchange" not in text
