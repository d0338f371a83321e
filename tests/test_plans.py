"""What the physical plans of the main operators look like."""

import re

import pytest
from pyspark.sql import functions as F

from monthwise.operators import features as ft
from monthwise.operators import replay as rp
from monthwise.operators.forecast import forecast_windows, result_table
from monthwise.operators.models import oldest_feature
from monthwise.operators.monthly import monthly_totals
from monthwise.operators.quality import good_records, parse_messages
from monthwise.plans.catalogue import QUERIES
from monthwise.plans.registry import lineitem, orders
from tests.oracle import data_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern, text):
    return len(re.findall(pattern, text))


def supplier_months(spark):
    return monthly_totals(lineitem(spark, data_dir()), "day", "sales", ["l_suppkey"], scale=2)


def test_monthly_sums_read_two_columns_and_combine_before_one_shuffle(spark):
    text = plan(monthly_totals(lineitem(spark, data_dir()), "day", "sales", scale=2))
    assert "ReadSchema: struct<l_extendedprice:double,l_shipdate:timestamp_ntz>" in text
    assert count(r"\bExchange hashpartitioning", text) == 1 and "partial_sum" in text
    assert "SortAggregate" not in text


def test_series_operators_share_one_shuffle_and_sort(spark):
    monthly = supplier_months(spark)
    windows = forecast_windows(monthly, oldest_feature(), "compat", ["l_suppkey"])
    for result in (ft.lag_matrix(monthly, 11, ["l_suppkey"]), result_table(windows, ["l_suppkey"])):
        text = plan(result)
        assert count(r"\bExchange hashpartitioning", text) == 2
        assert count(r"- Sort \[", text) == 1


def test_nation_months_aggregate_once_after_the_join(spark):
    text = plan(QUERIES["monthly_sales_by_nation"](spark, data_dir()))
    assert count(r"\bExchange hashpartitioning\(n_name", text) == 1
    assert count("HashAggregate", text) == 2
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_log_lines_are_not_shuffled(spark):
    text = plan(QUERIES["log_rows"](spark, data_dir()))
    joins = text[: text.index("BroadcastHashJoin")]
    assert "Exchange hashpartitioning" not in joins and "SortMergeJoin" not in text


def test_last_events_are_found_without_sorting(spark):
    text = plan(QUERIES["latest_per_key"](spark, data_dir()))
    assert "SortAggregate" not in text and "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text


def test_filters_reach_the_scan(spark):
    recent = lineitem(spark, data_dir()).filter(F.col("l_suppkey") == 7)
    text = plan(monthly_totals(recent, "day", "sales", ["l_suppkey"]))
    assert "EqualTo(l_suppkey,7)" in text


def test_only_the_calendar_is_broadcast_or_gathered(spark):
    text = plan(rp.closed_months(orders(spark, data_dir()), "day", "sales", "seq", ["o_custkey"]))
    assert count("BroadcastExchange", text) == 1 and count("Exchange SinglePartition", text) == 1
    gathered = text[text.index("Exchange SinglePartition"):]
    # Below the single partition the records have been reduced to days.
    assert "partial_min" in gathered


def test_messages_are_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    text = plan(good_records(parse_messages(df)))
    assert count(r"from_json\(", text) == 1


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_cross_joins_and_no_row_at_a_time_python(spark, name):
    text = plan(QUERIES[name](spark, data_dir()))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
