"""Monthly totals, day counts and calendar expressions."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from monthwise.functions import calendar as cal
from monthwise.functions.text import number_text
from monthwise.operators.aggregates import merge_aggregate
from monthwise.operators.monthly import (
    day_counts, exact_sum, fill_gaps, month_mode_day, monthly_aggregate, monthly_totals,
)
from monthwise.plans.registry import (
    LINES_SQL, ORDERS_SQL, lineitem, months_sql, orders, query, table,
)


@query("monthly_sales", f"WITH {LINES_SQL}, {months_sql('lines_in')} SELECT month, sales FROM months")
def monthly_sales(spark, sf_dir):
    return monthly_totals(lineitem(spark, sf_dir), "day", "sales", scale=2)


@query(
    "monthly_sales_by_series",
    f"WITH {ORDERS_SQL}, {months_sql('orders_in', 'o_orderpriority')} "
    "SELECT o_orderpriority, month, sales FROM months",
)
def monthly_sales_by_series(spark, sf_dir):
    return monthly_totals(orders(spark, sf_dir), "day", "sales", ["o_orderpriority"], scale=2)


def nation_months(spark, sf_dir):
    """Monthly order totals per nation.

    Three columns of the orders are joined as they are: reducing them per customer and month first
    would shuffle them all and remove next to nothing. The customer side is left to the optimiser,
    which broadcasts it only below the size limit; beyond, a customer with very many orders is split
    by the adaptive skew join. After the join each task has a row per nation and month.
    """
    sold = orders(spark, sf_dir).select("o_custkey", "day", "sales")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = sold.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return monthly_totals(joined, "day", "sales", ["n_name"], scale=2)


NATION_SQL = """
nation_in AS (
  SELECT n_name, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


@query(
    "monthly_sales_by_nation",
    f"WITH {NATION_SQL}, {months_sql('nation_in', 'n_name')} SELECT n_name, month, sales FROM months",
)
def monthly_sales_by_nation(spark, sf_dir):
    return nation_months(spark, sf_dir)


@query(
    "monthly_sales_filled",
    f"""WITH {ORDERS_SQL}, {months_sql('orders_in', 'o_custkey')},
    spans AS (SELECT o_custkey, min(month) AS lo, max(month) AS hi FROM months GROUP BY o_custkey),
    slots AS (SELECT o_custkey, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE)
              AS month FROM spans)
    SELECT o_custkey, month, coalesce(sales, 0.0) AS sales
    FROM slots LEFT JOIN months USING (o_custkey, month)""",
)
def monthly_sales_filled(spark, sf_dir):
    monthly = monthly_totals(orders(spark, sf_dir), "day", "sales", ["o_custkey"], scale=2)
    return fill_gaps(monthly, ["o_custkey"])


@query(
    "monthly_profile",
    """SELECT l_returnflag, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
       count(*) AS records, min(l_extendedprice) AS least, max(l_extendedprice) AS most,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM lineitem GROUP BY 1, 2""",
)
def monthly_profile(spark, sf_dir):
    """Any aggregates per month, not only the sum of sales."""
    return monthly_aggregate(
        lineitem(spark, sf_dir),
        "day",
        ["l_returnflag"],
        records=F.count(F.lit(1)),
        least=F.min("sales"),
        most=F.max("sales"),
        quantity=exact_sum(F.col("l_quantity"), 2),
    )


@query(
    "order_day_counts",
    "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS records FROM orders GROUP BY ALL",
)
def order_day_counts(spark, sf_dir):
    return day_counts(orders(spark, sf_dir), "day")


MODE_SQL = """
SELECT {key} month, day AS mode_day, records FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} month ORDER BY records DESC, day) AS rank FROM (
    SELECT {key} CAST(date_trunc('month', {ts}) AS DATE) AS month, CAST({ts} AS DATE) AS day,
           count(*) AS records
    FROM {source} GROUP BY ALL)) WHERE rank = 1"""


@query("month_mode_day", MODE_SQL.format(key="", ts="o_orderdate", source="orders"))
def mode_day(spark, sf_dir):
    return month_mode_day(orders(spark, sf_dir), "day")


@query(
    "month_mode_day_by_series",
    MODE_SQL.format(key="l_suppkey,", ts="l_shipdate", source="lineitem"),
)
def mode_day_by_series(spark, sf_dir):
    return month_mode_day(lineitem(spark, sf_dir), "day", ["l_suppkey"])


@query(
    "calendar_days",
    """SELECT day, text, CAST(date_trunc('month', day) AS DATE) AS month,
       CAST(day(last_day(day)) AS BIGINT) AS month_days,
       CAST(year(day) AS BIGINT) AS year, CAST(month(day) AS BIGINT) AS month_number,
       text[1:7] AS month_key, text[1:8] || '01' AS month_text,
       strftime(CAST(date_trunc('month', day) AS DATE) + INTERVAL 1 MONTH, '%Y-%m-')
         || text[9:10] AS next_text,
       CAST(date_trunc('month', day) + INTERVAL 6 MONTH AS DATE) AS in_six_months,
       CAST(year(day) * 12 + month(day) - 1 AS BIGINT) AS month_index
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day,
                 strftime(o_orderdate, '%Y-%m-%d') AS text FROM orders)""",
)
def calendar_days(spark, sf_dir):
    text = F.col("text")
    day = F.col("day")
    days = orders(spark, sf_dir).select("day").distinct()
    days = days.select("day", cal.day_text(day).alias("text"))
    return days.select(
        cal.parse_day(text).alias("day"),
        "text",
        cal.month_of(day).alias("month"),
        cal.month_days(day).alias("month_days"),
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month_number"),
        cal.month_key(text).alias("month_key"),
        cal.month_text(text).alias("month_text"),
        cal.next_month_text(text).alias("next_text"),
        cal.add_months(cal.month_of(day), 6).alias("in_six_months"),
        cal.month_index(day).alias("month_index"),
    )


@query(
    "event_ordinal_time",
    """SELECT event_id,
       CAST((year(ts) * 12 + month(ts) - 1 - 1970 * 12) * 86400000
         + (day(ts) - 1) * 86400 + hour(ts) * 3600 + minute(ts) * 60
         + floor(second(ts)) AS BIGINT) AS ordinal_ms,
       CAST(date_trunc('month', ts) AS DATE) AS month
    FROM events""",
)
def event_ordinal_time(spark, sf_dir):
    ordinal = cal.ordinal_month_time(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_millis(ordinal).alias("ordinal_ms"),
        cal.month_from_ordinal(ordinal).alias("month"),
    )


@query(
    "sales_text",
    f"WITH {ORDERS_SQL}, {months_sql('orders_in', 'o_orderpriority')} SELECT o_orderpriority, "
    "month, CAST(sales AS VARCHAR) AS sales_text FROM months",
)
def sales_text(spark, sf_dir):
    monthly = monthly_totals(orders(spark, sf_dir), "day", "sales", ["o_orderpriority"], scale=2)
    return monthly.select("o_orderpriority", "month", number_text(F.col("sales")).alias("sales_text"))


class SumAndMode:
    """Sum of cents and the most frequent day, the earliest of those that tie."""

    def create(self) -> tuple[int, Counter]:
        return 0, Counter()

    def add(self, buffer: tuple[int, Counter], rows: pd.DataFrame) -> tuple[int, Counter]:
        cents, days = buffer
        units = np.rint(rows["sales"].to_numpy() * 100).astype(np.int64)
        days.update(rows["day"].to_list())
        return cents + int(units.sum()), days

    def merge(self, left: tuple[int, Counter], right: tuple[int, Counter]) -> tuple[int, Counter]:
        return left[0] + right[0], left[1] + right[1]

    def result(self, buffer: tuple[int, Counter]) -> tuple[float, dt.date, int]:
        cents, days = buffer
        day, records = min(days.items(), key=lambda item: (-item[1], item[0]))
        return cents / 100, day, records


@query(
    "user_aggregate_merged",
    f"""WITH {LINES_SQL}, mode_days AS ({MODE_SQL.format(key="l_returnflag,", ts="l_shipdate", source="lineitem")}),
    sums AS (SELECT l_returnflag, CAST(date_trunc('month', day) AS DATE) AS month,
                    CAST(sum(amount) AS DOUBLE) AS sales FROM lines_in GROUP BY ALL)
    SELECT l_returnflag, month, sales, mode_day, records FROM sums JOIN mode_days USING (l_returnflag, month)""",
)
def user_aggregate_merged(spark, sf_dir):
    """A Python aggregate with the four methods of a mergeable one: one buffer a month and task is exchanged."""
    lines = lineitem(spark, sf_dir).withColumn("month", cal.month_of(F.col("day")))
    return merge_aggregate(
        lines, ["l_returnflag", "month"], ["sales", "day"], SumAndMode(),
        "sales double, mode_day date, records bigint",
    )
