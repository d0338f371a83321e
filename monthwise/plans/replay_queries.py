"""What a record-by-record watermark keeps, drops and leaves open."""

from __future__ import annotations

from monthwise.operators import replay as rp
from monthwise.plans.registry import ORDERS_SQL, orders, query

REPLAY_SQL = f"""
{ORDERS_SQL},
arrivals AS (
  SELECT *, CAST(date_trunc('month', day) AS DATE) AS month, row_number() OVER (
    ORDER BY day + CAST(o_orderkey % 45 AS INTEGER), o_orderkey) AS pos FROM orders_in),
day_first AS (SELECT day, min(pos) AS first_pos FROM arrivals GROUP BY day),
spans AS (SELECT DISTINCT month, CAST(month + INTERVAL 1 MONTH AS DATE) + 1 AS deadline FROM arrivals),
fire AS (
  SELECT month, min(first_pos) AS fire_pos
  FROM spans LEFT JOIN day_first ON day_first.day >= deadline GROUP BY month)"""


@query(
    "closed_months_replay",
    f"""WITH {REPLAY_SQL}
    SELECT month, CAST(sum(amount) AS DOUBLE) AS sales
    FROM arrivals JOIN fire USING (month) WHERE pos <= fire_pos GROUP BY month""",
)
def closed_months_replay(spark, sf_dir):
    return rp.closed_months(orders(spark, sf_dir), "day", "sales", "seq", scale=2)


@query(
    "closed_months_by_series",
    f"""WITH {REPLAY_SQL}
    SELECT o_custkey, month, CAST(sum(amount) AS DOUBLE) AS sales
    FROM arrivals JOIN fire USING (month) WHERE pos <= fire_pos GROUP BY o_custkey, month""",
)
def closed_months_by_series(spark, sf_dir):
    return rp.closed_months(orders(spark, sf_dir), "day", "sales", "seq", ["o_custkey"], scale=2)


@query(
    "late_records",
    f"""WITH {REPLAY_SQL}
    SELECT o_orderkey, month, o_totalprice AS sales
    FROM arrivals JOIN fire USING (month) WHERE pos > fire_pos""",
)
def late_records(spark, sf_dir):
    late = rp.late_records(orders(spark, sf_dir), "day", "seq")
    return late.select("o_orderkey", "month", "sales")


@query("open_months", f"WITH {REPLAY_SQL} SELECT month FROM fire WHERE fire_pos IS NULL")
def open_months(spark, sf_dir):
    return rp.open_months(orders(spark, sf_dir), "day", "seq")
