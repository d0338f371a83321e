"""Differences, lags, sliding windows, holdout split and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthwise.config import SERVE_LAGS, TRAIN_LAGS
from monthwise.operators import features as ft
from monthwise.operators import scaling as sc
from monthwise.operators.forecast import forecast_records, forecast_windows
from monthwise.operators.latest import latest_per_key
from monthwise.operators.models import oldest_feature
from monthwise.operators.monthly import monthly_totals
from monthwise.plans.monthly_queries import NATION_SQL, nation_months
from monthwise.plans.registry import LINES_SQL, ORDERS_SQL, lineitem, months_sql, orders, query

PRIORITY = ["o_orderpriority"]
SUPPLIER = ["l_suppkey"]


def priority_months(spark, sf_dir):
    return monthly_totals(orders(spark, sf_dir), "day", "sales", PRIORITY, scale=2)


def supplier_months(spark, sf_dir):
    return monthly_totals(lineitem(spark, sf_dir), "day", "sales", SUPPLIER, scale=2)


PRIORITY_SQL = f"{ORDERS_SQL}, {months_sql('orders_in', 'o_orderpriority')}"
SUPPLIER_SQL = f"{LINES_SQL}, {months_sql('lines_in', 'l_suppkey')}"


def lags_sql(series: str, count: int) -> str:
    """CTEs ``diffs`` and ``lags`` on top of ``months``."""
    over = f"OVER (PARTITION BY {series} ORDER BY month)"
    lags = ", ".join(f"lag(difference, {i}) {over} AS lag_{i}" for i in range(1, count + 1))
    return f"""
diffs AS (SELECT *, sales - lag(sales) {over} AS difference FROM months),
lags AS (SELECT * FROM (SELECT *, {lags} FROM diffs) WHERE lag_{count} IS NOT NULL)"""


def lag_columns(count: int) -> str:
    return ", ".join(["difference", *ft.lag_names(count)])


@query(
    "sales_difference",
    f"""WITH {PRIORITY_SQL} SELECT * FROM (
      SELECT o_orderpriority, month, sales, lag(sales) OVER w AS prev_sales,
             sales - lag(sales) OVER w AS difference
      FROM months WINDOW w AS (PARTITION BY o_orderpriority ORDER BY month))
    WHERE prev_sales IS NOT NULL""",
)
def sales_difference(spark, sf_dir):
    return ft.differences(priority_months(spark, sf_dir), PRIORITY)


@query(
    "lag_matrix_train",
    f"WITH {PRIORITY_SQL}, {lags_sql('o_orderpriority', TRAIN_LAGS)} "
    f"SELECT o_orderpriority, month, sales, {lag_columns(TRAIN_LAGS)} FROM lags",
)
def lag_matrix_train(spark, sf_dir):
    return ft.lag_matrix(priority_months(spark, sf_dir), TRAIN_LAGS, PRIORITY)


@query(
    "lag_matrix_serve",
    f"WITH {SUPPLIER_SQL}, {lags_sql('l_suppkey', SERVE_LAGS)} "
    f"SELECT l_suppkey, month, sales, {lag_columns(SERVE_LAGS)} FROM lags",
)
def lag_matrix_serve(spark, sf_dir):
    return ft.lag_matrix(supplier_months(spark, sf_dir), SERVE_LAGS, SUPPLIER)


def windows_sql(series: str) -> str:
    """A CTE ``windows`` with ``series, month, items`` on top of ``months``."""
    return f"""
windows AS (SELECT * FROM (
  SELECT {series}, month, list(struct_pack(date := month, sales := sales)) OVER (
           PARTITION BY {series} ORDER BY month ROWS 16 PRECEDING) AS items
  FROM months) WHERE len(items) = 17)"""


WINDOW_SUMMARY_SQL = """
SELECT {series}, month, CAST(len(items) AS BIGINT) AS months, items[1].date AS first_date,
       items[17].date AS last_date, items[1].sales AS first_sales, items[17].sales AS last_sales,
       CAST(list_sum([CAST(i.sales AS DECIMAL(18,2)) for i in items]) AS DOUBLE) AS total
FROM windows"""


def window_summary(windows, series):
    cents = F.aggregate(
        F.transform("data", lambda i: F.rint(i["sales"] * 100).cast("bigint")),
        F.lit(0).cast("bigint"),
        lambda a, b: a + b,
    )
    return windows.select(
        *series,
        "month",
        F.size("data").cast("bigint").alias("months"),
        F.element_at("data", 1)["date"].alias("first_date"),
        ft.last_item(F.col("data"))["date"].alias("last_date"),
        F.element_at("data", 1)["sales"].alias("first_sales"),
        ft.last_item(F.col("data"))["sales"].alias("last_sales"),
        (cents / F.lit(100.0)).alias("total"),
    )


@query(
    "rolling_17_window",
    f"WITH {SUPPLIER_SQL}, {windows_sql('l_suppkey')} {WINDOW_SUMMARY_SQL.format(series='l_suppkey')}",
)
def rolling_17_window(spark, sf_dir):
    return window_summary(ft.sliding_windows(supplier_months(spark, sf_dir), SUPPLIER), SUPPLIER)


@query(
    "rolling_17_window_by_nation",
    f"WITH {NATION_SQL}, {months_sql('nation_in', 'n_name')}, {windows_sql('n_name')} "
    f"{WINDOW_SUMMARY_SQL.format(series='n_name')}",
)
def rolling_17_window_by_nation(spark, sf_dir):
    windows = ft.sliding_windows(nation_months(spark, sf_dir), ["n_name"])
    return window_summary(windows, ["n_name"])


@query(
    "window_messages",
    f"""WITH {SUPPLIER_SQL}, {windows_sql('l_suppkey')}
    SELECT l_suppkey, month, '{{"data":[' || array_to_string([
      '{{"date":"' || strftime(i.date, '%Y-%m-%d') || '","sales":' || CAST(i.sales AS VARCHAR)
      || '}}' for i in items], ',') || ']}}' AS value FROM windows""",
)
def window_messages(spark, sf_dir):
    windows = ft.sliding_windows(supplier_months(spark, sf_dir), SUPPLIER)
    return ft.window_messages(windows)


@query(
    "windows_last_write",
    f"""WITH {ORDERS_SQL},
    first_sent AS (
      SELECT o_orderpriority, CAST(date_trunc('month', day) AS DATE) AS month,
             CAST(sum(amount) AS DOUBLE) AS sales FROM orders_in GROUP BY 1, 2),
    sent_again AS (
      SELECT o_orderpriority, CAST(date_trunc('month', day) AS DATE) AS month,
             CAST(sum(amount) AS DOUBLE) AS sales FROM orders_in
      WHERE o_orderstatus = 'F' AND year(day) = 1998 GROUP BY 1, 2),
    months AS (
      SELECT o_orderpriority, month, coalesce(a.sales, f.sales) AS sales
      FROM first_sent f LEFT JOIN sent_again a USING (o_orderpriority, month)),
    {windows_sql('o_orderpriority')} {WINDOW_SUMMARY_SQL.format(series='o_orderpriority')}""",
)
def windows_last_write(spark, sf_dir):
    """Months of 1998 are sent a second time with other totals; the later total counts."""
    source = orders(spark, sf_dir)
    again = source.filter((F.col("o_orderstatus") == "F") & (F.year("day") == 1998))
    sent = [
        monthly_totals(part, "day", "sales", PRIORITY, scale=2).withColumn("sent", F.lit(i))
        for i, part in enumerate([source, again])
    ]
    last = latest_per_key(sent[0].unionByName(sent[1]), [*PRIORITY, "month"], ["sent"])
    return window_summary(ft.sliding_windows(last.drop("sent"), PRIORITY), PRIORITY)


@query(
    "window_rows",
    f"""WITH {PRIORITY_SQL}
    SELECT e.o_orderpriority, e.month, m.month AS date, m.sales
    FROM months e JOIN months m
      ON e.o_orderpriority = m.o_orderpriority AND m.pos BETWEEN e.pos - 16 AND e.pos
    WHERE e.pos >= 17""",
)
def window_rows(spark, sf_dir):
    windows = ft.sliding_windows(priority_months(spark, sf_dir), PRIORITY)
    return ft.window_rows(ft.window_messages(windows))


@query(
    "window_tail",
    f"""WITH {PRIORITY_SQL}, {windows_sql('o_orderpriority')}
    SELECT o_orderpriority, month, items[17].date AS start, items[17].sales AS last_sales,
           items[12].date AS six_from, items[12].sales AS six_from_sales,
           CAST(6 AS BIGINT) AS kept FROM windows""",
)
def window_tail(spark, sf_dir):
    windows = ft.sliding_windows(priority_months(spark, sf_dir), PRIORITY)
    tail = windows.withColumn("six", ft.last_items(F.col("data")))
    return tail.select(
        *PRIORITY,
        "month",
        ft.last_item(F.col("data"))["date"].alias("start"),
        ft.last_item(F.col("data"))["sales"].alias("last_sales"),
        F.col("six")[0]["date"].alias("six_from"),
        F.col("six")[0]["sales"].alias("six_from_sales"),
        F.size("six").cast("bigint").alias("kept"),
    )


SPLIT_SQL = f"""
split AS (
  SELECT *, row_number() OVER (PARTITION BY {{series}} ORDER BY month DESC) <= 6 AS is_test
  FROM lags)"""


@query(
    "train_test_split",
    f"WITH {SUPPLIER_SQL}, {lags_sql('l_suppkey', TRAIN_LAGS)}, {SPLIT_SQL.format(series='l_suppkey')} "
    f"SELECT l_suppkey, month, sales, {lag_columns(TRAIN_LAGS)}, is_test FROM split",
)
def train_test_split(spark, sf_dir):
    rows = ft.lag_matrix(supplier_months(spark, sf_dir), TRAIN_LAGS, SUPPLIER)
    return ft.holdout_split(rows, SUPPLIER)


TRAIN_COLUMNS = ["difference", *ft.lag_names(TRAIN_LAGS)]


def split_rows(spark, sf_dir):
    rows = ft.lag_matrix(priority_months(spark, sf_dir), TRAIN_LAGS, PRIORITY)
    return ft.holdout_split(rows, PRIORITY)


PRIORITY_SPLIT_SQL = (
    f"{PRIORITY_SQL}, {lags_sql('o_orderpriority', TRAIN_LAGS)}, "
    f"{SPLIT_SQL.format(series='o_orderpriority')}"
)
RANGES_SQL = "ranges AS (" + " UNION ALL ".join(
    f"""SELECT o_orderpriority, '{c}' AS "column", min({c}) AS low, max({c}) AS high
    FROM split WHERE NOT is_test GROUP BY o_orderpriority"""
    for c in TRAIN_COLUMNS
) + ")"


@query(
    "minmax_params",
    f'WITH {PRIORITY_SPLIT_SQL}, {RANGES_SQL} SELECT o_orderpriority, "column", low, high FROM ranges',
)
def minmax_params(spark, sf_dir):
    train = split_rows(spark, sf_dir).filter(~F.col("is_test"))
    return sc.min_max_params(train, TRAIN_COLUMNS, PRIORITY)


def scaled_sql(column: str) -> str:
    low = f"min(CASE WHEN NOT is_test THEN {column} END) OVER s"
    high = f"max(CASE WHEN NOT is_test THEN {column} END) OVER s"
    width = f"CASE WHEN {high} = {low} THEN 1.0 ELSE {high} - {low} END"
    return f"CAST(2.0 AS DOUBLE) * ({column} - {low}) / ({width}) - 1.0 AS {column}"


@query(
    "minmax_scaled",
    f"WITH {PRIORITY_SPLIT_SQL} SELECT o_orderpriority, month, sales, is_test, "
    + ", ".join(scaled_sql(c) for c in TRAIN_COLUMNS)
    + " FROM split WINDOW s AS (PARTITION BY o_orderpriority)",
)
def minmax_scaled(spark, sf_dir):
    rows = split_rows(spark, sf_dir).withColumn("is_train", ~F.col("is_test"))
    return sc.scale_by_series(rows, TRAIN_COLUMNS, PRIORITY, "is_train").drop("is_train")


@query(
    "minmax_inverse",
    f"WITH {PRIORITY_SPLIT_SQL} SELECT o_orderpriority, month, is_test, "
    + ", ".join(f"round({c}, 4) AS {c}" for c in TRAIN_COLUMNS) + " FROM split",
)
def minmax_inverse(spark, sf_dir):
    rows = split_rows(spark, sf_dir)
    scaler = sc.SeriesScaler.fit(rows.filter(~F.col("is_test")), TRAIN_COLUMNS, PRIORITY)
    bound = scaler.attach(rows)

    def back_and_forth(column):
        scaled = scaler.scale(F.col(column), column)
        return F.round(scaler.unscale(scaled, column), 4).alias(column)

    return bound.select(*PRIORITY, "month", "is_test", *map(back_and_forth, TRAIN_COLUMNS))


NULL_SERIES_SQL = f"""{ORDERS_SQL},
keyed AS (SELECT *, CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE o_orderpriority END AS kind
          FROM orders_in),
{months_sql('keyed', 'kind').strip()}"""


@query(
    "lag_matrix_null_series",
    f"WITH {NULL_SERIES_SQL}, {lags_sql('kind', TRAIN_LAGS)} "
    f"SELECT kind, month, sales, {lag_columns(TRAIN_LAGS)} FROM lags",
)
def lag_matrix_null_series(spark, sf_dir):
    """A series without a name is a series."""
    kind = F.when(~F.col("o_orderpriority").startswith("5"), F.col("o_orderpriority"))
    records = orders(spark, sf_dir).withColumn("kind", kind)
    monthly = monthly_totals(records, "day", "sales", ["kind"], scale=2)
    return ft.lag_matrix(monthly, TRAIN_LAGS, ["kind"])


@query(
    "forecast_series_scaled",
    f"""WITH {PRIORITY_SQL}, counted AS (
      SELECT o_orderpriority, greatest(count(*) - 16, 0) AS windows FROM months GROUP BY ALL)
    SELECT o_orderpriority,
      CAST(CASE WHEN o_orderpriority[1:1] IN ('2', '4') THEN 0 ELSE windows * 6 END AS BIGINT)
        AS forecasts,
      CASE WHEN o_orderpriority[1:1] IN ('2', '4') THEN 'no range for this series' END AS reason
    FROM counted""",
)
def forecast_series_scaled(spark, sf_dir):
    """Two of five series are new since training: they are refused by name, the others forecast."""
    monthly = priority_months(spark, sf_dir)
    known = ~F.substring("o_orderpriority", 1, 1).isin("2", "4")
    train = split_rows(spark, sf_dir).filter(~F.col("is_test") & known)
    scaler = sc.SeriesScaler.fit(train, TRAIN_COLUMNS, PRIORITY)
    windows = forecast_windows(monthly, oldest_feature(), "corrected", PRIORITY, scaler)
    made = forecast_records(windows, PRIORITY).groupBy(*PRIORITY).agg(
        F.count_if(F.col("step") > 0).alias("forecasts")
    )
    return made.join(scaler.refused(monthly), PRIORITY, "left")
