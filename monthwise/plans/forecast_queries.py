"""Windows to forecasts and the result table.

The model here is an expression, the oldest known change, so that SQL can state the result.
Trained models are in ``model_queries``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from monthwise.config import TRAIN_LAGS
from monthwise.functions.text import forecast_message, forecast_payload
from monthwise.operators import features as ft
from monthwise.operators import scaling as sc
from monthwise.operators.forecast import (
    forecast_each, forecast_records, forecast_windows, result_table,
)
from monthwise.operators.latest import latest_per_key
from monthwise.operators.models import oldest_feature
from monthwise.operators.monthly import monthly_totals
from monthwise.operators.quality import good_records, parse_windows
from monthwise.plans.feature_queries import (
    PRIORITY, PRIORITY_SQL, SUPPLIER, SUPPLIER_SQL, TRAIN_COLUMNS, lags_sql, priority_months,
    supplier_months,
)
from monthwise.plans.jobs import result_rows, served
from monthwise.plans.registry import ORDERS_SQL, months_sql, orders, query
from monthwise.sinks.topics import forecast_values, window_values

SERIES_SQL = f"{ORDERS_SQL}, {months_sql('orders_in')}, one AS (SELECT *, 0 AS series FROM months)"


def ahead_sql(source: str, series: str, mode: str) -> str:
    """A CTE ``ahead`` with the six levels after each complete window of ``source``."""
    w = f"OVER (PARTITION BY {series} ORDER BY month)"
    if mode == "compat":
        # Row k of a window is the month k - 6 before its end; its score is the change 10 back.
        scores = ", ".join(f"lag(diff, {10 + 6 - k}) {w} AS y{k}" for k in range(1, 7))
        levels = ["sales + y1"] + [f"y{k - 1} + y{k}" for k in range(2, 7)]
    else:
        # The oldest of the 11 features of step k is the change 11 - k before the window's end.
        scores = ", ".join(f"lag(diff, {11 - k}) {w} AS y{k}" for k in range(1, 7))
        levels = ["sales" + "".join(f" + y{i}" for i in range(1, k + 1)) for k in range(1, 7)]
    listed = ", ".join(levels)
    return f"""
changes AS (SELECT *, sales - lag(sales) {w} AS diff, lead(month) {w} AS next_month
            FROM {source}),
scores AS (SELECT *, {scores} FROM changes),
ahead AS (SELECT *, [{listed}] AS levels FROM scores WHERE pos >= 17)"""


def records_sql(source: str, series: str) -> str:
    return f"""
SELECT {series}, e.month AS window_end, m.month AS date, m.sales, m.pos - e.pos AS step
FROM ahead e JOIN {source} m USING ({series}) WHERE m.pos BETWEEN e.pos - 5 AND e.pos
UNION ALL
SELECT {series}, month, CAST(month + to_months(CAST(k AS INTEGER)) AS DATE), levels[k], k
FROM ahead, (SELECT unnest(range(1, 7)) AS k)"""


@query(
    "forecast_compat",
    f"WITH {PRIORITY_SQL}, {ahead_sql('months', 'o_orderpriority', 'compat')} "
    f"{records_sql('months', 'o_orderpriority')}",
)
def forecast_compat(spark, sf_dir):
    windows = forecast_windows(priority_months(spark, sf_dir), oldest_feature(), "compat", PRIORITY)
    return forecast_records(windows, PRIORITY)


@query(
    "forecast_corrected",
    f"WITH {PRIORITY_SQL}, {ahead_sql('months', 'o_orderpriority', 'corrected')} "
    f"{records_sql('months', 'o_orderpriority')}",
)
def forecast_corrected(spark, sf_dir):
    windows = forecast_windows(
        priority_months(spark, sf_dir), oldest_feature(), "corrected", PRIORITY
    )
    return forecast_records(windows, PRIORITY)


def result_sql(source: str, series: str, columns: str) -> str:
    """Upsert all records of all windows by date in window order."""
    return f"""
SELECT {columns} date, arg_max(sales, window_end) AS sales, arg_max(step, window_end) > 0 AS is_forecast
FROM ({records_sql(source, series)}) GROUP BY {series}, date"""


@query(
    "forecast_result_table",
    f"WITH {SERIES_SQL}, {ahead_sql('one', 'series', 'compat')} {result_sql('one', 'series', '')}",
)
def forecast_result_table(spark, sf_dir):
    monthly = monthly_totals(orders(spark, sf_dir), "day", "sales", scale=2)
    return result_table(forecast_windows(monthly, oldest_feature(), "compat")).orderBy("date")


@query(
    "forecast_result_corrected",
    f"WITH {SUPPLIER_SQL}, {ahead_sql('months', 'l_suppkey', 'corrected')} "
    f"{result_sql('months', 'l_suppkey', 'l_suppkey,')}",
)
def forecast_result_corrected(spark, sf_dir):
    windows = forecast_windows(
        supplier_months(spark, sf_dir), oldest_feature(), "corrected", SUPPLIER
    )
    return result_table(windows, SUPPLIER)


@query(
    "forecast_served",
    f"WITH {PRIORITY_SQL}, {ahead_sql('months', 'o_orderpriority', 'corrected')} "
    f"{records_sql('months', 'o_orderpriority')}",
)
def forecast_served(spark, sf_dir):
    """Windows as messages, answered one by one without knowing the series they are from."""
    windows = ft.sliding_windows(priority_months(spark, sf_dir), PRIORITY)
    messages = ft.window_messages(windows).drop("month")
    usable = good_records(parse_windows(messages))
    return forecast_records(forecast_each(usable, oldest_feature(), "corrected"), PRIORITY)


@query(
    "results_view",
    f"WITH {SERIES_SQL}, {ahead_sql('one', 'series', 'compat')}, "
    f"results AS ({result_sql('one', 'series', '')}) SELECT date, sales FROM results",
)
def results_view(spark, sf_dir):
    """The result table under a name, read with SQL."""
    forecast_result_table(spark, sf_dir).createOrReplaceTempView("lstm_results")
    return spark.sql("SELECT date, sales FROM lstm_results ORDER BY date ASC")


CUSTOMER = ["o_custkey"]


@query(
    "forecast_result_by_customer",
    f"WITH {ORDERS_SQL}, {months_sql('orders_in', 'o_custkey')}, "
    f"{ahead_sql('months', 'o_custkey', 'compat')} {result_sql('months', 'o_custkey', 'o_custkey,')}",
)
def forecast_result_by_customer(spark, sf_dir):
    """Sparse series: most calendar months of a customer are missing and stay so."""
    monthly = monthly_totals(orders(spark, sf_dir), "day", "sales", CUSTOMER, scale=2)
    return result_table(forecast_windows(monthly, oldest_feature(), "compat", CUSTOMER), CUSTOMER)


@query(
    "forecast_upserted",
    f"WITH {SUPPLIER_SQL}, {ahead_sql('months', 'l_suppkey', 'compat')} "
    f"{result_sql('months', 'l_suppkey', 'l_suppkey,')}",
)
def forecast_upserted(spark, sf_dir):
    """The result table the long way: every record of every window, last write wins."""
    windows = forecast_windows(supplier_months(spark, sf_dir), oldest_feature(), "compat", SUPPLIER)
    last = latest_per_key(forecast_records(windows, SUPPLIER), [*SUPPLIER, "date"], ["window_end"])
    return last.select(*SUPPLIER, "date", "sales", (F.col("step") > 0).alias("is_forecast"))


@query(
    "forecast_messages",
    f"""WITH {SUPPLIER_SQL}, {ahead_sql('months', 'l_suppkey', 'compat')},
    result AS ({result_sql('months', 'l_suppkey', 'l_suppkey,')})
    SELECT l_suppkey, strftime(date, '%Y-%m-%d') AS date_text, sales, is_forecast,
      CASE WHEN NOT is_forecast THEN '{{"schema":{{"type":"struct","fields":['
      || '{{"type":"string","optional":false,"field":"date"}},'
      || '{{"type":"string","optional":false,"field":"sales"}}],"optional":false,'
      || '"name":"com.github.jcustenborder.kafka.connect.model.Value"}},'
      || '"payload":{{"date":"' || strftime(date, '%Y-%m-%d') || '","sales":"'
      || CAST(sales AS VARCHAR) || '"}}}}' END AS value
    FROM result""",
)
def forecast_messages(spark, sf_dir):
    """Numbers are read back from the messages. Texts are compared for actual months, whose two
    decimals both engines print alike."""
    result = forecast_upserted(spark, sf_dir)
    sent = result.withColumn("value", forecast_message(F.col("date"), F.col("sales")))
    back = sent.withColumn("back", forecast_payload(F.col("value")))
    return back.select(
        *SUPPLIER,
        F.date_format("back.date", "yyyy-MM-dd").alias("date_text"),
        F.col("back.sales").alias("sales"),
        "is_forecast",
        F.when(~F.col("is_forecast"), F.col("value")).alias("value"),
    )


@query(
    "forecast_served_by_series",
    f"WITH {PRIORITY_SQL}, {ahead_sql('months', 'o_orderpriority', 'compat')} "
    f"{result_sql('months', 'o_orderpriority', 'o_orderpriority,')}",
)
def forecast_served_by_series(spark, sf_dir):
    """Window and result messages that carry the key of their series, as texts all the way to the table."""
    windows = ft.sliding_windows(priority_months(spark, sf_dir), PRIORITY)
    answers = served(window_values(windows, PRIORITY), oldest_feature(), "compat", series=PRIORITY)
    place = (F.unix_date("window_end") * 100 + F.col("step")).cast("bigint")
    message = forecast_message(F.col("date"), F.col("sales"), PRIORITY)
    rows = result_rows(answers.select(message.alias("value"), place.alias("offset")), PRIORITY)
    last = latest_per_key(good_records(rows), [*PRIORITY, "date"], ["seq"])
    return last.select(
        *PRIORITY, "date", "sales", (F.pmod(F.col("seq") + 50, F.lit(100)) > 50).alias("is_forecast")
    )


@query(
    "topic_values",
    f"""WITH {PRIORITY_SQL}, spans AS (
      SELECT month, count(*) OVER w AS n, list({{'d': month, 's': sales}}) OVER w AS items FROM months
      WINDOW w AS (PARTITION BY o_orderpriority ORDER BY month ROWS BETWEEN 16 PRECEDING AND CURRENT ROW))
    SELECT NULL::VARCHAR AS key, '{{"data":[' || array_to_string(list_transform(items, lambda i:
        '{{"date":"' || strftime(i.d, '%Y-%m-%d') || '","sales":' || CAST(round(i.s / 16) AS BIGINT) || '.0}}'),
        ',') || ']}}' AS value FROM spans WHERE n = 17
    UNION ALL
    SELECT strftime(month, '%Y-%m-%d'), '{{"schema":{{"type":"struct","fields":['
      || '{{"type":"string","optional":false,"field":"date"}},'
      || '{{"type":"string","optional":false,"field":"sales"}}],"optional":false,'
      || '"name":"com.github.jcustenborder.kafka.connect.model.Value"}},'
      || '"payload":{{"date":"' || strftime(month, '%Y-%m-%d') || '","sales":"'
      || CAST(round(sales / 16) AS BIGINT) || '.0"}}}}' FROM months""",
)
def topic_values(spark, sf_dir):
    """Keys and texts as the topic sinks send them: windows without a key, results keyed by their date.
    Sales are whole numbers below the size from which texts have an exponent."""
    monthly = priority_months(spark, sf_dir).withColumn("sales", F.round(F.col("sales") / 16))
    windows = window_values(ft.sliding_windows(monthly, PRIORITY))
    results = forecast_values(monthly.withColumnRenamed("month", "date"))
    return windows.select(F.lit(None).cast("string").alias("key"), "value").unionAll(results)


# Scaling as served: features and result use neighbouring columns' ranges in compat mode.
RANGE_COLUMNS = ", ".join(
    f"min({c}) AS low_{c}, max({c}) AS high_{c}" for c in TRAIN_COLUMNS
)


def _ranges_used(mode: str) -> tuple[str, str]:
    """Whose range scales the oldest feature, and whose the result."""
    return ("lag_10", "lag_11") if mode == "compat" else ("lag_11", "difference")


def scaled_levels_sql(mode: str) -> str:
    """The six levels after each window with pooled scaling of all series."""
    inner, outer = _ranges_used(mode)
    w = "OVER (PARTITION BY o_orderpriority ORDER BY month)"
    # The scored change of step k, as without scaling.
    back = 16 if mode == "compat" else 11
    scores = ", ".join(
        f"((CAST(2.0 AS DOUBLE) * (lag(difference, {back - k}) {w} - low_{inner}) "
        f"/ (high_{inner} - low_{inner}) - 1.0) + 1.0) / 2.0 * (high_{outer} - low_{outer}) "
        f"+ low_{outer} AS y{k}"
        for k in range(1, 7)
    )
    if mode == "compat":
        levels = ["sales + y1"] + [f"y{k - 1} + y{k}" for k in range(2, 7)]
    else:
        levels = ["sales" + "".join(f" + y{i}" for i in range(1, k + 1)) for k in range(1, 7)]
    return f"""
WITH {PRIORITY_SQL}, {lags_sql('o_orderpriority', TRAIN_LAGS)},
ranges AS (SELECT {RANGE_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY month DESC) AS back
  FROM lags) WHERE back > 6),
scored AS (SELECT *, {scores} FROM diffs, ranges),
ahead AS (SELECT *, [{', '.join(levels)}] AS levels FROM scored WHERE pos >= 17)
SELECT o_orderpriority, month, k AS step, round(levels[k], 4) AS level
FROM ahead, (SELECT unnest(range(1, 7)) AS k)"""


def scaled_levels(spark, sf_dir, mode):
    monthly = priority_months(spark, sf_dir)
    rows = ft.holdout_split(ft.lag_matrix(monthly, TRAIN_LAGS, PRIORITY), PRIORITY)
    scaler = sc.MinMaxScaler.fit(rows.filter(~F.col("is_test")), TRAIN_COLUMNS)
    windows = forecast_windows(monthly, oldest_feature(), mode, PRIORITY, scaler)
    levels = windows.select(*PRIORITY, "month", F.posexplode("ahead").alias("at", "level"))
    return levels.select(
        *PRIORITY, "month", (F.col("at") + 1).cast("bigint").alias("step"),
        F.round("level", 4).alias("level"),
    )


@query("forecast_scaled_compat", scaled_levels_sql("compat"))
def forecast_scaled_compat(spark, sf_dir):
    return scaled_levels(spark, sf_dir, "compat")


@query("forecast_scaled_corrected", scaled_levels_sql("corrected"))
def forecast_scaled_corrected(spark, sf_dir):
    return scaled_levels(spark, sf_dir, "corrected")
