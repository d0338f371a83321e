"""Monthly totals to differences, lags and 17-month windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from monthwise.config import HOLDOUT_MONTHS, WINDOW_MONTHS
from monthwise.functions.text import window_data, window_json


def by_month(series: Sequence[str] = ()) -> WindowSpec:
    """The one window all month operators share, so that they sort and shuffle once."""
    return Window.partitionBy(*series).orderBy("month")


def lag_names(count: int) -> list[str]:
    return [f"lag_{i}" for i in range(1, count + 1)]


def add_difference(monthly: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Add ``prev_sales`` and ``difference`` to the previous month present in the data."""
    prev = F.lag("sales", 1).over(by_month(series))
    return monthly.withColumn("prev_sales", prev).withColumn(
        "difference", F.col("sales") - F.col("prev_sales")
    )


def differences(monthly: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """:func:`add_difference` without rows that miss a difference. Null keys are kept."""
    return add_difference(monthly, series).dropna(subset=["prev_sales", "difference"])


def add_lags(monthly: DataFrame, count: int, series: Sequence[str] = ()) -> DataFrame:
    """Add ``difference`` and ``lag_1 .. lag_count`` of it; short histories leave nulls."""
    order = by_month(series)
    lags = {n: F.lag("difference", i + 1).over(order) for i, n in enumerate(lag_names(count))}
    return add_difference(monthly, series).drop("prev_sales").withColumns(lags)


def lag_matrix(monthly: DataFrame, count: int, series: Sequence[str] = ()) -> DataFrame:
    """``series..., month, sales, difference, lag_1 .. lag_count``, rows with all of them only.

    Only these computed columns decide; a null series key or carried column loses no row.
    """
    return add_lags(monthly, count, series).dropna(subset=["difference", *lag_names(count)])


def sliding_windows(
    monthly: DataFrame,
    series: Sequence[str] = (),
    size: int = WINDOW_MONTHS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``series..., month, data``: the last ``size`` months up to each month, with the columns
    of ``monthly`` named in ``carry``.

    ``data`` is an array of ``date, sales`` in month order. Windows with fewer distinct months
    than ``size`` are left out. Input months must be unique per series; see
    :func:`monthwise.operators.latest.latest_per_key` for input where they are not.
    """
    frame = by_month(series).rowsBetween(-(size - 1), 0)
    item = F.struct(F.col("month").alias("date"), "sales")
    return (
        monthly.withColumn("data", F.collect_list(item).over(frame))
        .filter(F.size("data") == size)
        .select(*series, "month", *carry, "data")
    )


def window_messages(windows: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Replace the ``data`` array by its JSON text in ``value``, with the key of ``series`` if given."""
    return windows.withColumn("value", window_json(F.col("data"), series)).drop("data")


def window_rows(messages: DataFrame, value: str = "value") -> DataFrame:
    """One row ``date, sales`` per month of each JSON window, other columns repeated."""
    keep = [c for c in messages.columns if c != value]
    return messages.withColumn("data", window_data(F.col(value))).select(
        *keep, F.inline("data")
    )


def last_item(data: Column) -> Column:
    """Latest ``date, sales`` of a window."""
    return F.element_at(data, -1)


def last_items(data: Column, count: int = HOLDOUT_MONTHS) -> Column:
    """The ``count`` latest items of a window, in order."""
    return F.slice(data, -count, count)


def holdout_split(
    rows: DataFrame, series: Sequence[str] = (), held: int = HOLDOUT_MONTHS
) -> DataFrame:
    """Add ``is_test``: true for the last ``held`` rows of each series."""
    latest = Window.partitionBy(*series).orderBy(F.col("month").desc())
    return rows.withColumn("is_test", F.row_number().over(latest) <= held)
