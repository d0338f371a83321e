"""17 months in, six actual and six forecast months out.

Two modes exist and differ in numbers on purpose:

``compat``
    Scores the six latest rows of the window, which describe months already known, and labels
    the results as the next six months. Each feature is scaled by the range of the column at
    the same position of the training matrix and the result by the range of the last column.
    The first result is added to the last sales, each further one to its predecessor.
``corrected``
    Scores the latest row for the next month, feeds the result back as newest change and
    repeats, with the range of each feature's own column and the label's range for the result.
    Results are summed up from the last sales on.

A model sees one row at a time, so the score of a month is the same in every window that
contains it. The batch form therefore scores each month once instead of six times.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.config import HORIZON, SERVE_LAGS, TRAIN_LAGS, WINDOW_MONTHS
from monthwise.operators.features import add_lags, by_month, lag_names
from monthwise.operators.models import Scorer
from monthwise.operators.scaling import MinMaxScaler, SeriesScaler

Mode = Literal["compat", "corrected"]
Scaler = MinMaxScaler | SeriesScaler

RECENT = "recent"
AHEAD = "ahead"


def forecast_windows(
    monthly: DataFrame,
    scorer: Scorer,
    mode: Mode,
    series: Sequence[str] = (),
    scaler: Scaler | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per complete window: ``series..., month, position, next_month, recent, ahead``
    and the columns of ``monthly`` named in ``carry``.

    ``month`` is the window's last month and ``position`` its number within the series;
    ``next_month`` is the series' next month with data. ``recent`` holds the last six months as
    ``date, sales``, ``ahead`` the six forecast levels. One shuffle by series, one sort.
    """
    order = by_month(series)
    rows = add_lags(monthly, SERVE_LAGS, series).withColumns(
        {
            "position": F.row_number().over(order),
            "next_month": F.lead("month").over(order),
            RECENT: F.collect_list(F.struct(F.col("month").alias("date"), "sales")).over(
                order.rowsBetween(-(HORIZON - 1), 0)
            ),
        }
    )
    if scaler is not None:
        rows = scaler.attach(rows)
    if mode == "compat":
        windows = _known_month_scores(rows, scorer, series, scaler)
    elif mode == "corrected":
        windows = _next_month_scores(rows, scorer, scaler)
    else:
        raise _unknown(mode)
    return windows.select(*series, "month", *carry, "position", "next_month", RECENT, AHEAD)


def _change(
    rows: DataFrame,
    scorer: Scorer,
    scaler: Scaler | None,
    features: Sequence[str],
    ranges: Sequence[str],
    result_range: str,
    output: str,
) -> DataFrame:
    """Add the predicted change. ``ranges`` names the column whose range scales each feature."""
    if scaler is None:
        return scorer.score(rows, features, output)
    scaled = {f"x_{i}": scaler.scale(F.col(f), r) for i, (f, r) in enumerate(zip(features, ranges))}
    scored = scorer.score(rows.withColumns(scaled), list(scaled), "y")
    back = scaler.unscale(F.col("y"), result_range)
    return scored.withColumn(output, back).drop(*scaled, "y")


def _unknown(mode: str) -> ValueError:
    return ValueError(f"mode must be 'compat' or 'corrected', not {mode!r}")


def _neighbour_levels(last: str) -> list[Column]:
    """First change on top of the last sales, then each change on top of its predecessor."""
    change = [F.col(f"change_{k}") for k in range(1, HORIZON + 1)]
    return [F.col(last) + change[0], *[a + b for a, b in zip(change, change[1:])]]


def _running_levels(last: str) -> list[Column]:
    """All changes so far on top of the last sales."""
    levels = [F.col(last)]
    for k in range(1, HORIZON + 1):
        levels.append(levels[-1] + F.col(f"change_{k}"))
    return levels[1:]


def _recursive_changes(
    rows: DataFrame, scorer: Scorer, scaler: Scaler | None, known: Sequence[str]
) -> DataFrame:
    """Add ``change_1`` to ``change_6``; ``known`` names the latest changes, newest first."""
    lags, known = lag_names(TRAIN_LAGS), list(known)
    for k in range(1, HORIZON + 1):
        rows = _change(rows, scorer, scaler, known, lags, "difference", f"change_{k}")
        known = [f"change_{k}", *known[:-1]]
    return rows


def _known_month_scores(
    rows: DataFrame, scorer: Scorer, series: Sequence[str], scaler: Scaler | None
) -> DataFrame:
    rows = rows.filter(F.col("position") > WINDOW_MONTHS - HORIZON)
    features = ["difference", *lag_names(SERVE_LAGS)]
    scored = _change(rows, scorer, scaler, features, features, f"lag_{TRAIN_LAGS}", "change")
    order = by_month(series)
    back = [F.lag("change", HORIZON - k).over(order) for k in range(1, HORIZON)]
    changes = {f"change_{k}": c for k, c in enumerate([*back, F.col("change")], start=1)}
    return (
        scored.withColumns(changes)
        .filter(F.col("position") >= WINDOW_MONTHS)
        .withColumn(AHEAD, F.array(*_neighbour_levels("sales")))
    )


def _next_month_scores(rows: DataFrame, scorer: Scorer, scaler: Scaler | None) -> DataFrame:
    rows = rows.filter(F.col("position") >= WINDOW_MONTHS)
    rows = _recursive_changes(rows, scorer, scaler, ["difference", *lag_names(SERVE_LAGS)])
    return rows.withColumn(AHEAD, F.array(*_running_levels("sales")))


def forecast_each(
    windows: DataFrame, scorer: Scorer, mode: Mode, scaler: Scaler | None = None
) -> DataFrame:
    """Add ``month``, ``recent`` and ``ahead`` to windows that come one by one.

    ``windows`` has a ``data`` array of exactly 17 ``date, sales`` items, as parsed from window
    messages. Each row is handled on its own, so this also runs on a stream.
    """
    sales = [F.element_at("data", i)["sales"] for i in range(1, WINDOW_MONTHS + 1)]
    steps = {f"step_{i}": b - a for i, (a, b) in enumerate(zip(sales, sales[1:]), start=1)}
    rows = windows.withColumns({**steps, "last_sales": sales[-1]})
    latest = list(reversed(steps))
    width = SERVE_LAGS + 1
    if mode == "compat":
        names = ["difference", *lag_names(SERVE_LAGS)]
        for k in range(1, HORIZON + 1):
            features = latest[HORIZON - k:HORIZON - k + width]
            rows = _change(rows, scorer, scaler, features, names, f"lag_{TRAIN_LAGS}", f"change_{k}")
        levels = _neighbour_levels("last_sales")
    elif mode == "corrected":
        rows = _recursive_changes(rows, scorer, scaler, latest[:width])
        levels = _running_levels("last_sales")
    else:
        raise _unknown(mode)
    added = {
        "month": F.element_at("data", -1)["date"],
        RECENT: F.slice("data", -HORIZON, HORIZON),
        AHEAD: F.array(*levels),
    }
    return rows.withColumns(added).select(*windows.columns, *added)


RECORD = "array<struct<date:date,sales:double,step:bigint>>"


def _records(items: list[tuple[str, str, int]]) -> Column:
    """An array of records from ``(date, sales, step)`` with the first two as expressions."""
    fields = "named_struct('date', {}, 'sales', {}, 'step', {}L)"
    return F.expr(f"array({', '.join(fields.format(*item) for item in items)})")


def _actual_records(count: int) -> Column:
    items = [(f"element_at({RECENT}, -{back})", 1 - back) for back in range(count, 0, -1)]
    return _records([(f"{item}.date", f"{item}.sales", step) for item, step in items])


def _ahead_records() -> Column:
    steps = range(1, HORIZON + 1)
    return _records([(f"add_months(month, {k})", f"element_at({AHEAD}, {k})", k) for k in steps])


def forecast_records(windows: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """``series..., window_end, date, sales, step``: all twelve records of every window.

    ``step`` is 0 for the window's last month, negative before it and 1 to 6 for forecasts. A
    series that its scaler has no range for has actual records only.
    """
    records = F.concat(_actual_records(HORIZON), _ahead_records())
    rows = windows.select(*series, F.col("month").alias("window_end"), F.inline(records))
    return rows.filter((F.col("step") <= 0) | F.col("sales").isNotNull())


def result_table(windows: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """``series..., date, sales, is_forecast``: the last record written per date.

    Equal to upserting :func:`forecast_records` by date in window order, without making the
    records that later windows replace. A month with data ends up as actual: the first window
    brings its six months, each further one only its last. A forecast survives for months
    before the series' next month with data. No shuffle, and one row for most windows.
    """
    following = F.col("next_month")
    actual = F.when(F.col("position") == WINDOW_MONTHS, _actual_records(HORIZON)).otherwise(
        _actual_records(1)
    )
    no_gap = following == F.add_months("month", 1)
    ahead = F.when(no_gap, F.array().cast(RECORD)).otherwise(_ahead_records())
    records = windows.select(*series, "next_month", F.inline(F.concat(actual, ahead)))
    is_forecast = F.col("step") > 0
    open_month = following.isNull() | (F.col("date") < following)
    survives = ~is_forecast | (open_month & F.col("sales").isNotNull())
    return records.filter(survives).select(
        *series, "date", "sales", is_forecast.alias("is_forecast")
    )
