import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthwise.operators import features as ft
from monthwise.operators import models as md
from monthwise.operators import quality as ql
from monthwise.operators import replay as rp
from monthwise.operators import scaling as sc
from monthwise.operators.forecast import forecast_records, forecast_windows, result_table
from monthwise.operators.latest import latest_per_key
from monthwise.functions.text import finite_number
from monthwise.operators.monthly import exact_sum, fill_gaps, month_mode_day, monthly_totals
from tests import simulate as sim

NAN = float("nan")


def months_frame(spark, months, series=None):
    if series is None:
        return spark.createDataFrame(months, "month date, sales double")
    rows = [(s, m, v) for s, ms in series.items() for m, v in ms]
    return spark.createDataFrame(rows, "s string, month date, sales double")


def some_months(count, seed=0, start=dt.date(2013, 3, 1), gaps=()):
    rng = random.Random(seed)
    picked = [i for i in range(count + len(gaps)) if i not in gaps]
    return [(sim.plus_months(start, i), round(rng.uniform(100, 900), 2)) for i in picked]


def test_monthly_totals_null_nan_and_exact(spark):
    rows = [("a", dt.date(2014, 1, 3), 1.1), ("a", dt.date(2014, 1, 31), 2.2),
            ("a", dt.date(2014, 2, 1), None), ("b", dt.date(2014, 1, 1), NAN)]
    df = spark.createDataFrame(rows, "s string, day date, x double")
    got = {(r.s, r.month): r.sales for r in
           monthly_totals(df, "day", "x", ["s"], skip_nan=True).collect()}
    jan, feb = dt.date(2014, 1, 1), dt.date(2014, 2, 1)
    assert got == {("a", jan): pytest.approx(3.3), ("a", feb): 0.0, ("b", jan): 0.0}
    kept = monthly_totals(df.filter("s = 'b'"), "day", "x").first().sales
    assert np.isnan(kept)
    exact = monthly_totals(df.filter("s = 'a'"), "day", "x", scale=2).orderBy("month").collect()
    assert [r.sales for r in exact] == [3.3, 0.0]


def test_exact_sums_beyond_a_long_of_cents(spark):
    big = 9e13 + 0.25
    df = spark.range(0, 3000).select(
        F.lit(dt.date(2014, 1, 1)).alias("day"),
        F.when(F.col("id") % 2 == 0, F.lit(big)).otherwise(F.lit(-0.25)).alias("x"),
    )
    got = monthly_totals(df, "day", "x", scale=2).first().sales
    assert got == 1500 * 9e13


def test_mode_day_ties_go_to_the_earliest(spark):
    days = ["2014-01-05", "2014-01-05", "2014-01-02", "2014-01-02", "2014-01-09", "1960-02-03"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("day"))
    got = {r.month: (r.mode_day, r.records) for r in month_mode_day(df, "day").collect()}
    assert got == {
        dt.date(2014, 1, 1): (dt.date(2014, 1, 2), 2),
        dt.date(1960, 2, 1): (dt.date(1960, 2, 3), 1),
    }


def test_fill_gaps(spark):
    months = [(dt.date(2014, 11, 1), 1.0), (dt.date(2015, 2, 1), 2.0)]
    got = [tuple(r) for r in fill_gaps(months_frame(spark, months)).orderBy("month").collect()]
    assert got == [(dt.date(2014, 11, 1), 1.0), (dt.date(2014, 12, 1), 0.0),
                   (dt.date(2015, 1, 1), 0.0), (dt.date(2015, 2, 1), 2.0)]


@pytest.mark.parametrize("count,expected", [(16, 0), (17, 1), (18, 2)])
def test_windows_need_17_months(spark, count, expected):
    months = some_months(count)
    windows = ft.sliding_windows(months_frame(spark, months)).orderBy("month").collect()
    assert len(windows) == expected
    for row, want in zip(windows, sim.windows(months)):
        assert [(i.date, i.sales) for i in row.data] == want


def test_windows_count_months_present(spark):
    months = some_months(17, gaps=(4, 9))
    row = ft.sliding_windows(months_frame(spark, months)).collect()
    assert len(row) == 1 and len(row[0].data) == 17
    assert row[0].data[0].date == months[0][0]


def test_window_messages_survive_garbage(spark):
    df = spark.createDataFrame([("{oops",), ('{"data":[]}',)], "value string")
    assert ft.window_rows(df).count() == 0


def test_lags_and_holdout(spark):
    months = some_months(40)
    rows = ft.lag_matrix(months_frame(spark, months), 11).orderBy("month").collect()
    sales = [v for _, v in months]
    diffs = np.diff(sales)
    assert len(rows) == 40 - 12
    for i, row in enumerate(rows):
        want = [diffs[11 + i - k] for k in range(12)]
        assert [row["difference"], *[row[f"lag_{k}"] for k in range(1, 12)]] == want
    split = ft.holdout_split(ft.lag_matrix(months_frame(spark, months), 11)).orderBy("month")
    assert [r.is_test for r in split.collect()] == [False] * 22 + [True] * 6


def test_scaling_constant_and_outside(spark):
    df = spark.createDataFrame([(5.0, 0.0, True), (5.0, 10.0, True), (7.0, 20.0, False)],
                               "c double, x double, known boolean")
    scaler = sc.MinMaxScaler.fit(df.filter("known"), ["c", "x"])
    scaled = scaler.transform(df).orderBy("x").collect()
    assert [(r.c, r.x) for r in scaled] == [(-1.0, -1.0), (-1.0, 1.0), (3.0, 3.0)]
    back = scaler.inverse(scaler.transform(df)).orderBy("x").collect()
    assert [(r.c, r.x) for r in back] == [(5.0, 0.0), (5.0, 10.0), (7.0, 20.0)]
    by_window = sc.scale_by_series(df, ["c", "x"], train="known").orderBy("x").collect()
    assert [(r.c, r.x) for r in by_window] == [(r.c, r.x) for r in scaled]


def test_scaler_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 7.0)], "s string, x double")
    pooled = sc.MinMaxScaler.fit(df, ["x"])
    pooled.save(spark, str(tmp_path / "scaler"))
    assert sc.MinMaxScaler.load(spark, str(tmp_path / "scaler")).ranges == {"x": (1.0, 7.0)}
    each = sc.SeriesScaler.fit(df, ["x"], ["s"])
    got = each.attach(df).select("s", each.scale(F.col("x"), "x").alias("y")).collect()
    assert sorted(tuple(r) for r in got) == [("a", -1.0), ("a", 1.0), ("b", -1.0)]


def random_arrivals(seed, count=400, span=300, jitter=45):
    rng = random.Random(seed)
    start = dt.date(2019, 11, 20)
    days = [start + dt.timedelta(days=rng.randrange(span)) for _ in range(count)]
    order = sorted(range(count), key=lambda i: (days[i].toordinal() + rng.randrange(jitter), i))
    return [(days[i], float(rng.randrange(1, 1000))) for i in order]


@pytest.mark.parametrize("seed,delay,jitter", [(1, 1, 45), (2, 1, 400), (3, 5, 30), (4, 0, 10)])
def test_replay_equals_record_by_record(spark, seed, delay, jitter):
    arrivals = random_arrivals(seed, jitter=jitter)
    rows = [(i, d, x) for i, (d, x) in enumerate(arrivals)]
    df = spark.createDataFrame(rows, "seq long, day date, x double")
    emitted, late, still_open = sim.replay(arrivals, delay)
    got = rp.closed_months(df, "day", "x", "seq", delay_days=delay).collect()
    assert {r.month: r.sales for r in got} == dict(emitted)
    assert len(emitted) == len(dict(emitted))
    lates = rp.late_records(df, "day", "seq", delay_days=delay).collect()
    assert sorted((r.day, r.x) for r in lates) == sorted(late)
    opened = rp.open_months(df, "day", "seq", delay_days=delay).collect()
    assert sorted(r.month for r in opened) == still_open


def test_replay_emits_in_month_order():
    for seed in range(20):
        emitted, _, _ = sim.replay(random_arrivals(seed))
        assert [m for m, _ in emitted] == sorted(m for m, _ in emitted)


def test_settled_months(spark):
    days = [dt.date(2014, 1, 5), dt.date(2014, 2, 5), dt.date(2014, 3, 1)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    assert [r.month for r in rp.settled_months(df, "day").collect()] == [dt.date(2014, 1, 1)]
    more = df.union(spark.createDataFrame([(dt.date(2014, 3, 2),)], "day date"))
    got = sorted(r.month for r in rp.settled_months(more, "day").collect())
    assert got == [dt.date(2014, 1, 1), dt.date(2014, 2, 1)]


WEIGHTS = [0.3, -0.2, 0.1, 0.05, 0.4, -0.1, 0.2, 0.15, -0.3, 0.25, 0.5]


def weighted(features):
    return sum(w * f for w, f in zip(WEIGHTS, features))


def weighted_scorer():
    return md.ColumnScorer(lambda xs: sum((F.lit(w) * x for w, x in zip(WEIGHTS[1:], xs[1:])),
                                          F.lit(WEIGHTS[0]) * xs[0]))


@pytest.mark.parametrize("mode", ["compat", "corrected"])
@pytest.mark.parametrize("scaled", [False, True])
def test_forecasts_equal_window_by_window(spark, mode, scaled):
    series = {"a": some_months(30, 1), "b": some_months(20, 2, gaps=(3, 17, 18, 21)),
              "c": some_months(16, 3), "d": some_months(17, 4)}
    frame = months_frame(spark, None, series)
    scaler = ranges = None
    if scaled:
        columns = ["difference", *ft.lag_names(11)]
        scaler = sc.MinMaxScaler.fit(ft.lag_matrix(frame, 11, ["s"]), columns)
        ranges = [scaler.ranges[c] for c in columns]
    windows = forecast_windows(frame, weighted_scorer(), mode, ["s"], scaler)
    records = forecast_records(windows, ["s"]).collect()
    want = [
        (s, window[-1][0], i - 5, date, pytest.approx(sales, rel=1e-9))
        for s, months in series.items()
        for window in sim.windows(months)
        for i, (date, sales) in enumerate(sim.forecast(window, weighted, mode, ranges))
    ]
    got = sorted((r.s, r.window_end, r.step, r.date, r.sales) for r in records)
    assert got == sorted(want, key=lambda r: r[:3])

    table = result_table(windows, ["s"]).collect()
    expected = {
        (s, date): pytest.approx(sales, rel=1e-9)
        for s, months in series.items()
        for date, sales in sim.result_table(months, weighted, mode, ranges).items()
    }
    assert {(r.s, r.date): r.sales for r in table} == expected
    assert len(table) == len(expected)
    present = {(s, m) for s, months in series.items() for m, _ in months}
    assert all(r.is_forecast == ((r.s, r.date) not in present) for r in table)


def test_modes_differ_as_described(spark):
    frame = months_frame(spark, some_months(24, 9))
    compat = forecast_windows(frame, md.oldest_feature(), "compat").orderBy("month").collect()
    corrected = forecast_windows(frame, md.oldest_feature(), "corrected").orderBy("month").collect()
    assert [r.month for r in compat] == [r.month for r in corrected]
    assert all(a.recent == b.recent and a.ahead != b.ahead for a, b in zip(compat, corrected))
    with pytest.raises(ValueError):
        forecast_windows(frame, md.oldest_feature(), "other")


def test_per_series_scaling_equals_scaling_each_alone(spark):
    series = {"a": some_months(30, 1), "b": some_months(25, 2)}
    frame = months_frame(spark, None, series)
    columns = ["difference", *ft.lag_names(11)]
    each = sc.SeriesScaler.fit(ft.lag_matrix(frame, 11, ["s"]), columns, ["s"])
    got = forecast_windows(frame, weighted_scorer(), "corrected", ["s"], each)
    for s in series:
        alone = frame.filter(F.col("s") == s)
        scaler = sc.MinMaxScaler.fit(ft.lag_matrix(alone, 11, ["s"]), columns)
        want = forecast_windows(alone, weighted_scorer(), "corrected", ["s"], scaler)
        rows = got.filter(F.col("s") == s).orderBy("month").collect()
        assert rows == want.orderBy("month").collect()


def test_scorers_agree(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 11))
    y = x @ np.array(WEIGHTS) + 0.75
    rows = [tuple(float(v) for v in [b, *a]) for a, b in zip(x, y)]
    names = ft.lag_names(11)
    df = spark.createDataFrame(rows, ["difference", *names])
    model = md.train_pooled(df, names)
    fitted = model.stages[-1]
    assert np.allclose(fitted.coefficients.toArray(), WEIGHTS) and abs(fitted.intercept - 0.75) < 1e-9

    class Linear:
        def predict(self, matrix):
            return matrix @ np.array(WEIGHTS) + 0.75

    for scorer in (md.PipelineScorer(model), md.linear_scorer(fitted), md.PythonScorer(Linear())):
        scored = scorer.score(df, names, "y")
        assert scored.columns == [*df.columns, "y"]
        error = scored.select(F.max(F.abs(F.col("y") - F.col("difference")))).first()[0]
        assert error < 1e-8


def test_latest_per_key(spark):
    rows = [("a", 1, "x"), ("a", 3, None), ("a", 2, "y"), ("b", 1, "z")]
    df = spark.createDataFrame(rows, "k string, n long, v string")
    got = sorted((tuple(r) for r in latest_per_key(df, ["k"], ["n"]).collect()))
    assert got == [("a", 3, None), ("b", 1, "z")]
    unordered = spark.createDataFrame([("a", None, "x"), ("b", None, "y"), ("b", 0, "z")], df.schema)
    got = sorted((tuple(r) for r in latest_per_key(unordered, ["k"], ["n"]).collect()))
    assert got == [("a", None, "x"), ("b", 0, "z")]
    assert latest_per_key(df.select("k"), ["k"], []).count() == 2


def test_message_reasons(spark):
    def message(date, sales):
        return '{"schema":{},"payload":{"Order Date":%s,"Sales":%s,"Other":1}}' % (date, sales)

    values = {
        message('"2014-01-03"', '"16.448"'): None,
        message('"2014-02-30"', "16.448"): None,
        message('"2014-13-01"', '"1"'): "bad date",
        message("null", '"1"'): "bad date",
        message('"2014-01-03"', '"abc"'): "bad sales",
        message('"2014-01-03"', "null"): "bad sales",
        '{"schema":{}}': "no payload",
        "{oops": "no payload",
        "": "no payload",
    }
    df = spark.createDataFrame([(v,) for v in values], "value string")
    got = {r.value: (r.reason, r.sales) for r in ql.parse_messages(df).collect()}
    assert {v: r for v, (r, _) in got.items()} == values
    assert [s for r, s in got.values() if r is None] == [16.448, 16.448]


def test_route(spark):
    df = spark.createDataFrame([("a_results",), ("results",), ("results_x",)], "topic string")
    assert sorted(r.topic for r in ql.route(df, ".*?results").collect()) == ["a_results", "results"]


@pytest.mark.parametrize("mode", ["compat", "corrected"])
@pytest.mark.parametrize("scaled", [False, True])
def test_windows_one_by_one_give_the_same(spark, mode, scaled):
    frame = months_frame(spark, some_months(26, 6, gaps=(5, 11)))
    scaler = sc.MinMaxScaler.fit(ft.lag_matrix(frame, 11), ["difference", *ft.lag_names(11)])
    scaler = scaler if scaled else None
    series_way = forecast_windows(frame, weighted_scorer(), mode, scaler=scaler)
    data = ft.sliding_windows(frame).select("data")
    from monthwise.operators.forecast import forecast_each

    one_by_one = forecast_each(data, weighted_scorer(), mode, scaler)
    columns = ["month", "recent", "ahead"]
    assert sorted(one_by_one.select(columns).collect()) == sorted(
        series_way.select(columns).collect()
    )
    with pytest.raises(ValueError):
        forecast_each(data, weighted_scorer(), "other")


def test_window_reasons(spark):
    def window(count, sales="1.5"):
        items = ['{"date":"2014-%02d-01","sales":%s}' % (i % 12 + 1, sales) for i in range(count)]
        return '{"data":[%s]}' % ",".join(items)

    values = {window(17): None, window(16): "wrong number of months", window(18): "wrong number of months",
              window(17, "null"): "missing value", "{oops": "no window", "{}": "no window"}
    df = spark.createDataFrame([(v,) for v in values], "value string")
    assert {r.value: r.reason for r in ql.parse_windows(df).collect()} == values


def test_monthly_aggregate_takes_user_defined_aggregates(spark):
    import pandas as pd

    from monthwise.operators.monthly import monthly_aggregate

    @F.pandas_udf("double")
    def middle(v: pd.Series) -> float:
        return float(v.median())

    rows = [(dt.date(2014, 1, d), float(d)) for d in (1, 2, 30)] + [(dt.date(2014, 2, 1), 4.0)]
    df = spark.createDataFrame(rows, "day date, x double")
    got = monthly_aggregate(df, "day", middle=middle(F.col("x"))).orderBy("month").collect()
    assert [tuple(r) for r in got] == [(dt.date(2014, 1, 1), 2.0), (dt.date(2014, 2, 1), 4.0)]


def test_null_and_new_series_are_kept_or_named(spark):
    months = [(s, dt.date(2020 + m // 12, m % 12 + 1, 1), float(m * m + k))
              for k, s in enumerate(["a", "b", None]) for m in range(30)]
    monthly = spark.createDataFrame(months, "s string, month date, sales double")
    matrix = ft.lag_matrix(monthly, 3, ["s"])
    assert {r["s"] for r in matrix.collect()} == {"a", "b", None}
    columns = ["difference", *ft.lag_names(3)]
    scaler = sc.SeriesScaler.fit(matrix.filter("s is null or s = 'a'"), columns, ["s"])
    assert scaler.attach(matrix).count() == matrix.count()
    assert [tuple(r) for r in scaler.refused(matrix).collect()] == [("b", "no range for this series")]
    alone = sc.SeriesScaler.fit(matrix, columns, [])
    scaled = alone.attach(matrix).select(alone.scale(F.col("difference"), "difference").alias("x"))
    assert scaled.agg(F.min("x"), F.max("x")).first() == (-1.0, 1.0)


def test_only_finite_decimal_numbers_are_numbers(spark):
    texts = ["1", " -1.5e3 ", ".5", "5.", "NaN", "Infinity", "1d", "1f", "", "0x1", "1e999", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(finite_number(F.col("t"))).collect()]
    assert got == [1.0, -1500.0, 0.5, 5.0, *[None] * 8]
    large = spark.createDataFrame([("9.2e16",), ("-9.3e16",), ("1e300",)], "t string")
    numbers = lambda *scale: [r[0] for r in large.select(finite_number(F.col("t"), *scale)).collect()]
    assert numbers() == numbers(2) == [9.2e16, None, None]
    assert numbers(0) == [9.2e16, -9.3e16, None] and numbers(None) == [9.2e16, -9.3e16, 1e300]


def test_last_by_a_unique_order_equals_the_last_by_any(spark):
    rng = random.Random(9)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice(["x", None]), k if k % 50 else None, f"v{k}") for k in range(120)]
    df = spark.createDataFrame(rows[:51] + rows[52:100], "a int, b string, o int, v string").repartition(3)
    bag = lambda frame: sorted(str(tuple(r)) for r in frame.collect())
    assert bag(latest_per_key(df, ["a", "b"], ["o"], unique_order=True)) == bag(latest_per_key(df, ["a", "b"], ["o"]))
    with pytest.raises(ValueError):
        latest_per_key(df, ["a"], ["o", "v"], unique_order=True)
