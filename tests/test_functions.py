import datetime as dt
import json

from pyspark.sql import functions as F

from monthwise.functions import calendar as cal
from monthwise.functions import text as tx


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def results(df, expr):
    return [r.out for r in df.select("i", expr.alias("out")).orderBy("i").collect()]


def test_parse_day_is_strict(spark):
    texts = ["2014-01-03", "2014-1-3", "2014-13-01", "2014-02-30", "x", "", None, "2014-01-03 ",
             "2014-01-03T00:00", "0000-01-01"]
    got = results(column(spark, texts), cal.parse_day(F.col("v")))
    assert got == [dt.date(2014, 1, 3)] + [None] * 9


def test_parse_day_takes_the_first_fitting_pattern(spark):
    texts = ["03/11/2014", "2014-11-03", "3 Nov 2014"]
    expr = cal.parse_day(F.col("v"), ["MM/dd/yyyy", "yyyy-MM-dd", "d MMM yyyy"])
    assert results(column(spark, texts), expr) == [
        dt.date(2014, 3, 11), dt.date(2014, 11, 3), dt.date(2014, 11, 3)
    ]


def test_message_days_past_the_month_end_move_to_it(spark):
    texts = ["2014-02-28", "2014-02-29", "2014-02-31", "2016-02-30", "2014-04-31", "2014-02-32",
             "2014-13-30", "2014-02-3x", None]
    got = results(column(spark, texts), cal.parse_message_day(F.col("v")))
    feb = dt.date(2014, 2, 28)
    assert got == [feb, feb, feb, dt.date(2016, 2, 29), dt.date(2014, 4, 30), None, None, None, None]


def test_months(spark):
    days = [dt.date(2016, 2, 10), dt.date(2015, 2, 28), dt.date(2014, 12, 31), dt.date(1969, 12, 1)]
    df = column(spark, days, "date")
    assert results(df, cal.month_days(F.col("v"))) == [29, 28, 31, 31]
    assert results(df, cal.month_of(F.col("v"))) == [d.replace(day=1) for d in days]
    december = cal.add_months(cal.month_of(F.col("v")), 1)
    assert results(df, december)[2] == dt.date(2015, 1, 1)
    back = cal.month_from_index(cal.month_index(F.col("v")))
    assert results(df, back) == [d.replace(day=1) for d in days]


def test_month_texts(spark):
    df = column(spark, ["2014-12-01", "2014-09-01", "2014-01-31"])
    assert results(df, cal.next_month_text(F.col("v"))) == ["2015-01-01", "2014-10-01", "2014-02-31"]
    odd = column(spark, ["", "x", "2014-13-01", "2014-01", None])
    assert results(odd, cal.next_month_text(F.col("v"))) == [None] * 5
    assert results(df, cal.month_key(F.col("v"))) == ["2014-12", "2014-09", "2014-01"]
    assert results(df, cal.month_text(F.col("v")))[2] == "2014-01-01"


def test_ordinal_months_are_one_day_long(spark):
    stamps = [
        dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 31, 23, 59, 59), dt.datetime(1970, 2, 1),
        dt.datetime(1969, 12, 2), dt.datetime(2016, 2, 29, 12), dt.datetime(2021, 3, 28, 2, 30),
    ]
    df = column(spark, stamps, "timestamp")
    ordinal = cal.ordinal_month_time(F.col("v"))
    millis = results(df, F.unix_millis(ordinal))
    day = cal.MS_PER_DAY
    assert millis[:4] == [0, 31 * 86_400 - 1, day, -day + 86_400]
    months = results(df, cal.month_from_ordinal(ordinal))
    assert months == [s.date().replace(day=1) for s in stamps]


def test_number_text_is_python_text(spark):
    values = [0.0, 1.0, -1.5, 2931.07, 12345678.9, -98765432.125, 1e7, 9999999.99, 123456789012.5,
              1e15, 0.1 + 0.2, 0.001, 1e-4, -1.25e-4, 9.99e-4, 1e-5, -2.5e-7, 3e-12, 1e16, -4.5e20,
              1e100, 2.5e-100, float("nan"), float("inf"), float("-inf"), -0.0]
    got = results(column(spark, values, "double"), tx.number_text(F.col("v")))
    assert got == [str(v) for v in values]


def test_forecast_message(spark):
    df = spark.createDataFrame([(dt.date(2014, 1, 1), 12345678.9)], "date date, sales double")
    text = df.select(tx.forecast_message(F.col("date"), F.col("sales"))).first()[0]
    body = json.loads(text)
    assert body["payload"] == {"date": "2014-01-01", "sales": "12345678.9"}
    assert [f["field"] for f in body["schema"]["fields"]] == ["date", "sales"]
    assert not any(f["optional"] for f in body["schema"]["fields"])
    back = df.select(tx.forecast_payload(F.lit(text)).alias("p")).select("p.*").first()
    assert tuple(back) == (dt.date(2014, 1, 1), 12345678.9)


def test_window_text_layout(spark):
    df = spark.sql(
        "select array(struct(date'2019-07-01' as date, 41.5d as sales),"
        " struct(date'2019-08-01' as date, 1207.375d as sales)) as data"
    )
    text = df.select(tx.window_json(F.col("data"))).first()[0]
    assert text == (
        '{"data":[{"date":"2019-07-01","sales":41.5},{"date":"2019-08-01","sales":1207.375}]}'
    )
    broken = df.select(tx.window_data(F.lit("{oops")).alias("d")).first()[0]
    assert broken is None


def test_record_key_ignores_column_order_and_sees_nulls(spark):
    a = spark.createDataFrame([(1, "x", None)], "b int, a string, c string")
    b = a.select("c", "a", "b")
    c = a.withColumn("c", F.lit(""))
    keys = [d.select(tx.record_key(d)).first()[0] for d in (a, b, c)]
    assert keys[0] == keys[1] != keys[2] and len(keys[0]) == 64
