"""Mergeable user aggregates and per-series least squares against plain Python."""

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthwise.operators.aggregates import merge_aggregate
from monthwise.operators.models import SeriesScorer, train_by_series
from monthwise.operators.monthly import exact_sum, total


def seen_rows():
    class Seen:
        """Rows, least and greatest number, and how many buffers were merged."""

        def create(self):
            return 0, [], 1

        def add(self, buffer, rows):
            assert len(rows)
            return buffer[0] + len(rows), buffer[1] + rows["x"].dropna().to_list(), buffer[2]

        def merge(self, left, right):
            return left[0] + right[0], left[1] + right[1], left[2] + right[2]

        def result(self, buffer):
            n, values, parts = buffer
            return n, min(values, default=None), max(values, default=None), parts

    return Seen()


SEEN = "n bigint, low double, high double, parts int"


@pytest.mark.parametrize("open_groups", [1, 100_000])
def test_groups_of_any_keys(spark, open_groups):
    rng = random.Random(open_groups)
    big = 2**60
    rows = [
        (rng.choice([None, big, big + 1, 7]), rng.choice(["a", "", None]), rng.choice([0.0, float("nan"), None]),
         rng.choice([None, dt.date(2020, 1, 31)]), None if rng.random() < 0.2 else rng.uniform(-9, 9))
        for _ in range(900)
    ]
    df = spark.createDataFrame(rows, "k bigint, s string, f double, d date, x double").repartition(5)
    got = merge_aggregate(df, ["k", "s", "f", "d"], ["x"], seen_rows(), SEEN, open_groups)
    assert got.dtypes == [("k", "bigint"), ("s", "string"), ("f", "double"), ("d", "date"), ("n", "bigint"),
                          ("low", "double"), ("high", "double"), ("parts", "int")]
    want = df.groupBy("k", "s", "f", "d").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    plain = lambda frame: sorted(
        str(tuple(r)) for r in frame.select("k", "s", "f", "d", "n", "low", "high").collect())
    assert plain(got) == plain(want)


def test_a_hot_key_arrives_as_one_buffer_a_task(spark):
    df = spark.range(0, 30_000, 1, 6).selectExpr("if(id % 3 = 0, 1L, id) as k", "double(id) as x")
    got = merge_aggregate(df, ["k"], ["x"], seen_rows(), SEEN)
    hot = got.where("k = 1").collect()
    assert [(r.n, r.low, r.high, r.parts) for r in hot] == [(10_001, 0.0, 29_997.0, 6)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "MapInArrow" in plan[:exchange] and "MapInArrow" in plan[exchange:]


def test_aggregates_of_nothing_and_of_everything(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "k int, x double")
    assert merge_aggregate(df.limit(0), ["k"], ["x"], seen_rows(), SEEN).count() == 0
    whole = merge_aggregate(df, [], ["x"], seen_rows(), SEEN).collect()
    assert [(r.n, r.low, r.high) for r in whole] == [(2, 2.0, 2.0)]


def brute_lines(rows, width):
    groups = defaultdict(list)
    for s, *values in rows:
        if None not in values:
            groups[s].append(values)
    out = {}
    for s, found in groups.items():
        x = np.array([v[:width] for v in found])
        y = np.array([v[width] for v in found])
        spread = x.std(0)
        scale = np.divide(1, spread, out=np.zeros_like(spread), where=spread > 1e-12)
        centred = (x - x.mean(0)) * scale
        weights = np.linalg.lstsq(centred, y - y.mean(), rcond=1e-6)[0] * scale
        out[s] = len(found), y.mean() - weights @ x.mean(0), weights
    return out


def test_every_series_gets_its_least_squares(spark):
    rng = np.random.default_rng(3)
    rows = []
    for s, n in [("a", 300), ("b", 12), (None, 40), ("few", 2), ("one", 1)]:
        x = rng.normal(size=(n, 3)) * [1e6, 1, 1e-3] + [1e9, 0, 5]
        y = x @ rng.normal(size=3) + rng.normal(size=n)
        rows += [(s, *map(float, r), float(v)) for r, v in zip(x, y)]
    rows += [("const", 4.0, float(k), float(2 * k), 7.0 * k + 1) for k in range(9)]
    rows += [("a", None, 1.0, 1.0, 1.0), ("empty", None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "s string, p double, q double, r double, y double").repartition(4)
    models = train_by_series(df, ["p", "q", "r"], ["s"], "y")
    got = {r["s"]: r for r in models.collect()}
    want = brute_lines(rows, 3)
    assert set(got) == set(want)
    assert {s for s, r in got.items() if r["is_singular"]} == {"few", "one", "const"}
    for s, (n, intercept, weights) in want.items():
        assert got[s]["rows"] == n
        # Compared on predictions: the inputs lie far from zero, where intercepts lose digits.
        for row in [r for r in rows if r[0] == s and None not in r[1:]][:5]:
            x = np.array(row[1:4])
            a, b = got[s]["intercept"] + np.dot(got[s]["weights"], x), intercept + weights @ x
            assert a == pytest.approx(b, rel=1e-5, abs=1e-2)
    assert got["const"]["weights"][0] == 0 and got["one"]["weights"] == [0, 0, 0]

    scored = SeriesScorer(models, ["s"]).score(df, ["p", "q", "r"], "guess")
    assert scored.columns == [*df.columns, "guess"] and scored.count() == len(rows)
    by = {(r["s"], r["q"]): r["guess"] for r in scored.collect()}
    assert by[("empty", 1.0)] is None and by[("const", 3.0)] == pytest.approx(22.0)
    assert by[(None, rows[312][2])] is not None


def test_sums_by_series_merge_before_the_exchange(spark):
    df = spark.range(10).selectExpr("id % 2 as s", "double(id) as x", "double(id) as y")
    plan = train_by_series(df, ["x"], ["s"], "y")._jdf.queryExecution().executedPlan().toString()
    assert "partial_covar_pop" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan


def test_sums_refuse_what_they_cannot_hold(spark):
    df = spark.createDataFrame([(9.2e16,), (-9.2e16,), (0.25,), (None,)], "x double")
    assert df.agg(exact_sum(F.col("x"), 2)).first()[0] == 0.25
    for odd in (9.3e16, float("nan"), float("-inf")):
        with pytest.raises(Exception, match="beyond 64 bits"):
            df.unionAll(spark.createDataFrame([(odd,)], "x double")).agg(exact_sum(F.col("x"), 2)).first()
    nan = spark.createDataFrame([(float("nan"),), (1.5,)], "x double")
    assert nan.agg(total(F.col("x"), 2, skip_nan=True)).first()[0] == 1.5
