"""Trained and user-supplied models. Their fitted numbers are beyond SQL, except where the
model is a rule."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from monthwise.config import TRAIN_LAGS
from monthwise.operators.forecast import forecast_windows, result_table
from monthwise.operators.models import (
    PythonScorer, SeriesScorer, holdout_error, linear_scorer, train_by_series, train_pooled,
)
from monthwise.operators.scaling import MinMaxScaler
from monthwise.plans.feature_queries import (
    SPLIT_SQL, SUPPLIER, SUPPLIER_SQL, lags_sql, supplier_months,
)
from monthwise.plans.forecast_queries import ahead_sql, result_sql
from monthwise.plans.registry import query
from monthwise.plans.training import TrainedForecaster, evaluate, train, training_rows
from monthwise.session import fresh_dir, materialise


def oldest_change_model():
    """A Python model: the oldest feature of each row."""

    class OldestChange:
        def predict(self, matrix: np.ndarray) -> np.ndarray:
            return matrix[:, -1]

    return OldestChange()


@query(
    "forecast_python_model",
    f"WITH {SUPPLIER_SQL}, {ahead_sql('months', 'l_suppkey', 'compat')} "
    f"{result_sql('months', 'l_suppkey', 'l_suppkey,')}",
)
def forecast_python_model(spark, sf_dir):
    windows = forecast_windows(
        supplier_months(spark, sf_dir), PythonScorer(oldest_change_model()), "compat", SUPPLIER
    )
    return result_table(windows, SUPPLIER)


@query(
    "holdout_error_naive",
    f"""WITH {SUPPLIER_SQL}, {lags_sql('l_suppkey', TRAIN_LAGS)}, {SPLIT_SQL.format(series='l_suppkey')}
    SELECT l_suppkey, count(*) AS rows, round(sqrt(avg((lag_11 - difference) ** 2)), 3) AS rmse,
           round(avg(abs(lag_11 - difference)), 3) AS mae
    FROM split WHERE is_test GROUP BY l_suppkey""",
)
def holdout_error_naive(spark, sf_dir):
    held = training_rows(supplier_months(spark, sf_dir), SUPPLIER).filter("is_test")
    errors = holdout_error(held, f"lag_{TRAIN_LAGS}", "difference", SUPPLIER)
    return errors.select(
        *SUPPLIER, "rows", F.round("rmse", 3).alias("rmse"), F.round("mae", 3).alias("mae")
    )


ONE = [f"lag_{TRAIN_LAGS}"]


@query(
    "model_one_feature",
    f"""WITH {SUPPLIER_SQL}, {lags_sql('l_suppkey', TRAIN_LAGS)}, {SPLIT_SQL.format(series='l_suppkey')},
    fitted AS (SELECT regr_slope(difference, lag_11) AS slope,
                      regr_intercept(difference, lag_11) AS intercept FROM split WHERE NOT is_test)
    SELECT round(any_value(slope), 6) AS slope, round(any_value(intercept), 3) AS intercept,
           count(*) AS rows, round(sqrt(avg((slope * lag_11 + intercept - difference) ** 2)), 3) AS rmse
    FROM split, fitted WHERE is_test""",
)
def model_one_feature(spark, sf_dir):
    """Least squares on one feature, saved, loaded and applied to the held-out rows."""
    rows = materialise(training_rows(supplier_months(spark, sf_dir), SUPPLIER), "one-feature")
    model = train_pooled(rows.filter(~F.col("is_test")), ONE)
    path = fresh_dir(spark, "one-feature-model")
    TrainedForecaster(MinMaxScaler.fit(rows, ONE), model).save(spark, path)
    loaded = TrainedForecaster.load(spark, path)
    held = loaded.scorer.score(rows.filter("is_test").withColumn("actual", F.col("difference")), ONE, "y")
    line = loaded.model.stages[-1]
    return holdout_error(held, "y", "actual").select(
        F.round(F.lit(float(line.coefficients[0])), 6).alias("slope"),
        F.round(F.lit(float(line.intercept)), 3).alias("intercept"),
        "rows", F.round("rmse", 3).alias("rmse"),
    )


@query(
    "model_by_series",
    f"""WITH {SUPPLIER_SQL}, {lags_sql('l_suppkey', TRAIN_LAGS)}, {SPLIT_SQL.format(series='l_suppkey')},
    fitted AS (SELECT l_suppkey, count(*) AS fitted_rows, regr_slope(difference, lag_11) AS slope,
                      regr_intercept(difference, lag_11) AS intercept
               FROM split WHERE NOT is_test GROUP BY l_suppkey)
    SELECT l_suppkey, any_value(fitted_rows) AS fitted_rows, round(any_value(slope), 6) AS slope,
           round(any_value(intercept), 3) AS intercept, count(*) AS rows,
           round(sqrt(avg((slope * lag_11 + intercept - difference) ** 2)), 3) AS rmse
    FROM split JOIN fitted USING (l_suppkey) WHERE is_test GROUP BY l_suppkey""",
)
def model_by_series(spark, sf_dir):
    """A line of its own for every supplier, applied to the months that were held out."""
    rows = materialise(training_rows(supplier_months(spark, sf_dir), SUPPLIER), "series-rows")
    models = materialise(
        train_by_series(rows.filter(~F.col("is_test")), ONE, SUPPLIER), "series-models"
    )
    held = SeriesScorer(models, SUPPLIER).score(rows.filter("is_test"), ONE, "y")
    errors = holdout_error(held, "y", "difference", SUPPLIER)
    return models.withColumnRenamed("rows", "fitted_rows").join(errors, SUPPLIER).select(
        *SUPPLIER, "fitted_rows", F.round(F.get("weights", F.lit(0)), 6).alias("slope"),
        F.round("intercept", 3).alias("intercept"), "rows", F.round("rmse", 3).alias("rmse"),
    )


@query("holdout_error_trained")
def holdout_error_trained(spark, sf_dir):
    trained, rows = train(supplier_months(spark, sf_dir), SUPPLIER)
    return evaluate(trained, rows, SUPPLIER)


@query("forecast_trained")
def forecast_trained(spark, sf_dir):
    """Train on all suppliers, then forecast each of them six months ahead."""
    monthly = materialise(supplier_months(spark, sf_dir), "supplier-months")
    trained, _ = train(monthly, SUPPLIER)
    scorer = linear_scorer(trained.model.stages[-1])
    windows = forecast_windows(monthly, scorer, "corrected", SUPPLIER, trained.scaler)
    return result_table(windows, SUPPLIER)

