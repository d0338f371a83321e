"""Forecasting models: how they are trained over all series and applied to rows.

A scorer has one method, ``score(df, features, output)``, which adds a double column computed
from the feature columns of the same row, in the given order. That is the extension point for
own models. Scoring is a projection and never shuffles by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Shares of the largest spread below which a direction of the features counts as none.
SINGULAR = 1e-10


class Scorer(Protocol):
    def score(self, df: DataFrame, features: Sequence[str], output: str) -> DataFrame: ...


class ColumnScorer:
    """A model given as a column expression of its features."""

    def __init__(self, rule: Callable[[list[Column]], Column]):
        self.rule = rule

    def score(self, df: DataFrame, features: Sequence[str], output: str) -> DataFrame:
        return df.withColumn(output, self.rule([F.col(f) for f in features]))


def oldest_feature() -> ColumnScorer:
    """The change expected next is the oldest change known, a naive yearly pattern."""
    return ColumnScorer(lambda features: features[-1])


class PipelineScorer:
    """A fitted MLlib pipeline over the vector inputs ``f_0, f_1, ...``."""

    def __init__(self, model: PipelineModel):
        self.model = model

    def score(self, df: DataFrame, features: Sequence[str], output: str) -> DataFrame:
        names = input_names(len(features))
        ready = df.withColumns({n: F.col(f) for n, f in zip(names, features)})
        scored = self.model.transform(ready).withColumnRenamed("prediction", output)
        return scored.select(*df.columns, output)


class PythonScorer:
    """A Python model with ``predict(matrix) -> vector``.

    It travels with the function: Spark broadcasts that once it is larger than 1 MB. Calls get
    Arrow batches of thousands of rows.
    """

    def __init__(self, model: Any):
        self.model = model

    def score(self, df: DataFrame, features: Sequence[str], output: str) -> DataFrame:
        model = self.model

        @F.pandas_udf("double")
        def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                matrix = np.column_stack([c.to_numpy(dtype=float) for c in columns])
                yield pd.Series(np.asarray(model.predict(matrix), dtype=float).reshape(-1))

        return df.withColumn(output, predict(*[F.col(f) for f in features]))


def linear_scorer(model: LinearRegressionModel) -> ColumnScorer:
    """A fitted linear model as plain arithmetic, which stays in generated code."""
    weights = [float(w) for w in model.coefficients]
    bias = float(model.intercept)

    def rule(features: list[Column]) -> Column:
        result = F.lit(bias)
        for weight, feature in zip(weights, features, strict=True):
            result = result + F.lit(weight) * feature
        return result

    return ColumnScorer(rule)


class SeriesScorer:
    """A linear model of its own for each series, from :func:`train_by_series`.

    The models are joined by the series, one narrow row each; the optimiser broadcasts them below its limit.
    A series without a model gets null. Null is a series.
    """

    def __init__(self, models: DataFrame, series: Sequence[str]):
        self.models, self.series = models, list(series)

    def score(self, df: DataFrame, features: Sequence[str], output: str) -> DataFrame:
        names = [f"model_{i}" for i in range(len(self.series))]
        models = self.models.select(
            *[F.col(s).alias(n) for s, n in zip(self.series, names)],
            F.col("intercept").alias("model_intercept"), F.col("weights").alias("model_weights"),
        )
        result = F.col("model_intercept")
        for i, feature in enumerate(features):
            result = result + F.get("model_weights", F.lit(i)) * F.col(feature)
        same = [F.col(s).eqNullSafe(F.col(n)) for s, n in zip(self.series, names)]
        return df.join(models, same, "left").select(*df.columns, result.alias(output))


def input_names(count: int) -> list[str]:
    return [f"f_{i}" for i in range(count)]


def label_and_features(
    rows: DataFrame, features: Sequence[str], label: str = "difference"
) -> DataFrame:
    """Rename to ``label`` and ``f_0, f_1, ...``, the names training works on."""
    inputs = [F.col(f).alias(n) for n, f in zip(input_names(len(features)), features)]
    return rows.select(F.col(label).alias("label"), *inputs)


def train_pooled(
    rows: DataFrame, features: Sequence[str], label: str = "difference", estimator: Any = None
) -> PipelineModel:
    """Fit one model on the lag rows of all series.

    The default is ordinary least squares by normal equations: one pass over the rows, with an
    11 x 11 matrix per task to merge. Any MLlib regressor can be passed instead.
    """
    estimator = estimator or LinearRegression(solver="normal", regParam=0.0)
    assembler = VectorAssembler(inputCols=input_names(len(features)), outputCol="features")
    estimator = estimator.copy().setFeaturesCol("features").setLabelCol("label")
    return Pipeline(stages=[assembler, estimator]).fit(label_and_features(rows, features, label))


def train_by_series(
    rows: DataFrame, features: Sequence[str], series: Sequence[str], label: str = "difference"
) -> DataFrame:
    """Least squares for every series: ``series..., rows, intercept, weights, is_singular``.

    One aggregate takes the means and covariances of all columns, which merge in the map tasks without
    loss of digits; a series with a third of all rows sends one row a task. The systems, one row a series, are then
    solved batch by batch.

    Where a series has a constant feature, features that depend on one another, or no more rows than
    features, ``is_singular`` is true and the solution is the one with the least weights in units of the features'
    spreads: a constant feature gets weight 0, and a series of one row its own value as the intercept. Rows
    with a null label or feature don't count; a series without any others has no model.
    """
    inputs = input_names(len(features))
    given = rows.select(*series, F.col(label).cast("double").alias("label"),
                        *[F.col(f).cast("double").alias(n) for f, n in zip(features, inputs)])
    columns = [*inputs, "label"]
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:] if a != "label"]
    sums = given.dropna(subset=columns).groupBy(*series).agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(*[F.avg(c) for c in columns]).alias("means"),
        F.array(*[F.covar_pop(a, b) for a, b in pairs]).alias("spreads"),
    )
    size = len(inputs)

    @F.pandas_udf("intercept double, weights array<double>, is_singular boolean")
    def solve(means: pd.Series, spreads: pd.Series) -> pd.DataFrame:
        mean = np.stack(means.to_numpy()).astype(float)
        flat = np.stack(spreads.to_numpy()).astype(float)
        square, right = np.zeros((len(flat), size, size)), np.zeros((len(flat), size))
        for k, (a, b) in enumerate(pairs):
            i, j = columns.index(a), columns.index(b)
            if b == "label":
                right[:, i] = flat[:, k]
            else:
                square[:, i, j] = square[:, j, i] = flat[:, k]
        spread = np.sqrt(np.maximum(np.einsum("nii->ni", square), 0))
        scale = np.divide(1, spread, out=np.zeros_like(spread), where=spread > 0)
        standard = square * scale[:, :, None] * scale[:, None, :]
        inverse = np.linalg.pinv(standard, rcond=SINGULAR, hermitian=True)
        weights = np.einsum("nij,nj->ni", inverse, right * scale) * scale
        known = np.linalg.eigvalsh(standard)
        return pd.DataFrame({
            "intercept": mean[:, -1] - (weights * mean[:, :-1]).sum(1),
            "weights": list(weights),
            "is_singular": known[:, 0] <= SINGULAR * np.abs(known[:, -1]),
        })

    solved = sums.select(*series, "rows", solve("means", "spreads").alias("model"))
    return solved.select(*series, "rows", "model.*")


def holdout_error(
    rows: DataFrame, prediction: str, label: str, series: Sequence[str] = ()
) -> DataFrame:
    """``series..., rows, rmse, mae`` of a prediction column."""
    error = F.col(prediction) - F.col(label)
    return rows.groupBy(*series).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    )
