"""The training job: monthly totals to a fitted scaler and model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.config import TRAIN_LAGS, PipelineConfig
from monthwise.operators.features import holdout_split, lag_matrix, lag_names
from monthwise.operators.models import PipelineScorer, holdout_error, train_pooled
from monthwise.operators.monthly import monthly_totals
from monthwise.operators.quality import good_records, type_records
from monthwise.operators.scaling import MinMaxScaler
from monthwise.session import materialise
from monthwise.sources.dropdir import MALFORMED, read_csv

LABEL = "difference"
FEATURES = lag_names(TRAIN_LAGS)


@dataclass
class TrainedForecaster:
    """A model of the scaled next change, with the scaler it was trained under."""

    scaler: MinMaxScaler
    model: PipelineModel

    @property
    def scorer(self) -> PipelineScorer:
        return PipelineScorer(self.model)

    def save(self, spark: SparkSession, path: str) -> None:
        self.scaler.save(spark, f"{path}/scaler")
        self.model.write().overwrite().save(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TrainedForecaster:
        scaler = MinMaxScaler.load(spark, f"{path}/scaler")
        return cls(scaler, PipelineModel.load(f"{path}/model"))


def training_rows(monthly: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """The lag matrix with ``is_test``, true for the last six rows of each series."""
    return holdout_split(lag_matrix(monthly, TRAIN_LAGS, series), series)


def train(
    monthly: DataFrame, series: Sequence[str] = (), estimator: Any = None
) -> tuple[TrainedForecaster, DataFrame]:
    """Fit scaler and model on the training rows of all series.

    Returns them with the split rows. The rows are written once, since the scaler, the model
    and an evaluation each pass over them.
    """
    rows = materialise(training_rows(monthly, series), "training-rows")
    known = rows.filter(~F.col("is_test"))
    scaler = MinMaxScaler.fit(known, [LABEL, *FEATURES])
    model = train_pooled(scaler.transform(known), FEATURES, LABEL, estimator)
    return TrainedForecaster(scaler, model), rows


def evaluate(
    trained: TrainedForecaster, rows: DataFrame, series: Sequence[str] = ()
) -> DataFrame:
    """``series..., rows, rmse, mae`` of the held-out rows, in units of sales.

    An addition: the holdout is otherwise only set aside.
    """
    held = rows.filter("is_test").withColumn("actual", F.col(LABEL))
    scored = trained.scorer.score(trained.scaler.transform(held), FEATURES, "y")
    back = scored.withColumn("predicted", trained.scaler.unscale(F.col("y"), LABEL))
    return holdout_error(back, "predicted", "actual", series)


def train_from_csv(
    spark: SparkSession, config: PipelineConfig, patterns: Sequence[str], glob: str = "*.csv"
) -> tuple[TrainedForecaster, DataFrame]:
    """The whole offline job on a Latin-1 CSV: read, keep two columns, sum, train."""
    raw = read_csv(spark, config.data_path, encoding="ISO-8859-1", glob=glob)
    names = {config.date_col: "date", config.sales_col: "sales"}
    kept = raw.withColumnsRenamed(names).select(*config.series, "date", "sales", MALFORMED)
    good = good_records(type_records(kept, "date", "sales", patterns, MALFORMED))
    monthly = monthly_totals(good, "day", "amount", config.series, skip_nan=True)
    return train(monthly, config.series)
