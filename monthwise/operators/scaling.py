"""Min-max scaling to (-1, 1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def spread(low: Column, high: Column) -> Column:
    """Width of a range; 1 for a constant column, which then scales to -1."""
    return F.when(high == low, F.lit(1.0)).otherwise(high - low)


def scale(x: Column, low: Column, high: Column) -> Column:
    return F.lit(2.0) * (x - low) / spread(low, high) - F.lit(1.0)


def unscale(y: Column, low: Column, high: Column) -> Column:
    return (y + F.lit(1.0)) / F.lit(2.0) * spread(low, high) + low


def min_max_params(
    rows: DataFrame, columns: Sequence[str], series: Sequence[str] = ()
) -> DataFrame:
    """``series..., column, low, high``: the range of each column."""
    ranges = rows.groupBy(*series).agg(
        *[F.min(c).alias(f"low_{c}") for c in columns],
        *[F.max(c).alias(f"high_{c}") for c in columns],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"low_{c}").alias("low"),
                F.col(f"high_{c}").alias("high"),
            )
            for c in columns
        ]
    )
    return ranges.select(*series, F.inline(entries))


def scale_by_series(
    rows: DataFrame, columns: Sequence[str], series: Sequence[str] = (), train: str | None = None
) -> DataFrame:
    """Scale ``columns`` by their range over the training rows of the same series.

    ``train`` names a boolean column; without it all rows count. The ranges are window
    aggregates over the partitioning that made the lags, so no join and no new shuffle.
    """
    whole = Window.partitionBy(*series)
    scaled = {}
    for c in columns:
        seen = F.when(F.col(train), F.col(c)) if train else F.col(c)
        scaled[c] = scale(F.col(c), F.min(seen).over(whole), F.max(seen).over(whole))
    return rows.withColumns(scaled)


class MinMaxScaler:
    """Fitted ranges of one set of columns, the same for all series.

    The state is two numbers per column. Expressions carry them as literals, so scaling stays
    a plain projection.
    """

    def __init__(self, ranges: dict[str, tuple[float, float]]):
        self.ranges = dict(ranges)

    @classmethod
    def fit(cls, rows: DataFrame, columns: Sequence[str]) -> MinMaxScaler:
        """One aggregate over ``rows``; its single result row comes to the driver."""
        return cls.from_table(min_max_params(rows, columns))

    @classmethod
    def from_table(cls, params: DataFrame) -> MinMaxScaler:
        return cls({r["column"]: (r["low"], r["high"]) for r in params.toLocalIterator()})

    @classmethod
    def load(cls, spark, path: str) -> MinMaxScaler:
        return cls.from_table(spark.read.parquet(path))

    def save(self, spark, path: str) -> None:
        rows = [(c, float(low), float(high)) for c, (low, high) in self.ranges.items()]
        table = spark.createDataFrame(rows, "column string, low double, high double")
        table.coalesce(1).write.mode("overwrite").parquet(path)

    def attach(self, rows: DataFrame) -> DataFrame:
        return rows

    def _range(self, column: str) -> tuple[Column, Column]:
        low, high = self.ranges[column]
        return F.lit(float(low)), F.lit(float(high))

    def scale(self, x: Column, column: str) -> Column:
        return scale(x, *self._range(column))

    def unscale(self, y: Column, column: str) -> Column:
        return unscale(y, *self._range(column))

    def transform(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({c: self.scale(F.col(c), c) for c in self.ranges})

    def inverse(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({c: self.unscale(F.col(c), c) for c in self.ranges})


class SeriesScaler:
    """Fitted ranges per series, kept as a table and joined on the series key.

    A null key is a key like any other. Rows of a series without a range stay: what is scaled by it
    is null, and :meth:`refused` names the series. Without series there is one range, two numbers per
    column, that is carried as literals.
    """

    def __init__(self, params: DataFrame, columns: Sequence[str], series: Sequence[str]):
        self.series = list(series)
        wide = [
            F.max(F.when(F.col("column") == c, F.col(side))).alias(f"{side}_{c}")
            for c in columns
            for side in ("low", "high")
        ]
        self.wide = params.groupBy(*series).agg(*wide)
        self.added = [c for c in self.wide.columns if c not in self.series]

    @classmethod
    def fit(
        cls, rows: DataFrame, columns: Sequence[str], series: Sequence[str]
    ) -> SeriesScaler:
        return cls(min_max_params(rows, columns, series), columns, series)

    def attach(self, rows: DataFrame) -> DataFrame:
        if not self.series:
            only = self.wide.first()
            return rows.withColumns({c: F.lit(only[c]).cast("double") for c in self.added})
        wide = self.wide.toDF(*[f"of_{c}" for c in self.series], *self.added)
        same = F.lit(True)
        for c in self.series:
            same = same & rows[c].eqNullSafe(wide[f"of_{c}"])
        return rows.join(wide, same, "left").drop(*[f"of_{c}" for c in self.series])

    def refused(self, rows: DataFrame) -> DataFrame:
        """``series..., reason``: the series of ``rows`` that have no complete range."""
        missing = F.lit(False)
        for c in self.added:
            missing = missing | F.col(c).isNull()
        found = self.attach(rows.select(*self.series).distinct()).filter(missing)
        return found.select(*self.series, F.lit("no range for this series").alias("reason"))

    def scale(self, x: Column, column: str) -> Column:
        return scale(x, F.col(f"low_{column}"), F.col(f"high_{column}"))

    def unscale(self, y: Column, column: str) -> Column:
        return unscale(y, F.col(f"low_{column}"), F.col(f"high_{column}"))
