"""File exports of small, finished tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.text import number_text


def export_csv(
    results: DataFrame, path: str, key: str | Sequence[str] = "date", single: bool = False
) -> None:
    """Write ``results`` as CSV with a header, sorted by ``key``, one column or several.

    The sort is spread by range and the files' order is the rows' order. ``single`` makes one
    file in one task, which is right for one series only (twelve rows a year). Doubles are written out in
    full, not in Spark's exponent form.
    """
    doubles = {name: number_text(F.col(name)) for name, kind in results.dtypes if kind == "double"}
    keys = [key] if isinstance(key, str) else list(key)
    ordered = results.coalesce(1).sortWithinPartitions(*keys) if single else results.orderBy(*keys)
    ordered.withColumns(doubles).write.mode("overwrite").option("header", "true").csv(path)
