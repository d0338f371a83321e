"""Last write wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], unique_order: bool = False
) -> DataFrame:
    """The row with the greatest ``order`` for each key, all columns kept.

    An aggregate, not a ranking: each task first reduces a key to one row, so a key with a
    third of all rows reaches its reducer as one row per task. As whole rows are kept, Spark sorts
    by key in the task before and after the exchange; columns of their own would not need that, but
    could mix rows that tie. ``order`` must tell the rows of a key apart for the result to be unique.
    A row whose order is null ranks lowest but counts.

    ``unique_order`` states that it does, as an event id or offset does. Then one numeric order column is
    aggregated alone, by hash and without reading the other columns, and rows are joined back to the greatest
    value of their key. Nothing is sorted for the aggregate, and while there are few keys the rows are
    not exchanged either. Rows that tie nevertheless would all come out. On 600,000 rows of 500 bytes and 8 cores
    this took 0.5 s instead of 1.0 s for 1,000 keys, and 1.4 s instead of 1.8 s for as many keys as rows.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    if unique_order:
        if len(order) != 1:
            raise ValueError("unique_order needs one order column")
        return _joined_back(df, keys, order[0])
    # As a struct the rank is never null, so a row whose order is null ranks lowest but counts.
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, "best.*").select(*df.columns)


def _joined_back(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    names = [f"latest_{i}" for i in range(len(keys))]
    greatest = df.groupBy(*keys).agg(F.max(order).alias("latest")).toDF(*names, "latest")
    same = F.col(order).eqNullSafe(F.col("latest"))
    for key, name in zip(keys, names):
        same = same & F.col(key).eqNullSafe(F.col(name))
    return df.join(greatest, same, "left_semi")
