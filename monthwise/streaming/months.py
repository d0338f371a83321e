"""Calendar months on event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.config import WATERMARK_DAYS
from monthwise.functions.calendar import (
    SECONDS_PER_DAY, day_start, month_from_ordinal, ordinal_month_time,
)
from monthwise.functions.text import record_key
from monthwise.operators.monthly import total

ORDINAL = "ordinal_time"
MAX_DELAY_DAYS = 27


def with_event_time(records: DataFrame, day: str = "day", delay_days: int = WATERMARK_DAYS):
    """Add the ordinal event time and its watermark."""
    if not 0 <= delay_days <= MAX_DELAY_DAYS:
        raise ValueError(f"delay_days must be 0 to {MAX_DELAY_DAYS}")
    at = ordinal_month_time(day_start(F.col(day).cast("date")))
    return records.withColumn(ORDINAL, at).withWatermark(
        ORDINAL, f"{delay_days * SECONDS_PER_DAY} milliseconds"
    )


def closed_month_stream(
    records: DataFrame,
    day: str = "day",
    sales: str = "sales",
    series: Sequence[str] = (),
    delay_days: int = WATERMARK_DAYS,
    scale: int | None = None,
    unique_by: Sequence[str] | None = None,
) -> DataFrame:
    """``series..., month, sales``, each month once, when a record from one day after its end
    or later has been seen. To be written in append mode.

    State is one sum per open month and series. ``unique_by`` drops redelivered records by the
    hash of these columns. Hashes stay in state until their month closes: as long as a repeated
    record could still be counted, and no longer.
    """
    timed = with_event_time(records, day, delay_days)
    timed = timed.withColumn("span", F.window(ORDINAL, "1 day"))
    if unique_by is not None:
        timed = timed.withColumn("record_key", record_key(timed, unique_by))
        timed = timed.dropDuplicates(["record_key", "span"])
    closed = timed.groupBy("span", *series).agg(total(F.col(sales), scale).alias("sales"))
    return closed.select(*series, month_from_ordinal(F.col("span.start")).alias("month"), "sales")
