"""Which records a record-by-record watermark keeps, as a batch query.

A record dated ``t`` moves the watermark to ``t`` minus the delay. A month is emitted by the
first record that lifts the watermark to the month's end, and records of that month that
arrive later are dropped. The watermark is one for all series.

No record-level ordering is needed to find out: the record that closes a month is the earliest
arrival among all records dated at or after the month's end plus the delay. So days are reduced
to their earliest arrival first, and everything after that works on calendar-many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from monthwise.config import WATERMARK_DAYS
from monthwise.functions.calendar import month_of
from monthwise.operators.monthly import total


def closing_arrivals(
    records: DataFrame, day: str, seq: str, delay_days: int = WATERMARK_DAYS
) -> DataFrame:
    """``month, closed_by``: the arrival number that closes each month, null while open.

    ``seq`` is a number that grows in arrival order (offset, ingest id). After the day
    aggregate at most one row per calendar day is left, which is what the unpartitioned
    window sees.
    """
    days = records.groupBy(F.col(day).cast("date").alias("at")).agg(
        F.min(F.col(seq).cast("bigint")).alias("first_seq")
    )
    month = month_of(F.col("at"))
    deadline = F.date_add(F.add_months(month, 1), delay_days)
    marks = F.array(
        F.struct("at", "first_seq", F.lit(None).cast("date").alias("month")),
        F.struct(
            deadline.alias("at"), F.lit(None).cast("bigint").alias("first_seq"),
            month.alias("month"),
        ),
    )
    onward = Window.orderBy(F.col("at").desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        days.select(F.inline(marks))
        .withColumn("closed_by", F.min("first_seq").over(onward))
        .filter(F.col("month").isNotNull())
        .select("month", "closed_by")
        .distinct()
    )


def with_lateness(
    records: DataFrame, day: str, seq: str, delay_days: int = WATERMARK_DAYS
) -> DataFrame:
    """Add ``month``, ``is_closed`` and ``is_late`` to each record.

    The joined side has one row per month of the ``DATE`` range that occurs, below 120,000
    rows and 4 MB even for years 1 to 9999, so it is broadcast.
    """
    closing = closing_arrivals(records, day, seq, delay_days)
    joined = records.withColumn("month", month_of(F.col(day))).join(
        F.broadcast(closing), "month", "left"
    )
    return (
        joined.withColumn("is_closed", F.col("closed_by").isNotNull())
        .withColumn("is_late", F.coalesce(F.col(seq) > F.col("closed_by"), F.lit(False)))
        .drop("closed_by")
    )


def closed_months(
    records: DataFrame,
    day: str,
    sales: str,
    seq: str,
    series: Sequence[str] = (),
    delay_days: int = WATERMARK_DAYS,
    scale: int | None = None,
) -> DataFrame:
    """``series..., month, sales`` of closed months, without late records."""
    marked = with_lateness(records, day, seq, delay_days)
    return (
        marked.filter(F.col("is_closed") & ~F.col("is_late"))
        .groupBy(*series, "month")
        .agg(total(F.col(sales), scale).alias("sales"))
    )


def late_records(
    records: DataFrame, day: str, seq: str, delay_days: int = WATERMARK_DAYS
) -> DataFrame:
    """The records the stream would drop."""
    return with_lateness(records, day, seq, delay_days).filter("is_late").drop(
        "is_late", "is_closed"
    )


def open_months(
    records: DataFrame, day: str, seq: str, delay_days: int = WATERMARK_DAYS
) -> DataFrame:
    """Months still waiting for a later record."""
    closing = closing_arrivals(records, day, seq, delay_days)
    return closing.filter(F.col("closed_by").isNull()).select("month")


def settled_months(
    records: DataFrame, day: str, delay_days: int = WATERMARK_DAYS
) -> DataFrame:
    """Months whose end plus the delay is not after the greatest day: closed when all records
    arrive in one batch."""
    months = records.groupBy(month_of(F.col(day)).alias("month")).agg(
        F.max(F.col(day).cast("date")).alias("last_day")
    )
    everything = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    deadline = F.date_add(F.add_months("month", 1), delay_days)
    return (
        months.withColumn("greatest", F.max("last_day").over(everything))
        .filter(deadline <= F.col("greatest"))
        .select("month")
    )
