"""Records to one row per month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from monthwise.functions.calendar import month_of


UNIT_BITS = 20


def exact_units(value: Column, scale: int) -> Column:
    """Sum of amounts with ``scale`` decimals as a whole number of the smallest unit, a decimal.

    Each amount becomes a whole number of its smallest unit, whose high and low bits are
    summed apart. Both sums are longs, so they stay in the code-generated hash map, and
    neither overflows below 8e12 rows per group; a plain long sum of cents could at 100 TB.

    An amount that is not finite or needs more than 64 bits of units fails the job: the parsers set such
    texts aside by the same bound (:func:`monthwise.functions.text.finite_number`), so only columns that went through none can
    hold one.
    """
    scaled = F.rint(value * F.lit(float(10**scale)))
    units = (
        F.when(value.isNull(), F.lit(None))
        .when(F.abs(scaled) < F.lit(float(2**63)), scaled)
        .otherwise(F.raise_error(F.lit("an amount is not finite or beyond 64 bits of its smallest unit")))
        .cast("bigint")
    )
    high = F.sum(F.shiftright(units, UNIT_BITS)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit(2**UNIT_BITS - 1))).cast("decimal(20,0)")
    return (high * F.lit(2**UNIT_BITS).cast("decimal(8,0)") + low).cast("decimal(38,0)")


def exact_sum(value: Column, scale: int) -> Column:
    """Sum of amounts with ``scale`` decimals, independent of row order; see :func:`exact_units`."""
    return exact_units(value, scale).cast("double") / F.lit(float(10**scale))


def total(value: Column, scale: int | None = None, skip_nan: bool = False) -> Column:
    """Sum that counts null as zero (an all-null group gives 0.0)."""
    if skip_nan:
        value = F.when(~F.isnan(value), value)
    summed = F.sum(value) if scale is None else exact_sum(value, scale)
    return F.coalesce(summed, F.lit(0.0))


def monthly_aggregate(
    records: DataFrame, day: str, series: Sequence[str] = (), /, **aggregates: Column
) -> DataFrame:
    """``series..., month`` and one column per aggregate, built-in or user-defined.

    Built-in aggregates combine before the shuffle. A grouped Python aggregate gets a group's values
    in one piece, so it only suits input that was reduced first, to days for example; one that can be
    merged goes through :func:`monthwise.operators.aggregates.merge_aggregate`.
    """
    month = month_of(F.col(day)).alias("month")
    return records.groupBy(*series, month).agg(
        *[column.alias(name) for name, column in aggregates.items()]
    )


def monthly_totals(
    records: DataFrame,
    day: str,
    sales: str,
    series: Sequence[str] = (),
    scale: int | None = None,
    skip_nan: bool = False,
) -> DataFrame:
    """``series..., month, sales``: total sales per calendar month.

    One shuffle. Partial sums run before it, so a hot series or month sends at most one row
    per task. ``scale`` asks for exact sums of amounts with that many decimals; by default
    doubles are summed as they come. ``skip_nan`` treats NaN as missing.
    """
    return monthly_aggregate(
        records, day, series, sales=total(F.col(sales), scale, skip_nan)
    )


def day_counts(records: DataFrame, day: str, series: Sequence[str] = ()) -> DataFrame:
    """``series..., day, records``: how often each day occurs."""
    return records.groupBy(*series, F.col(day).cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("records")
    )


LAST_DAY_NUMBER = 2932896  # 9999-12-31 as days since 1970
DAY_BITS = 22


def month_mode_day(records: DataFrame, day: str, series: Sequence[str] = ()) -> DataFrame:
    """``series..., month, mode_day, records``: the most frequent day of each month.

    Ties go to the earliest day. Days are counted first, so the second step sees at most 31
    rows per month and no task ever holds a month's records. Count and reversed day are packed
    into one long, which a hash aggregate can take the maximum of; that leaves 41 bits for the
    count of a day, 2e12 records. A count beyond that fails the job.
    """
    counted = day_counts(records, day, series).withColumn(
        "records",
        F.when(F.col("records") < 2 ** (63 - DAY_BITS), F.col("records")).otherwise(
            F.raise_error(F.lit("a day has more records than 41 bits can count"))
        ),
    )
    from_end = F.lit(LAST_DAY_NUMBER).cast("bigint") - F.unix_date("day")
    packed = F.shiftleft("records", DAY_BITS) + from_end
    best = counted.groupBy(*series, month_of(F.col("day")).alias("month")).agg(
        F.max(packed).alias("best")
    )
    day_number = F.lit(LAST_DAY_NUMBER) - F.col("best").bitwiseAND(F.lit(2**DAY_BITS - 1))
    return best.select(
        *series,
        "month",
        F.date_from_unix_date(day_number.cast("int")).alias("mode_day"),
        F.shiftright("best", DAY_BITS).alias("records"),
    )


def fill_gaps(monthly: DataFrame, series: Sequence[str] = (), value: float = 0.0) -> DataFrame:
    """Add months without records between a series' first and last month, with ``value``.

    Each row generates the months up to its successor, which needs no calendar join.
    """
    order = Window.partitionBy(*series).orderBy("month")
    upto = F.coalesce(F.add_months(F.lead("month").over(order), -1), F.col("month"))
    slots = monthly.withColumn("upto", upto)
    return slots.select(
        *series,
        F.explode(F.expr("sequence(month, upto, interval 1 month)")).alias("slot"),
        "month",
        "sales",
    ).select(
        *series,
        F.col("slot").alias("month"),
        F.when(F.col("slot") == F.col("month"), F.col("sales"))
        .otherwise(F.lit(value))
        .alias("sales"),
    )
