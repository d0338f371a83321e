"""Day and month expressions. All days are UTC days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from monthwise.config import DAY_PATTERN

MS_PER_DAY = 86_400_000
SECONDS_PER_DAY = 86_400


def _day_by(text: Column, pattern: str) -> Column:
    if pattern != DAY_PATTERN:
        return F.try_to_date(text, pattern)
    # The cast is many times faster than a pattern and, on this shape, reads the same days.
    return F.when(text.rlike(r"^(?!0000)\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def parse_day(text: Column, patterns: Sequence[str] = (DAY_PATTERN,)) -> Column:
    """Text to date by the first pattern that fits; null when none does."""
    return F.coalesce(*[_day_by(text, p) for p in patterns])


def parse_message_day(text: Column) -> Column:
    """``yyyy-MM-dd`` text to date, moving days 29-31 past a short month's end to that end.

    Message producers rely on this rule: ``2014-02-30`` counts for 2014-02-28, while month 13
    or day 32 stays invalid (null).
    """
    past_end = F.substring(text, 9, 10).isin("29", "30", "31")
    first = parse_day(F.concat(F.substring(text, 1, 8), F.lit("01")))
    return F.coalesce(parse_day(text), F.when(past_end, F.last_day(first)))


def day_start(day: Column) -> Column:
    """Date to the timestamp of its first instant."""
    return day.cast("timestamp")


def month_of(day: Column) -> Column:
    """First day of the month."""
    return F.trunc(day, "month")


def month_days(day: Column) -> Column:
    """Length of the month in days."""
    return F.dayofmonth(F.last_day(day)).cast("bigint")


def add_months(month: Column, k: int) -> Column:
    """The month ``k`` months later."""
    return F.add_months(month, k)


def day_text(day: Column) -> Column:
    return F.date_format(day, DAY_PATTERN)


def month_key(text: Column) -> Column:
    """``yyyy-MM`` of a day text."""
    return F.substring(text, 1, 7)


def month_text(text: Column) -> Column:
    """Day text moved to the first of its month."""
    return F.concat(F.substring(text, 1, 8), F.lit("01"))


def next_month_text(text: Column) -> Column:
    """Text of the same day number one month on, by field arithmetic on ``yyyy-MM-dd``.

    Unlike :func:`add_months` the day field is kept as written. Null for other text.
    """
    part = [F.get(F.split(text, "-"), F.lit(i)) for i in range(3)]
    year, month = part[0].try_cast("int"), part[1].try_cast("int")
    wraps = month == 12
    following = F.concat_ws(
        "-",
        F.when(wraps, (year + 1).cast("string")).otherwise(part[0]),
        F.when(wraps, F.lit("01")).otherwise(F.lpad((month + 1).cast("string"), 2, "0")),
        part[2],
    )
    return F.when(month.between(1, 12) & year.isNotNull() & part[2].isNotNull(), following)


def month_index(day: Column) -> Column:
    """Months since year 0, an integer that grows by one per calendar month."""
    return (F.year(day) * 12 + F.month(day) - 1).cast("bigint")


def month_from_index(index: Column) -> Column:
    """Inverse of :func:`month_index`."""
    return F.make_date(
        F.floor(index / 12).cast("int"), (F.pmod(index, F.lit(12)) + 1).cast("int"), F.lit(1)
    )


def ordinal_month_time(ts: Column) -> Column:
    """A timestamp on a scale where each calendar month is exactly one day long.

    Structured Streaming has fixed-length windows only. Here month ``n`` starts at synthetic
    day ``n - month_index(1970-01)`` and each second of the month takes one millisecond, so a
    one-day window is a calendar month and a delay of one day is 86,400 ms.
    """
    since_epoch = month_index(ts) - F.lit(1970 * 12)
    second = (
        (F.dayofmonth(ts) - 1) * SECONDS_PER_DAY
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )
    return F.timestamp_millis(since_epoch * MS_PER_DAY + second.cast("bigint"))


def month_from_ordinal(ord_ts: Column) -> Column:
    """Calendar month of a point on the ordinal scale."""
    return month_from_index(
        F.floor(F.unix_millis(ord_ts) / MS_PER_DAY).cast("bigint") + F.lit(1970 * 12)
    )
