"""Text records to typed records, with everything unusable set aside and explained."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.config import DATE_FIELD, DAY_PATTERN, SALES_FIELD, WINDOW_MONTHS
from monthwise.functions.calendar import parse_day, parse_message_day
from monthwise.functions.text import finite_number, window_data, window_series

REASON = "reason"


def _parsed_once(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pass ``columns`` through a generator of one row each.

    Filters on them then stay above the parsing. Without this the optimiser copies the whole
    parsing expression into the pushed-down filter and each record is parsed twice or more.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in columns]))))


def parse_messages(
    messages: DataFrame,
    value: str = "value",
    date_field: str = DATE_FIELD,
    sales_field: str = SALES_FIELD,
    scale: int | None = 2,
    series: Sequence[str] = (),
) -> DataFrame:
    """Take ``day``, ``sales``, ``series...`` and ``reason`` out of ``{"payload": {...}}`` messages.

    ``reason`` is null for usable records and otherwise says what is wrong. Sales must be a finite
    decimal number, small enough for exact sums of ``scale`` decimals.
    """
    date, sales = f"payload.`{date_field}`", f"payload.`{sales_field}`"
    fields = ",".join(f"`{f}`:string" for f in dict.fromkeys([date_field, sales_field, *series]))
    schema = f"payload struct<{fields}>"
    parsed = messages.withColumn("payload", F.from_json(F.col(value), schema)["payload"])
    typed = parsed.withColumns(
        {
            "day": parse_message_day(F.col(date)),
            "sales": finite_number(F.col(sales), scale),
            **{s: F.col(f"payload.`{s}`") for s in series},
        }
    )
    reason = (
        F.when(F.col("payload").isNull(), "no payload")
        .when(F.col("day").isNull(), "bad date")
        .when(F.col("sales").isNull(), "bad sales")
    )
    checked = typed.withColumn(REASON, reason).drop("payload")
    return _parsed_once(checked, ["day", "sales", *series, REASON])


def parse_windows(
    messages: DataFrame, value: str = "value", series: Sequence[str] = ()
) -> DataFrame:
    """Add the ``data`` array and ``series...`` of window messages, and ``reason`` for those a model cannot
    take: broken text, a missing date or number, or another count of months than 17."""
    parsed = messages.withColumn("data", window_data(F.col(value)))
    if series:
        key = window_series(F.col(value), series)
        parsed = parsed.withColumns({s: key[s] for s in series})
    incomplete = F.exists("data", lambda i: i["date"].isNull() | i["sales"].isNull())
    reason = (
        F.when(F.col("data").isNull(), "no window")
        .when(F.size("data") != WINDOW_MONTHS, "wrong number of months")
        .when(incomplete, "missing value")
    )
    return _parsed_once(parsed.withColumn(REASON, reason), ["data", *series, REASON])


def type_records(
    records: DataFrame,
    date: str,
    sales: str,
    patterns: Sequence[str] = (DAY_PATTERN,),
    corrupt: str | None = None,
    sales_required: bool = False,
    scale: int | None = 2,
) -> DataFrame:
    """Add ``day`` and ``amount`` parsed from text columns, and ``reason``.

    ``corrupt`` names the column in which a reader kept lines that do not fit the schema.
    Missing sales are legal in files, where they count as zero in monthly totals, but not in
    messages; ``sales_required`` rejects them. Amounts must be small enough for exact sums of ``scale``
    decimals; without it any finite number will do.
    """
    typed = records.withColumns(
        {
            "day": parse_day(F.col(f"`{date}`"), patterns),
            "amount": finite_number(F.col(f"`{sales}`"), scale),
        }
    )
    malformed: Column = F.col(corrupt).isNotNull() if corrupt else F.lit(False)
    given = F.lit(True) if sales_required else F.col(f"`{sales}`").isNotNull()
    reason = (
        F.when(malformed, "malformed line")
        .when(F.col("day").isNull(), "bad date")
        .when(F.col("amount").isNull() & given, "bad sales")
    )
    return _parsed_once(typed.withColumn(REASON, reason), ["day", "amount", REASON])


def good_records(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON)


def dead_letters(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull())


def route(messages: DataFrame, pattern: str, topic: str = "topic") -> DataFrame:
    """Messages whose whole topic name fits ``pattern``."""
    return messages.filter(F.col(topic).rlike(f"^(?:{pattern})$"))
