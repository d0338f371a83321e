"""Text, JSON and key expressions."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The forecast envelope's schema part, as its consumers expect it.
ENVELOPE_SCHEMA = (
    '{"type":"struct","fields":['
    '{"type":"string","optional":false,"field":"date"},'
    '{"type":"string","optional":false,"field":"sales"}],'
    '"optional":false,"name":"com.github.jcustenborder.kafka.connect.model.Value"}'
)
ENVELOPE_TYPE = (
    "struct<type:string,fields:array<struct<type:string,optional:boolean,field:string>>,"
    "optional:boolean,name:string>"
)


def number_text(value: Column) -> Column:
    """Double to text the way Python's ``str`` writes it.

    Spark uses exponents below 1e-3 and from 1e7 on, Python below 1e-4 and from 1e16 on, and
    writes them as ``1e-05``.
    """
    plain = value.cast("string")
    size = F.abs(value)
    in_full = F.regexp_replace(value.cast("decimal(38,10)").cast("string"), r"(\.\d+?)0*$", "$1")
    mantissa = F.regexp_replace(F.substring_index(plain, "E", 1), r"\.0$", "")
    exponent = F.get(F.split(plain, "E"), F.lit(1)).try_cast("int")
    digits = F.regexp_replace(mantissa, r"[-.]", "")
    sign = F.when(value < 0, "-").otherwise("")
    marker = (
        F.when(exponent <= -10, "e-").when(exponent < 0, "e-0").otherwise("e+")
    )
    return (
        F.when(F.isnan(value), "nan")
        .when(size == float("inf"), F.concat(sign, F.lit("inf")))
        .when((size >= 1e7) & (size < 1e16), in_full)
        .when((size >= 1e-4) & (size < 1e-3), F.concat(sign, F.lit("0.000"), digits))
        .when(exponent.isNotNull(), F.concat(mantissa, marker, F.abs(exponent).cast("string")))
        .otherwise(plain)
    )


def finite_number(text: Column, scale: int | None = 2) -> Column:
    """A decimal number, with or without exponent; null for anything else and beyond doubles.

    With ``scale`` it is also null if its whole units of that many decimals don't fit into 64 bits. That is
    the bound of exact sums of that scale, so what is taken here is never refused there.
    """
    plain = text.cast("string").rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
    value = text.try_cast("double")
    size = F.abs(value) if scale is None else F.abs(F.rint(value * F.lit(float(10**scale))))
    return F.when(plain & (size < F.lit(float("inf") if scale is None else float(2**63))), value)


def _texts(series: Sequence[str]) -> str:
    """The type of a struct of these fields as text."""
    return "struct<" + ",".join(f"`{s}`:string" for s in series) + ">"


def window_json(data: Column, series: Sequence[str] = ()) -> Column:
    """A feature window as ``{"data":[{"date":"2019-07-01","sales":41.5}, ...]}``.

    Of keyed series the key comes first, as text: ``{"series":{"region":"north"},"data":[...]}``; a null is left out.
    """
    parts = [data.alias("data")]
    if series:
        parts.insert(0, F.struct(*[F.col(s).cast("string").alias(s) for s in series]).alias("series"))
    return F.to_json(F.struct(*parts))


def window_data(text: Column) -> Column:
    """Inverse of :func:`window_json`; null for text that is not a window."""
    return F.from_json(text, "data array<struct<date:date,sales:double>>")["data"]


def window_series(text: Column, series: Sequence[str]) -> Column:
    """The key of a window message, a struct of texts."""
    return F.from_json(text, f"series {_texts(series)}")["series"]


def envelope_schema(series: Sequence[str] = ()) -> str:
    """The schema part of a result message; the fields of a key follow date and sales and may be null."""
    if not series:
        return ENVELOPE_SCHEMA
    schema = json.loads(ENVELOPE_SCHEMA)
    schema["fields"] += [{"type": "string", "optional": True, "field": s} for s in series]
    return json.dumps(schema, separators=(",", ":"))


def forecast_message(date: Column, sales: Column, series: Sequence[str] = ()) -> Column:
    """The schema-carrying JSON message of one result row; all values travel as text."""
    schema = F.from_json(F.lit(envelope_schema(series)), ENVELOPE_TYPE)
    payload = F.struct(
        F.date_format(date, "yyyy-MM-dd").alias("date"), number_text(sales).alias("sales"),
        *[F.col(s).cast("string").alias(s) for s in series],
    )
    return F.to_json(F.struct(schema.alias("schema"), payload.alias("payload")))


def forecast_payload(text: Column, series: Sequence[str] = ()) -> Column:
    """Struct ``date, sales, series...`` read back from a forecast message."""
    payload = F.from_json(text, f"payload {_texts(['date', 'sales', *series])}")["payload"]
    return F.struct(
        F.try_to_date(payload["date"], "yyyy-MM-dd").alias("date"),
        payload["sales"].try_cast("double").alias("sales"),
        *[payload[s].alias(s) for s in series],
    )


def record_key(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """SHA-256 of the record as JSON with its columns in name order, so that a record sent
    twice gets the same key. Nulls are written out to keep ``null`` and absent apart."""
    names = sorted(columns or df.columns)
    body = F.to_json(F.struct(*[F.col(f"`{n}`") for n in names]), {"ignoreNullFields": "false"})
    return F.sha2(body, 256)
