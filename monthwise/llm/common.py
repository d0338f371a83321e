"""Expressions and labelled samples that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; ``lower`` alone would also touch other letters."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's text modulo ``divisor``; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(divisor))


def labelled_ids(
    labels: DataFrame, column: str, keep: Column, zeros: int, ones: int
) -> DataFrame:
    """At most ``zeros`` and ``ones`` ids of the two classes as ``_id``, ``_label``, by a hash.

    An id with several labels counts with the largest; ids or labels that are null are left out.
    ``keep`` is a condition on ``_id``.
    """
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col(column).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
        .where(keep)
    )
    order = [F.xxhash64("_id"), F.col("_id")]
    return known.where("_label = 0").orderBy(*order).limit(zeros).unionAll(
        known.where("_label = 1").orderBy(*order).limit(ones)
    )


def labelled_texts(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """``_id``, ``_label``, ``_text`` of a bounded set of ids; a repeated id gives every row it has."""
    rows = documents.select(F.col("doc_id").alias("_id"), whole(F.col("text")).alias("_text"))
    return rows.join(F.broadcast(ids), "_id")


def one_text_each(texts: DataFrame) -> DataFrame:
    """Of the rows of a repeated ``_id`` the one whose text has the least hash."""
    return texts.groupBy("_id", "_label").agg(
        F.min_by("_text", F.xxhash64("_text")).alias("_text")
    )
