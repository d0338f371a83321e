"""Exact token counts from a histogram of encoded lengths."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from monthwise.llm.common import whole
from monthwise.llm.tokens import byte_bpe
from monthwise.session import materialise


def encoded_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``n_tokens`` of every whole text; null and empty texts have none."""

    @pandas_udf("bigint")
    def size(texts: pd.Series) -> pd.Series:
        encoder = byte_bpe(tokenizer)
        return pd.Series([len(encoder.ids(text)) for text in texts], dtype="int64")

    return docs.select(size(whole(F.col("text"))).alias("n_tokens"))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``n_tokens``, ``n_docs`` and, by suffix sums, the answers for a context limit of ``n_tokens``.

    ``n_longer`` documents exceed the limit, ``n_within`` do not, ``tokens_within`` are the tokens of
    the latter, ``truncated_tokens`` the total when each document is cut at the limit, and
    ``quantile`` the share of documents that are not longer. An empty table gives no rows.

    The histogram is written, then summed in ranges of lengths, so no task sees more than its own range.
    """
    counts = lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    counts = materialise(counts, "length-counts")
    width = 64
    counts = counts.withColumn("_range", F.floor(F.col("n_tokens") / width))
    ranges = counts.groupBy("_range").agg(
        F.sum("n_docs").alias("_docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("_tokens")
    )
    # One row for each 64 tokens of the longest document.
    later = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "_range",
        F.coalesce(F.sum("_docs").over(later), F.lit(0)).alias("_docs_later"),
        F.coalesce(F.sum("_tokens").over(later), F.lit(0)).alias("_tokens_later"),
        F.sum("_docs").over(Window.partitionBy()).alias("_all_docs"),
        F.sum("_tokens").over(Window.partitionBy()).alias("_all_tokens"),
    )
    here = Window.partitionBy("_range").orderBy(F.col("n_tokens").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    longer = F.coalesce(F.sum("n_docs").over(here), F.lit(0)) + F.col("_docs_later")
    more = F.coalesce(
        F.sum(F.col("n_docs") * F.col("n_tokens")).over(here), F.lit(0)
    ) + F.col("_tokens_later")
    return counts.join(ranges, "_range").select(
        "n_tokens",
        "n_docs",
        longer.alias("n_longer"),
        (F.col("_all_docs") - longer).alias("n_within"),
        (F.col("_all_tokens") - more).alias("tokens_within"),
        (F.col("_all_tokens") - more + longer * F.col("n_tokens")).alias("truncated_tokens"),
        ((F.col("_all_docs") - longer) / F.col("_all_docs")).alias("quantile"),
    )
