"""Importance resampling towards a target distribution over hashed word runs.

Features are runs of one to ``runs`` consecutive words; a feature's bucket is the CRC-32 of its bytes.
Words and pairs that make up a known least share of the corpus form the head: tasks get the CRC state
of each head word and the bucket of each head pair. All other features are hashed directly, which gives
the same buckets, so the head only saves work and every total is exact.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from monthwise.llm.common import whole
from monthwise.session import materialise

BUCKETS = 10_000
#: A head word has at least one in so many of all words, so there can't be more of them; pairs likewise.
HEAD = 20_000
#: Distinct features that a task counts before it hands them on.
FLUSH = 100_000

# ASCII bytes that are no digit or letter become blanks, A-Z become a-z; bytes of other characters stay.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20
    for b in range(256)
)


def words(text: str) -> list[bytes]:
    """The words of a text in UTF-8: runs of digits, lower-cased letters and non-ASCII characters."""
    return text.encode().translate(_WORD_BYTES).split()


@dataclass
class Head:
    """CRC states after each frequent word, and buckets of frequent pairs."""

    buckets: int = BUCKETS
    states: dict[bytes, int] = field(default_factory=dict)
    pairs: dict[tuple[bytes, bytes], int] = field(default_factory=dict)

    def coded(self, found: list[bytes], runs: int) -> np.ndarray:
        """The buckets of all runs of 1 to ``runs`` of the words."""
        known = self.states.get
        states = [known(w) for w in found]
        for k, state in enumerate(states):
            if state is None:
                states[k] = zlib.crc32(found[k])
        parts = [np.array(states, np.uint32) % self.buckets]
        for length in range(2, runs + 1):
            last = found[length - 1 :]
            if length == 2:
                pair = [self.pairs.get(p) for p in zip(found, last)]
                parts.append(np.array(
                    [b if b is not None else zlib.crc32(b" " + w, s) % self.buckets
                     for b, w, s in zip(pair, last, states)], np.uint32,
                ))
            if length < runs or length > 2:
                states = [zlib.crc32(b" " + w, s) for w, s in zip(last, states)]
            if length > 2:
                parts.append(np.array(states, np.uint32) % self.buckets)
        return np.concatenate(parts).astype(np.uint32)


def _counted(texts: DataFrame, features, schema: str) -> DataFrame:
    """How often each feature occurs; ``features(words)`` yields the schema's one column, or tuples of them."""
    names = [part.split()[0] for part in schema.split(",")]

    def rows(seen: Counter) -> pd.DataFrame:
        columns = [list(seen)] if len(names) == 1 else list(zip(*seen))
        return pd.DataFrame({**dict(zip(names, columns)), "_n": list(seen.values())})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["_text"]:
                seen.update(features(words(text)))
                if len(seen) > FLUSH:
                    yield rows(seen)
                    seen = Counter()
        if seen:
            yield rows(seen)

    found = texts.select("_text").mapInPandas(count, f"{schema}, _n bigint")
    return found.groupBy(*names).agg(F.sum("_n").alias("_n"))


def head_of(texts: DataFrame, runs: int, buckets: int = BUCKETS, head: int = HEAD) -> Head:
    """The words that are at least one in ``head`` of all words of ``_text``, and, for runs of two or
    more, the pairs of them that are as frequent. Counted over all texts; at most ``head`` of each."""
    counts = materialise(_counted(texts, lambda found: found, "_word binary"), "resample-words")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    often = counts.where(F.col("_n") * head >= total).collect()
    found = Head(buckets, {bytes(r["_word"]): zlib.crc32(r["_word"]) for r in often})
    if runs > 1 and total:
        known = set(found.states)
        pairs = _counted(
            texts, lambda found: (p for p in zip(found, found[1:]) if p[0] in known and p[1] in known),
            "_first binary, _second binary",
        )
        for row in pairs.where(F.col("_n") * head >= total).collect():
            pair = bytes(row["_first"]), bytes(row["_second"])
            found.pairs[pair] = zlib.crc32(b" " + pair[1], found.states[pair[0]]) % buckets
    return found


def coded(texts: DataFrame, head: Head, runs: int) -> DataFrame:
    """``_text`` replaced by ``_n_words``, ``_n_features`` and ``_buckets``, four bytes for each feature."""

    @F.pandas_udf("n_words bigint, n_features bigint, buckets binary")
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:  # the words of one text at a time
                found = words(text)
                features = head.coded(found, runs)
                rows.append((len(found), len(features), features.astype("<u4").tobytes()))
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "buckets"])

    parts = ("n_words", "n_features", "buckets")
    return texts.withColumn("_code", code("_text")).select(
        *[c for c in texts.columns if c != "_text"], *[F.col(f"_code.{c}").alias(f"_{c}") for c in parts]
    )


def bucket_totals(codes: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for row in batch["_buckets"]:
                totals += np.bincount(np.frombuffer(row, "<u4"), minlength=buckets)
        at = np.flatnonzero(totals)
        yield pd.DataFrame({"_bucket": at, "_n": totals[at]})

    parts = codes.select("_buckets").mapInPandas(add, "_bucket bigint, _n bigint")
    totals = np.zeros(buckets, np.int64)
    for row in parts.groupBy("_bucket").agg(F.sum("_n").alias("_n")).collect():
        totals[row["_bucket"]] = row["_n"]
    return totals


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed bucket shares, floored; exact totals in, longs out."""
    s_all, t_all, buckets = float(source.sum()), float(target.sum()), len(source)
    return np.array(
        [
            math.floor(1000 * math.log(
                (float(t) + 1) * (s_all + buckets) / ((float(s) + 1) * (t_all + buckets))
            ))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def mean_gain(buckets: Column, gain: np.ndarray) -> Column:
    """The floored mean of a text's gains, 0 for a text without features."""

    @F.pandas_udf("bigint")
    def mean(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in rows:
            yield pd.Series(
                [int(gain[np.frombuffer(r, "<u4")].sum()) // (len(r) // 4) if r else 0 for r in batch],
                dtype="int64",
            )

    return mean(buckets)


def gumbel(ident: Column, seed: str) -> Column:
    """Thousandths of Gumbel noise drawn by a hash of the seed and the id, floored."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``_place``, 0, 1, ... in the order, without gathering the rows anywhere.

    Ranges of the order go to tasks; a row's place is its place in the task plus the rows of the tasks
    before, of which there are as many as partitions.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered = materialise(ordered.withColumn("_at", F.monotonically_increasing_id()), "resample-order")
    task, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit(2**33 - 1))
    ordered = ordered.withColumn("_task", task)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ordered.groupBy("_task").agg(F.count("*").alias("_rows")).select(
        "_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    return ordered.join(F.broadcast(offsets), "_task").withColumn("_place", F.col("_before") + within)


def resampled(
    documents: DataFrame,
    target: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    runs: int = 1,
    buckets: int = BUCKETS,
    percent: int = 10,
    min_words: int = 20,
    seed: str = "2024",
    head: int = HEAD,
) -> DataFrame:
    """``<ident>, n_features, weight, score, rank`` of every row of ``documents``.

    Of the rows with ``min_words`` words or more, ``percent`` in a hundred (floored) with the highest
    scores get a rank from 1; the others' rank is null. Ties go to the smaller id, null ids come last and
    hash as empty text; rows equal in score and id are ranked in any order. A null text has no words, and a text without
    features has weight 0. Repeated rows count and compete each for itself. An empty table gives no rows;
    an empty target only smooths. Other columns are ignored, whatever their names.

    Written to the shared folder: word counts, four bytes per feature, and a narrow row per document.
    On the driver: at most ``head`` words and pairs, and ``buckets`` totals.
    """
    if runs < 1 or buckets < 1 or head < 1:
        raise ValueError("runs, buckets and head must be at least 1")
    own = documents.select(F.col(ident).alias("_id"), whole(F.col(text)).alias("_text"))
    wanted = target.select(whole(F.col(target_text)).alias("_text"))
    frequent = head_of(own, runs, buckets, head)
    codes = materialise(coded(own, frequent, runs), "resample-codes")
    gain = gains(bucket_totals(codes, buckets), bucket_totals(coded(wanted, frequent, runs), buckets))
    scored = codes.select(
        "_id", "_n_words", "_n_features", mean_gain(F.col("_buckets"), gain).alias("_weight"),
        F.monotonically_increasing_id().alias("_row"),
    ).withColumn("_score", F.col("_weight") + gumbel(F.col("_id"), seed))
    scored = materialise(scored.withColumn("_takes_part", F.col("_n_words") >= min_words), "resample-scores")
    drawn = scored.where("_takes_part").count() * percent // 100
    order = [
        F.desc("_takes_part"), F.desc("_score"), F.asc_nulls_last("_id"), F.asc("_row"),
    ]
    place = F.col("_place")
    return _ranked(scored, order).select(
        F.col("_id").alias(ident), F.col("_n_features").alias("n_features"),
        F.col("_weight").alias("weight"), F.col("_score").alias("score"),
        F.when(F.col("_takes_part") & (place < drawn), place + 1).cast("bigint").alias("rank"),
    )
