"""Best-fit packing by exact-complement hashing.

Only the number of pieces of each length decides how sequences are filled, and there are no more
lengths than a sequence has tokens. So the histogram is planned on the driver (its size is bounded
by the sequence length, not by the data) and the pieces then look up their places.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from monthwise.llm.common import whole
from monthwise.llm.tokens import END, byte_bpe
from monthwise.session import materialise

SLOT = ["length", "rank", "bins", "copies", "first", "offset"]


class Plan:
    """Slots for a histogram ``{length: pieces}``.

    A slot says: pieces ``rank .. rank + bins * copies - 1`` of this ``length`` go, ``copies`` each,
    to the sequences ``first .. first + bins - 1``, from ``offset`` on.

    ``parts``: of how many lengths at most a gap is filled exactly before best fit takes the rest.
    """

    def __init__(self, counts: dict[int, int], size: int, parts: int = 3):
        if any(not 1 <= length <= size for length in counts):
            raise ValueError("a piece is longer than a sequence, or empty")
        self.size, self.sequences = size, 0
        self.left = np.zeros(size + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.used = np.zeros(size + 1, dtype=np.int64)
        self.slots: list[tuple[int, ...]] = []
        self._exact(parts)
        self._best_fit()

    def _place(self, length: int, bins: int, copies: int, first: int, offset: int) -> None:
        self.slots.append((length, int(self.used[length]), bins, copies, first, offset))
        self.used[length] += bins * copies
        self.left[length] -= bins * copies

    def _fill(self, parts: tuple[int, ...]) -> bool:
        """As many full sequences of these lengths as the counts allow."""
        need = Counter(parts)
        bins = int(min(self.left[p] // n for p, n in need.items()))
        if bins <= 0:
            return False
        first, offset = self.sequences, 0
        self.sequences += bins
        for length, copies in need.items():
            self._place(length, bins, copies, first, offset)
            offset += length * copies
        return True

    def _pairs(self, total: int):
        """Available lengths ``b >= c`` with ``b + c == total``, largest ``b`` first."""
        if total < 2:
            return
        there = self.left[: total] > 0
        for b in np.flatnonzero(there[1:] & there[1:][::-1])[::-1] + 1:
            if 2 * b < total:
                return
            yield int(b), int(total - b)

    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Which sums some pair, and some triple, of available lengths reaches.

        Lengths only run out, so these may name too many sums later but never too few; the counts decide.
        """
        there = self.left > 0
        pairs, triples = np.zeros(self.size + 1, dtype=bool), np.zeros(self.size + 1, dtype=bool)
        for b in np.flatnonzero(there):
            pairs[b:] |= there[: self.size + 1 - b]
        for b in np.flatnonzero(there):
            triples[b:] |= pairs[: self.size + 1 - b]
        return pairs, triples

    def _exact(self, parts: int) -> None:
        """Consume, for each length from the longest, singles, pairs and triples that fill its gap."""
        pairs, triples = self._sums()
        for a in range(self.size, 0, -1):
            if self.left[a] <= 0:
                continue
            gap = self.size - a
            if gap == 0:
                self._fill((a,))
                continue
            if parts >= 1 and self.left[gap] > 0:
                self._fill((a, gap))
            if parts >= 2 and pairs[gap]:
                for pair in self._pairs(gap):
                    if self.left[a] <= 0:
                        break
                    self._fill((a, *pair))
            if parts < 3 or self.left[a] <= 0 or not triples[gap]:
                continue
            b = np.arange(1, gap - 1)
            for x in b[(self.left[1 : gap - 1] > 0) & pairs[gap - b]][::-1]:
                for pair in self._pairs(gap - int(x)):
                    if self.left[a] <= 0 or self.left[x] <= 0:
                        break
                    if pair[0] <= x:
                        self._fill((a, int(x), *pair))
                if self.left[a] <= 0:
                    break

    def _best_fit(self) -> None:
        """What is left, longest first, into the sequence where least room remains."""
        rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)
        gaps: list[int] = []

        def open_range(gap: int, first: int, bins: int) -> None:
            if gap > 0 and bins > 0:
                if not rooms[gap]:
                    gaps.insert(bisect_left(gaps, gap), gap)
                rooms[gap].append((first, bins))

        for a in range(self.size, 0, -1):
            while self.left[a] > 0:
                at = bisect_left(gaps, a)
                if at < len(gaps):
                    gap = gaps[at]
                    first, bins = rooms[gap].pop()
                    if not rooms[gap]:
                        gaps.pop(at)
                    fit = gap // a
                    left = int(self.left[a])
                    full = min(bins, left // fit)
                    if full:
                        self._place(a, full, fit, first, self.size - gap)
                        open_range(gap - fit * a, first, full)
                    elif left:
                        self._place(a, 1, left, first, self.size - gap)
                        open_range(gap - left * a, first, 1)
                        full = 1
                    open_range(gap, first + full, bins - full)
                else:
                    copies = min(self.size // a, int(self.left[a]))
                    bins = int(self.left[a]) // copies
                    first = self.sequences
                    self.sequences += bins
                    self._place(a, bins, copies, first, 0)
                    open_range(self.size - copies * a, first, bins)


def best_plan(counts: dict[int, int], size: int) -> Plan:
    """The plan with the fewest sequences of those that fill gaps by up to three, two, one or no lengths.

    Filling exactly may spend short pieces, which would have gone into many gaps later, so less of it can need
    fewer sequences. The last plan is best fit alone, which the result so never exceeds; among equals the
    one that fills most exactly is taken.
    """
    return min((Plan(counts, size, parts) for parts in (3, 2, 1, 0)), key=lambda plan: plan.sequences)


def token_pieces(docs: DataFrame, tokenizer: str, size: int = 2048) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` of every document.

    A document is its ids and one end id. One that is longer than ``size`` is cut so that all
    pieces but the first are full. A null or empty text is the end id alone; a null id is kept as it is, repeated
    rows count each for itself, an empty table gives no pieces. Other columns are left out, whatever
    their names.
    """

    @pandas_udf("array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>")
    def pieces(texts: pd.Series) -> pd.Series:
        encoder = byte_bpe(tokenizer)
        out = []
        for text in texts:
            ids = np.append(encoder.ids(text), END).astype("<u4")
            first = len(ids) % size or size
            cuts = [0, *range(first, len(ids), size), len(ids)]
            out.append([
                (i, s, e - s, zlib.crc32(ids[s:e].tobytes()))
                for i, (s, e) in enumerate(zip(cuts, cuts[1:]))
            ])
        return pd.Series(out, dtype=object)

    return docs.select(
        F.col("doc_id"), F.explode(pieces(whole(F.col("text")))).alias("_p")
    ).select("doc_id", "_p.*")


def pack(pieces: DataFrame, size: int = 2048, buckets: int | None = None) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``buckets`` deals the pieces of one length over many tasks (the number of shuffle partitions
    unless given), so a length that a third of all pieces have is numbered in parallel. Ties and
    repeated pieces are interchangeable. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.xxhash64("doc_id", "piece", "start", "ids_crc32")
    rows = materialise(pieces.withColumn("_bucket", F.pmod(key, F.lit(buckets))), "pieces")

    counts = rows.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    counts = materialise(counts, "piece-counts")  # at most size * buckets rows
    totals = counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # at most size rows
    plan = best_plan({int(r["length"]): int(r["n"]) for r in totals}, size)
    slots = np.array(sorted(plan.slots), dtype=np.int64).reshape(-1, len(SLOT))

    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    base = counts.select(
        "length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    within = Window.partitionBy("length", "_bucket").orderBy(
        "doc_id", "piece", "start", "ids_crc32"
    )
    ranked = rows.withColumn("_rank", F.row_number().over(within) - 1).join(
        base, ["length", "_bucket"]
    )

    @pandas_udf("struct<sequence_id:bigint,offset:bigint>")
    def places(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        wide = np.int64(1) << 42
        at = np.searchsorted(
            slots[:, 0] * wide + slots[:, 1], length.to_numpy() * wide + rank.to_numpy(), "right"
        ) - 1
        found = slots[at]
        turn = rank.to_numpy() - found[:, 1]
        return pd.DataFrame({
            "sequence_id": found[:, 4] + turn // found[:, 3],
            "offset": found[:, 5] + turn % found[:, 3] * found[:, 0],
        })

    at = places(F.col("length"), F.col("_base") + F.col("_rank"))
    return ranked.withColumn("_at", at).select(*pieces.columns, "_at.*")
