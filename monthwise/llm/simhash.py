"""SimHash near-duplicates through the segment-popcount embedding.

A 64-bit fingerprint is cut into segments and mapped to the vector of their bit counts. One differing
bit changes one count by one, so the Manhattan distance of two vectors never exceeds the number of
differing bits, and a range join on the integer grid finds every link. The join itself: a
fingerprint visits the grid points within half the distance of its own; two vectors within the
distance have such a point in common, so whoever meets is compared, first by Manhattan distance,
then by differing bits. A fingerprint visits a fixed number of points, copies count once, and with
segments of two bits hardly any unrelated fingerprints meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from monthwise.llm.common import whole
from monthwise.llm.components import components
from monthwise.session import materialise

SEED = 42


def fingerprint(text: str, shingle: int) -> int:
    """The fingerprint of a text, unsigned; 0 without words."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist())],
        dtype="<u8",
    )
    total = np.zeros(64, dtype=np.int64)
    for part in range(0, len(hashes), 65536):
        octets = hashes[part : part + 65536].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * total > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """``docs`` and ``_fp``, the fingerprint as a signed long."""

    @pandas_udf("bigint")
    def mark(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return docs.withColumn("_fp", mark(whole(F.col(text))))


def popcounts(values: np.ndarray, width: int) -> np.ndarray:
    """Bit counts of all segments, each count kept in the bits of its segment."""
    mask = np.uint64(sum(1 << k for k in range(0, 64, width)))
    out = values & mask
    for shift in range(1, width):
        out = out + ((values >> np.uint64(shift)) & mask)
    return out


def _near_points(cells: np.ndarray, owners: np.ndarray, width: int, radius: int):
    """Grid points within ``radius`` of each cell, with the owner of the visit."""
    one, top = np.uint64(1), np.uint64((1 << width) - 1)
    points, who = cells, owners
    for _ in range(radius):
        grown, grown_who = [points], [who]
        for shift in range(0, 64, width):
            at = np.uint64(shift)
            count = (points >> at) & top
            more, less = count < width, count > 0
            grown += [points[more] + (one << at), points[less] - (one << at)]
            grown_who += [who[more], who[less]]
        both = np.unique(np.rec.fromarrays([np.concatenate(grown), np.concatenate(grown_who)]))
        points, who = both.f0, both.f1
    return points, who


def _manhattan(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    top = np.uint64((1 << width) - 1)
    total = np.zeros(len(a), dtype=np.int64)
    for shift in range(0, 64, width):
        at = np.uint64(shift)
        total += np.abs(((a >> at) & top).astype(np.int64) - ((b >> at) & top).astype(np.int64))
    return total


def _met(points: np.ndarray, prints: np.ndarray, distance: int, width: int):
    """Links among those that meet: rows are sorted by point, so partners are some rows apart."""
    found = []
    at = np.arange(len(points))
    step = 1
    while len(at):
        at = at[at + step < len(points)]
        at = at[points[at] == points[at + step]]
        a, b = prints[at], prints[at + step]
        close = _manhattan(popcounts(a, width), popcounts(b, width), width) <= distance
        close &= np.bitwise_count(a ^ b) <= distance
        found.append(np.stack([a[close], b[close]]))
        step += 1
    return np.concatenate(found, axis=1) if found else np.empty((2, 0), np.uint64)


def near_links(prints: DataFrame, distance: int, width: int = 2) -> DataFrame:
    """``_a``, ``_b``: every pair of distinct fingerprints ``_fp`` within ``distance`` bits."""
    if not 0 <= distance <= 4 or width not in (2, 4, 8):
        raise ValueError("distance 0 to 4, segments of 2, 4 or 8 bits")
    radius = (distance + 1) // 2

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["_fp"].to_numpy().view(np.uint64)
            for part in range(0, len(values), 4096):
                own = values[part : part + 4096]
                points, who = _near_points(popcounts(own, width), own, width, radius)
                yield pd.DataFrame({"_point": points.view(np.int64), "_fp": who.view(np.int64)})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points, prints = np.empty(0, np.uint64), np.empty(0, np.uint64)
        for batch in batches:
            points = np.concatenate([points, batch["_point"].to_numpy().view(np.uint64)])
            prints = np.concatenate([prints, batch["_fp"].to_numpy().view(np.uint64)])
            if not len(points):
                continue
            # The last point may go on in the next batch.
            cut = int(np.searchsorted(points.view(np.int64), points.view(np.int64)[-1]))
            a, b = _met(points[:cut], prints[:cut], distance, width)
            points, prints = points[cut:], prints[cut:]
            yield pd.DataFrame({"_a": a.view(np.int64), "_b": b.view(np.int64)})
        a, b = _met(points, prints, distance, width)
        yield pd.DataFrame({"_a": a.view(np.int64), "_b": b.view(np.int64)})

    spread = prints.mapInPandas(visits, "_point bigint, _fp bigint")
    return (
        spread.repartition("_point")
        .sortWithinPartitions("_point", "_fp")
        .mapInPandas(meet, "_a bigint, _b bigint")
        .distinct()
    )


def _grouped(docs: DataFrame, text: str, ident: str, shingle: int, distance: int, width: int):
    """``<ident>``, ``_fp``, ``_group`` and ``_component`` of each row."""
    marked = with_fingerprints(docs.select(ident, text), text, shingle).select(ident, "_fp")
    marked = materialise(marked, "fingerprints")
    distinct = materialise(
        marked.groupBy("_fp").agg(F.min(ident).alias("_first")), "distinct-fingerprints"
    )
    links = near_links(distinct.select("_fp"), distance, width)
    labels = components(links, "_a", "_b").select(
        F.col("node").alias("_fp"), F.col("component").alias("_group")
    )
    named = distinct.join(labels, "_fp", "left").select(
        "_fp", "_first", F.coalesce("_group", "_fp").alias("_group")
    )
    lowest = named.groupBy("_group").agg(F.min("_first").alias("_component"))
    owners = named.join(lowest, "_group").select("_fp", "_group", "_component")
    return marked.join(owners, "_fp").select(ident, "_fp", "_group", "_component")


def simhash_components(
    docs: DataFrame,
    text: str = "text",
    ident: str = "doc_id",
    shingle: int = 3,
    distance: int = 2,
    width: int = 2,
) -> DataFrame:
    """``<ident>``, ``_fp`` and ``_component`` of each row.

    ``_component`` is the smallest id reachable by links, the own one included. Null and empty texts
    have fingerprint zero and are linked like others. Rows with a null id belong to components but
    never name them; a component of such rows alone has a null name. Repeated rows stay repeated.
    """
    return _grouped(docs, text, ident, shingle, distance, width).drop("_group")


def keep_one_of_each(
    docs: DataFrame,
    text: str = "text",
    ident: str = "doc_id",
    shingle: int = 3,
    distance: int = 2,
    width: int = 2,
) -> DataFrame:
    """The row with the smallest id of each group, with all columns of ``docs``.

    Where several rows of the group have that id (or the whole group has null ids), the one with the
    lowest fingerprint and then the lowest text hash stays.
    """
    found = materialise(
        _grouped(docs, text, ident, shingle, distance, width), "simhash-components"
    )
    kept = found.where(F.col(ident).eqNullSafe(F.col("_component"))).groupBy("_group").agg(
        F.min("_component").alias("_kid"), F.min("_fp").alias("_kfp")
    )
    times = found.groupBy(ident).agg(F.count("*").alias("_rows"))
    several = (F.col("_rows") > 1) | F.col(ident).isNull()
    repeated = materialise(
        times.where(several).select(F.col(ident).alias("_rid")), "repeated-ids"
    )
    kept = kept.select(F.col("_kid"), F.col("_kfp"))
    once = kept.join(repeated, F.col("_kid").eqNullSafe(F.col("_rid")), "left_anti")
    all_rows = docs.select(F.struct(*docs.columns).alias("_row"))
    own = F.col("_row")[ident]
    rows = all_rows.join(once, own == F.col("_kid"), "left_semi").select("_row.*")
    if repeated.isEmpty():
        return rows
    # Only rows that share their id need their fingerprint again.
    same = all_rows.join(repeated, own.eqNullSafe(F.col("_rid")), "left_semi")
    same = with_fingerprints(same.withColumn("_body", F.col("_row")[text]), "_body", shingle)
    same = same.join(kept, own.eqNullSafe(F.col("_kid")) & (F.col("_fp") == F.col("_kfp")))
    chosen = same.groupBy("_kid", "_kfp").agg(
        F.min_by("_row", F.xxhash64(whole(F.col("_body")))).alias("_row")
    )
    return rows.unionAll(chosen.select("_row.*"))
