"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.session import materialise


def _lowest(sides: DataFrame) -> DataFrame:
    """For every ``_u`` the lowest of itself and its neighbours ``_v``, joined to its rows.

    The minimum is taken in the map tasks first, so a hub does not gather its links in one task.
    """
    low = sides.groupBy("_u").agg(F.least(F.col("_u"), F.min("_v")).alias("_low"))
    return sides.join(low, "_u")


def _both(links: DataFrame) -> DataFrame:
    return links.select(F.col("_a").alias("_u"), F.col("_b").alias("_v")).unionAll(
        links.select(F.col("_b").alias("_u"), F.col("_a").alias("_v"))
    )


def _clean(pairs: DataFrame) -> DataFrame:
    return pairs.where("_a != _b").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that has a link.

    Links of a node with itself, repeated links and links with a null end count for nothing. Every
    round writes its links to the shared folder; the number of rounds grows with the logarithm of
    the longest path.
    """
    links = links.select(F.col(a).alias("_a"), F.col(b).alias("_b")).where("_a is not null and _b is not null")
    links = materialise(_clean(links), "links")
    before = None
    while True:
        large = _lowest(_both(links)).where("_v > _u").select(
            F.col("_v").alias("_a"), F.col("_low").alias("_b")
        )
        large = materialise(_clean(large), "links")
        down = large.select(
            F.greatest("_a", "_b").alias("_u"), F.least("_a", "_b").alias("_v")
        )
        low = _lowest(down)
        small = low.select(F.col("_v").alias("_a"), F.col("_low").alias("_b")).unionAll(
            low.select(F.col("_u").alias("_a"), F.col("_low").alias("_b"))
        )
        links = materialise(_clean(small), "links")
        state = links.agg(
            F.count("*"), F.sum(F.xxhash64("_a", "_b").cast("decimal(20,0)"))
        ).first()
        if state == before:
            break
        before = state
    return links.select(F.col("_a").alias("node"), F.col("_b").alias("component")).unionAll(
        links.select(F.col("_b").alias("node"), F.col("_b").alias("component")).distinct()
    )
