"""Near-duplicate vectors with inverted lists and product-quantised residuals.

Fitting: coarse centroids of the first and of the second half of the coordinates, of which every pair is a
list, and, on the residuals, one small codebook for each subspace, from a bounded sample. So the lists, as
the square of the centroids, go on growing with the table where the sample does not. Indexing: every vector gets its list, its codes and the length of what the codes miss.
Searching: every vector visits its own list and those after it that can hold a neighbour, compares its
distance tables with the codes there, and reranks by exact cosine what the codes, less their known error,
can't rule out. Of two lists only one side visits, as either sees the border between them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.llm.components import components
from monthwise.session import materialise

SAMPLE = 8192
BLOCK = 1024
SALTS = 16


@dataclass
class Index:
    """What the fit found, in float64. ``halves``: centroids of either half; ``books``: subspace, code, coordinate."""

    halves: tuple[np.ndarray, np.ndarray]
    books: np.ndarray

    def centres(self, lists: np.ndarray) -> np.ndarray:
        first, second = self.halves
        return np.concatenate([first[lists // len(second)], second[lists % len(second)]], axis=1)

    def borders(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The list of each vector, and by half how far it is from the border to each other centroid's cell."""
        home, far = np.zeros(len(x), np.int64), []
        for part, centres in zip(_split(x), self.halves):
            square = _distances(part, centres)
            at = square.argmin(1)
            apart = np.sqrt(_distances(centres, centres))
            apart[apart == 0] = np.inf  # itself, and centroids that coincide with it
            far.append((square - square[np.arange(len(x)), at][:, None]) / (2 * apart[at]))
            home = home * len(centres) + at
        return home, far

    def residual_codes(self, rest: np.ndarray) -> np.ndarray:
        parts = self.books.shape[0]
        pieces = rest.reshape(len(rest), parts, -1)
        return np.stack(
            [_nearest(pieces[:, k], self.books[k])[0] for k in range(parts)], axis=1
        ).astype(np.uint8)

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        parts = np.arange(codes.shape[1])
        return self.books[parts, codes].reshape(len(codes), -1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, never negative."""
    square = (x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)
    return np.maximum(square, 0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    square = _distances(x, centres)
    at = square.argmin(1)
    return at, square[np.arange(len(x)), at]


def _kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at, _ = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        n = np.bincount(at, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, : x.shape[1] // 2], x[:, x.shape[1] // 2 :]


def fit(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 7) -> Index:
    """Fit on unit vectors, at least ``lists`` lists if the sample has eight vectors for each centroid of a half.
    Subspaces of four coordinates where the dimension allows, else of one."""
    dim = sample.shape[1]
    parts = dim // 4 if dim % 4 == 0 else dim
    each = max(1, min(len(sample) // 8, int(np.ceil(lists**0.5))))
    if dim == 1:
        each = 1  # there is nothing in the first half
    halves = tuple(_kmeans(half, each, rounds, seed + k) for k, half in enumerate(_split(sample)))
    index = Index(halves, np.zeros((parts, 1, dim // parts)))
    rest = (sample - index.centres(index.borders(sample)[0])).reshape(len(sample), parts, -1)
    codes = min(256, len(sample))
    index.books = np.stack([_kmeans(rest[:, k], codes, rounds, seed + k) for k in range(parts)])
    return index


def lists_for(rows: int, members: int) -> int:
    """How many lists: as many as each has members, but those at least ``members``."""
    return max(1, min(rows // members, int(rows**0.5)))


def usable(vector: Column, label: Column) -> Column:
    """Whether a row can link at all."""
    finite = F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    )
    return F.coalesce(
        label.isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False)
    )


def _packed(vector: np.ndarray) -> bytes:
    """A vector in single precision where that holds it exactly, else in double."""
    short = vector.astype(np.float32)
    return short.tobytes() if (short == vector).all() else vector.tobytes()


def _unpacked(rows: pd.Series, dim: int) -> np.ndarray:
    """Unit vectors again."""
    return _unit([np.frombuffer(r, np.float32 if len(r) == 4 * dim else np.float64) for r in rows])


def effective_rank(sample: np.ndarray) -> float:
    """Along how many directions the vectors spread, by the participation ratio of their variances."""
    spread = np.cov(sample, rowvar=False, bias=True).reshape(sample.shape[1], -1)
    total, square = float(np.trace(spread)), float((spread**2).sum())
    return max(1.0, total**2 / square) if square > 0 else 1.0


def _unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow below
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _links_of(
    classes: DataFrame, rows: int, dim: int, threshold: float, sigmas: float, least: int
) -> DataFrame:
    """``_node``, ``_links``, ``_low``: parts of the link counts and of a spanning forest. ``rows``: of the
    largest label, as lists are those of a label; ``least``: members of a list."""
    sample = _unit(
        classes.orderBy(F.xxhash64("_h1", "_node")).limit(SAMPLE).toPandas()["_vector"]
    )
    index = fit(sample, lists_for(rows, least))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9
    # Of a difference of this length only so much points from centroids to others, if differences lie as the
    # vectors do: along few directions, all of it may. What points so in the halves adds up by squares.
    aside = min(reach, sigmas * reach / np.sqrt(effective_rank(sample)))

    def visited(home: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The lists from ``home`` on that hold what is within ``aside``, by the borders of either half."""
        i, j = np.flatnonzero(first <= aside), np.flatnonzero(second <= aside)
        near = first[i, None] ** 2 + second[j] ** 2 <= aside**2
        lists = (i[:, None] * len(second) + j)[near]
        return lists[lists >= home].astype(np.int32)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (b[at : at + BLOCK] for b in batches for at in range(0, len(b), BLOCK)):
            x = _unit(batch["_vector"])
            home, (first, second) = index.borders(x)
            rest = x - index.centres(home)
            codes = index.residual_codes(rest)
            miss = np.linalg.norm(rest - index.decoded(codes), axis=1)
            yield pd.DataFrame({
                "_node": batch["_node"], "_label": batch["_label"], "_size": batch["_size"],
                "_home": home.astype(np.int32),
                "_visits": [visited(*row) for row in zip(home, first, second)],
                "_codes": [c.tobytes() for c in codes], "_miss": miss,
                "_x": [_packed(np.asarray(v, np.float64)) for v in batch["_vector"]],
            })

    kind = dict(classes.dtypes)["_label"]
    placed = materialise(
        classes.mapInPandas(
            place,
            f"_node bigint, _label {kind}, _size bigint, _home int, _visits array<int>, "
            "_codes binary, _miss double, _x binary",
        ),
        "vector-index",
    )
    # Large lists and many visitors are dealt out in blocks, so no group grows with the data.
    deal = F.xxhash64("_node")
    sizes = placed.groupBy("_label", F.col("_home").alias("_list")).agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks")
    )
    visits = placed.select(
        "_label", F.explode("_visits").alias("_list"), "_home", "_node", "_x", "_size"
    )
    crowds = placed.select("_label", F.explode("_visits").alias("_list")).groupBy(
        "_label", "_list"
    ).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_turns"))
    grid = sizes.join(crowds, ["_label", "_list"])
    # Until a row knows into how many blocks its list is dealt, a salt keeps the rows of a large list apart.
    grid = grid.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(F.lit(1), "_node"), F.lit(SALTS)).cast("int")
    key = ["_label", "_list", "_block", "_turn"]
    members = (
        placed.withColumn("_list", F.col("_home"))
        .withColumn("_salt", salt)
        .join(grid, ["_label", "_list", "_salt"])
        .withColumn("_block", F.pmod(deal, F.col("_blocks")).cast("int"))
        .withColumn("_turn", F.explode(F.sequence(F.lit(0), F.col("_turns") - 1)))
        .select(*key, "_node", "_size", "_codes", "_miss", "_x")
    )
    visitors = (
        visits.withColumn("_salt", salt)
        .join(grid, ["_label", "_list", "_salt"])
        .withColumn("_turn", F.pmod(deal, F.col("_turns")).cast("int"))
        .withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .select(*key, "_node", "_size", "_x", (F.col("_home") == F.col("_list")).alias("_inside"))
    )
    visitors = visitors.toDF(*visitors.columns)  # new columns, as both sides come from one table

    def compare(group: tuple, own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("_node", "_links", "_low")})
        if not len(own) or not len(others):
            return empty
        centre = index.centres(np.array([int(group[1])]))[0]
        codes = np.frombuffer(b"".join(own["_codes"]), np.uint8).reshape(len(own), -1)
        y, x = _unpacked(own["_x"], dim), _unpacked(others["_x"], dim)
        limit = reach + own["_miss"].to_numpy()
        nodes, visiting = own["_node"].to_numpy(), others["_node"].to_numpy()
        left, right = [], []
        parts = index.books.shape[0]
        for start in range(0, len(x), 256):
            part = x[start : start + 256]
            rest = (part - centre).reshape(len(part), parts, -1)
            square = np.zeros((len(part), len(own)))
            for k in range(parts):
                square += _distances(rest[:, k], index.books[k])[:, codes[:, k]]
            a, b = np.nonzero(np.sqrt(square) <= limit + 1e-9)
            other = visiting[a + start] != nodes[b]
            a, b = a[other], b[other]
            for at in range(0, len(a), 65536):
                i, j = a[at : at + 65536], b[at : at + 65536]
                exact = np.einsum("ij,ij->i", part[i], y[j]) >= threshold
                left.append(i[exact] + start)
                right.append(j[exact])
        left, right = np.concatenate([*left, []]).astype(int), np.concatenate([*right, []]).astype(int)
        if not len(left):
            return empty
        # Inside a list both ends of a link visit; from outside only one does, and it counts for both.
        outside = ~others["_inside"].to_numpy(bool)[left]
        links = np.zeros(len(x), np.int64)
        np.add.at(links, left, own["_size"].to_numpy()[right])
        back = np.zeros(len(y), np.int64)
        np.add.at(back, right[outside], others["_size"].to_numpy()[left[outside]])
        low_x, low_y = visiting.copy(), nodes.copy()
        while True:
            before = low_x.copy(), low_y.copy()
            np.minimum.at(low_x, left, low_y[right])
            np.minimum.at(low_y, right, low_x[left])
            if (before[0] == low_x).all() and (before[1] == low_y).all():
                break
        i, j = np.unique(left), np.unique(right)
        return pd.DataFrame({
            "_node": np.concatenate([visiting[i], nodes[j]]),
            "_links": np.concatenate([links[i], back[j]]),
            "_low": np.concatenate([low_x[i], low_y[j]]),
        })

    return materialise(
        members.groupBy(*key)
        .cogroup(visitors.groupBy(*key))
        .applyInPandas(compare, "_node bigint, _links bigint, _low bigint"),
        "vector-links",
    )


def vector_components(
    vectors: DataFrame,
    ident: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = 0.93,
    sigmas: float = 4.0,
    members: int = 256,
) -> DataFrame:
    """``<ident>``, ``_n_links``, ``_component`` of each row.

    Only rows with equal labels that are not null, and of equal dimension, are compared. Rows whose
    vector is null, zero or holds null or non-finite components, or whose label is null, link with
    nothing; their component is their own id. Equal vectors form one class that is compared once and
    counted with its size. Null ids count as vectors but never name a component of others.

    The index is fitted on at most ``SAMPLE`` classes (by hash) and holds all of them. Lists grow with the root of
    the largest label, up to 1,024 centroids a half: a million lists. They have about ``members`` members or more, as a
    visit first computes 256 distances to the codes of each subspace, which shorter lists don't repay. ``sigmas``
    says how far beyond the border of its list a vector looks, in standard deviations of a difference
    of the threshold's length along one of the directions that the sample spreads over
    (:func:`effective_rank`); the square root of their number looks everywhere a neighbour can be, which
    the default does up to 16.
    """
    rows = vectors.select(
        F.col(ident).alias("_id"), F.col(label).alias("_label"),
        F.col(vector).cast("array<double>").alias("_vector"),
        usable(F.col(vector), F.col(label)).alias("_usable"),
    )
    rows = rows.withColumns({
        "_h1": F.xxhash64("_vector"), "_h2": F.xxhash64(F.lit(1), "_vector"),
        "_dim": F.size("_vector"),
    })
    good = rows.where("_usable")
    key = ["_label", "_dim", "_h1", "_h2"]
    classes = good.groupBy(*key).agg(
        F.any_value("_vector").alias("_vector"), F.count("*").alias("_size"),
        F.min("_id").alias("_first"),
    )
    classes = materialise(
        classes.withColumn("_node", F.monotonically_increasing_id()), "vector-classes"
    )
    parts = None
    sizes = classes.groupBy("_dim", "_label").agg(F.count("*").alias("n"))
    for found in sizes.groupBy("_dim").agg(F.max("n").alias("n")).orderBy("_dim").collect():
        of = classes.where(F.col("_dim") == found["_dim"])
        part = _links_of(of, int(found["n"]), int(found["_dim"]), threshold, sigmas, members)
        parts = part if parts is None else parts.unionAll(part)
    own = rows.select("_id", "_usable", *key)
    if parts is None:
        return own.select(
            F.col("_id").alias(ident), F.lit(0).cast("bigint").alias("_n_links"),
            F.col("_id").alias("_component"),
        )
    counts = parts.groupBy("_node").agg(F.sum("_links").alias("_found"))
    groups = components(parts, "_node", "_low")
    named = (
        classes.select(*key, "_node", "_size", "_first")
        .join(counts, "_node", "left")
        .join(groups.withColumnRenamed("node", "_node"), "_node", "left")
        .withColumn("component", F.coalesce("component", "_node"))
    )
    lowest = named.groupBy("component").agg(F.min("_first").alias("_component"))
    named = materialise(
        named.join(lowest, "component").select(
            *[F.col(c).alias(f"_c{c}") for c in key], "_component",
            (F.coalesce("_found", F.lit(0)) + F.col("_size") - 1).alias("_n_links"),
        ),
        "vector-named",
    )
    same = F.col("_usable")
    for c in key:
        same = same & (F.col(c) == F.col(f"_c{c}"))
    return own.join(named, same, "left").select(
        F.col("_id").alias(ident),
        F.coalesce("_n_links", F.lit(0)).cast("bigint").alias("_n_links"),
        F.when(F.col("_usable"), F.col("_component")).otherwise(F.col("_id")).alias("_component"),
    )
