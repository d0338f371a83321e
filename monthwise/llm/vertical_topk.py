"""Exact highest inner products by branch and bound over a vertical layout.

Vectors of whole numbers are written in blocks that hold one matrix for each group of dimensions,
those with the greatest mass first. A search adds up scores dimension group by dimension group; after
each, a candidate stays only if its sum so far, plus the most that the remaining masses of both vectors
allow, reaches the score that the query is already sure of. The survivors are compacted, and what is
left after the last group is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from monthwise.session import fresh_dir, materialise

#: Vectors in a block, and bytes of one as doubles, whichever is less.
BLOCK, BLOCK_BYTES = 2048, 4 << 20
#: Dimensions of a group.
GROUP = 8
#: Queries searched in one pass, about, and bytes of them.
PASS, PASS_BYTES = 2048, 16 << 20
#: Queries whose sums are held at a time.
STEP = 128
SAFE = float(2**53)
_LAYOUT = (
    "_dim int, _first bigint, _ids array<bigint>, _nameless array<boolean>, _asks array<boolean>, "
    "_order array<int>, _kind string, _groups array<binary>, _mass binary"
)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: neither null nor with null or non-finite components."""
    return F.coalesce(
        F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))),
        F.lit(False),
    )


def _whole_numbers(vectors, scale: float) -> np.ndarray:
    """``floor(scale * x)``, in doubles."""
    x = np.floor(scale * np.stack([np.asarray(v, np.float64) for v in vectors]))
    if not np.isfinite(x).all():
        raise OverflowError("a scaled component is beyond doubles")
    return x


def _masses(x: np.ndarray, starts: list[int]) -> np.ndarray:
    """Length of what is left of each vector from each group on; one column more, of zeros."""
    square = np.cumsum((x**2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.stack([*[square[:, s] for s in starts], np.zeros(len(x))], axis=1))


def vertical(rows: DataFrame, scale: float, group: int = GROUP) -> DataFrame:
    """Blocks of ``_id, _nameless, _vector, _ask``: matrices by dimension group, remaining masses, row numbers.

    A block holds vectors of one length from one task, at most ``BLOCK`` of them.
    """

    def block(dim: int, first: int, ids: list, nameless: list, asks: list, vectors: list) -> dict:
        x = _whole_numbers(vectors, scale) if dim else np.zeros((len(ids), 0))
        order = np.argsort(-(x**2).sum(0), kind="stable")
        x = x[:, order]
        starts = list(range(0, dim, group))
        kind = "<i2" if not x.size or np.abs(x).max() < 2**15 else "<f8"
        return {
            "_dim": dim, "_first": first, "_ids": ids, "_nameless": nameless, "_asks": asks,
            "_order": order.astype(np.int32), "_kind": kind,
            "_groups": [np.ascontiguousarray(x[:, s : s + group].T).astype(kind).tobytes() for s in starts],
            "_mass": _masses(x, starts).tobytes(),
        }

    def lay_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = TaskContext.get().partitionId() << 40
        open_blocks: dict[int, tuple[list, list, list, list]] = {}
        for batch in batches:
            columns = [batch[c] for c in ("_id", "_nameless", "_ask", "_vector")]
            for row in zip(*columns):
                dim = len(row[-1])
                lists = open_blocks.setdefault(dim, ([], [], [], []))
                for values, value in zip(lists, row):
                    values.append(value)
                if len(lists[0]) >= max(1, min(BLOCK, BLOCK_BYTES // max(1, 8 * dim))):
                    yield pd.DataFrame([block(dim, first, *open_blocks.pop(dim))])
                    first += len(lists[0])
        for dim, lists in open_blocks.items():
            yield pd.DataFrame([block(dim, first, *lists)])
            first += len(lists[0])

    return rows.mapInPandas(lay_out, _LAYOUT)


def _matrix(row, group: int) -> np.ndarray:
    """A block's vectors in the order of their own dimensions."""
    n, order = len(row["_ids"]), np.asarray(row["_order"], int)
    out = np.zeros((n, row["_dim"]))
    for start, data in zip(range(0, row["_dim"], group), row["_groups"]):
        out[:, order[start : start + group]] = np.frombuffer(data, row["_kind"]).reshape(-1, n).T
    return out


def _queries(blocks: DataFrame, group: int) -> DataFrame:
    """``_dim, _row, _id, _nameless, _x`` of the vectors that ask."""

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                at = np.flatnonzero(np.asarray(row["_asks"], bool))
                if len(at):
                    x = _matrix(row, group)[at]
                    yield pd.DataFrame({
                        "_dim": row["_dim"], "_row": row["_first"] + at,
                        "_id": np.asarray(row["_ids"], np.int64)[at],
                        "_nameless": np.asarray(row["_nameless"], bool)[at],
                        "_x": [v.tobytes() for v in x],
                    })

    asking = blocks.where(F.exists("_asks", lambda a: a))
    return asking.mapInPandas(
        take, "_dim int, _row bigint, _id bigint, _nameless boolean, _x binary"
    )


def _exact_in_doubles(x: np.ndarray, y: np.ndarray) -> bool:
    if not x.size or not y.size:
        return True
    return float(np.abs(x).max()) * float(np.abs(y).max()) * x.shape[1] < SAFE


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


class _Best:
    """The ``k`` best candidates of each query so far, and the score that a newcomer must reach."""

    def __init__(self, queries: int, k: int, sure: np.ndarray):
        self.k, self.reach = k, sure.copy()
        self.q = np.zeros(0, np.int64)
        self.rows, self.ids, self.nameless = self.q.copy(), self.q.copy(), np.zeros(0, bool)
        self.scores = self.q.copy()

    def add(self, q, rows, ids, nameless, scores) -> None:
        q = np.concatenate([self.q, q])
        rows, ids = np.concatenate([self.rows, rows]), np.concatenate([self.ids, ids])
        nameless, scores = np.concatenate([self.nameless, nameless]), np.concatenate([self.scores, scores])
        order = np.lexsort((rows, ids, nameless, ~scores, q))
        q = q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q, "left")
        order, place, q = order[place < self.k], place[place < self.k], q[place < self.k]
        self.q, self.rows, self.ids = q, rows[order], ids[order]
        self.nameless, self.scores = nameless[order], scores[order]
        full = place == self.k - 1
        self.reach[q[full]] = np.maximum(self.reach[q[full]], self.scores[full].astype(np.float64))


def _search_block(row, queries: np.ndarray, query_rows: np.ndarray, best: _Best, group: int) -> None:
    """Add one block's candidates to ``best``, ``STEP`` queries at a time."""
    n, dim = len(row["_ids"]), row["_dim"]
    starts = list(range(0, dim, group))
    parts = [
        np.frombuffer(d, row["_kind"]).reshape(-1, n).astype(np.float64) for d in row["_groups"]
    ]
    mass = np.frombuffer(row["_mass"]).reshape(n, -1)
    own = row["_first"] + np.arange(n)
    x_all = queries[:, np.asarray(row["_order"], int)]
    q_mass = _masses(x_all, starts)
    exact = _exact_in_doubles(x_all, np.concatenate([np.zeros((0, n)), *parts]).T)
    found = []
    for at in range(0, len(x_all), STEP):
        x, left = x_all[at : at + STEP], q_mass[at : at + STEP]
        reach = best.reach[at : at + STEP]
        other = query_rows[at : at + STEP, None] != own
        if exact:
            i, j = np.nonzero(other & (_slack(np.outer(left[:, 0], mass[:, 0])) >= reach[:, None]))
            score = np.zeros(len(i))
            for k, start in enumerate(starts):
                part = x[:, start : start + group]
                if len(i) * 4 > len(x) * n:
                    score += (part @ parts[k])[i, j]
                else:
                    score += np.einsum("ij,ji->i", part[i], parts[k][:, j])
                stays = score + _slack(left[i, k + 1] * mass[j, k + 1]) >= reach[i]
                i, j, score = i[stays], j[stays], score[stays]
            score = score.astype(np.int64)
        else:
            i, j = np.nonzero(other)
            x, y = _integers(x), _integers(np.concatenate(parts).T)
            score = np.array([int((x[a] * y[b]).sum()) for a, b in zip(i, j)], object)
            if any(not -(2**63) <= s < 2**63 for s in score):
                raise OverflowError("a score is beyond 64 bits")
            score = score.astype(np.int64)
        found.append((i + at, j, score))
    q, j, score = (np.concatenate(c) for c in zip(*found))
    ids, nameless = np.asarray(row["_ids"], np.int64), np.asarray(row["_nameless"], bool)
    best.add(q, own[j], ids[j], nameless[j], score)


def _slack(bound: np.ndarray) -> np.ndarray:
    """A bound made safe against the rounding of masses."""
    return bound * (1 + 1e-9) + 1e-6


def _sure(x: np.ndarray, k: int) -> np.ndarray:
    """What the ``k``-th best of each query reaches among the other queries of its pass."""
    sure = np.full(len(x), -np.inf)
    if len(x) > k and _exact_in_doubles(x, x):
        for at in range(0, len(x), STEP):
            scores = x[at : at + STEP] @ x.T
            scores[np.arange(len(scores)), at + np.arange(len(scores))] = -np.inf
            sure[at : at + STEP] = np.partition(scores, -k, axis=1)[:, -k]
    return sure


def top_k(
    vectors: DataFrame,
    asks: Column,
    k: int = 10,
    ident: str = "vec_id",
    vector: str = "embedding",
    scale: float = 1024.0,
    group: int = GROUP,
) -> DataFrame:
    """``query_id, rank, <ident>, score``: the ``k`` highest scores of every row where ``asks`` holds.

    Scores are inner products of ``floor(scale * x)``, exact. All rows but the query's own are
    candidates, rows that repeat its id or vector included; fewer than ``k`` give all. Ties go to the
    smaller id, null ids come last; rows equal in score and id are taken in any order. Vectors that are
    null or hold null or non-finite components neither ask nor answer; vectors of different lengths are
    not compared; those of length 0 score 0 with one another. Where ``asks`` is null a row doesn't ask.
    No row asks in an empty table, and the result is empty. Other columns are ignored, whatever their
    names. A score beyond 64 bits fails the job.

    Queries are dealt into passes of about ``PASS``. Each pass sends its queries to all tasks and reads
    the blocks once, without a shuffle; what it returns is at most ``k`` rows per query and task.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.coalesce(F.col(ident).cast("bigint"), F.lit(0)).alias("_id"),
        F.col(ident).isNull().alias("_nameless"),
        F.col(vector).cast("array<double>").alias("_vector"),
        F.coalesce(asks, F.lit(False)).alias("_ask"), usable(F.col(vector)).alias("_usable"),
    ).where("_usable").drop("_usable")
    blocks = materialise(vertical(rows, scale, group), "vector-blocks")
    queries = materialise(_queries(blocks, group), "vector-queries")
    found = fresh_dir(spark, "vector-best")
    schema = "_query bigint, _query_id bigint, _row bigint, _id bigint, _score bigint"
    passes = 0
    for size in queries.groupBy("_dim").agg(F.count("*").alias("n")).orderBy("_dim").collect():
        dim, n = size["_dim"], size["n"]
        turns = -(-n // max(1, min(PASS, PASS_BYTES // max(1, 8 * dim))))
        for turn in range(turns):
            mine = queries.where(
                (F.col("_dim") == dim) & (F.pmod(F.xxhash64("_row"), F.lit(turns)) == turn)
            ).orderBy("_row").toPandas()
            if not len(mine):
                continue
            best = _pass(blocks.where(F.col("_dim") == dim), mine, k, group, schema)
            best.write.parquet(f"{found}/pass={passes}")
            passes += 1
    if not passes:
        best = spark.createDataFrame([], schema)
    else:
        best = spark.read.schema(schema).parquet(*[f"{found}/pass={p}" for p in range(passes)])
    order = Window.partitionBy("_query").orderBy(
        F.desc("_score"), F.asc_nulls_last("_id"), F.asc("_row")
    )
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("_query_id").alias("query_id"), "rank", F.col("_id").alias(ident),
        F.col("_score").alias("score"),
    )


def _pass(blocks: DataFrame, mine: pd.DataFrame, k: int, group: int, schema: str) -> DataFrame:
    x = np.stack([np.frombuffer(v) for v in mine["_x"]])
    query_rows = mine["_row"].to_numpy(np.int64)
    query_ids = pd.Series(mine["_id"], dtype="Int64").mask(mine["_nameless"]).array
    sure = _sure(x, k)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = _Best(len(x), k, sure)
        for batch in batches:
            for _, row in batch.iterrows():
                _search_block(row, x, query_rows, best, group)
        yield pd.DataFrame({
            "_query": query_rows[best.q], "_query_id": query_ids[best.q], "_row": best.rows,
            "_id": pd.Series(best.ids, dtype="Int64").mask(best.nameless), "_score": best.scores,
        })

    return blocks.drop("_asks").mapInPandas(search, schema)
