"""A table with one row per key, upserted batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.operators.latest import latest_per_key
from monthwise.operators.quality import REASON, dead_letters, good_records
from monthwise.sinks.batch_log import BATCH, BatchLog
from monthwise.sinks.bucket_store import BucketStore

COLUMNS_SET = "columns_set"


class KeyedTable:
    """Upserts are appended per batch and resolved when read: the greatest batch id wins, then
    the greatest ``order`` within a batch.

    An upsert is one pass over its batch without a shuffle, however large the table is, and
    replaying a batch id changes nothing. :meth:`compact` folds the batches so far into a base of hash
    buckets, of which it reads and rewrites only those that the batches touch; with ``compact_every`` an
    upsert does so once that many batches have come together, with 1 at once, so that a read is one pass over
    the base. The batches that the base before had folded are then removed, so the number of
    directories is bounded and a reader of the last base loses nothing. Dead letters move to
    ``rejected`` when folded. The first upsert creates the table, new columns widen it.

    Rows that carry a ``reason``, and rows without a key, are kept as dead letters.

    With ``merge_columns`` an upsert only sets the columns it brings and leaves the others of
    the row as they were, as a database upsert does; otherwise it replaces the row.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        order: Sequence[str] = (),
        merge_columns: bool = False,
        compact_every: int | None = None,
        buckets: int = 16,
    ):
        self.keys, self.rank = list(keys), [BATCH, *order]
        self.merge_columns = merge_columns
        self.changes = BatchLog(spark, f"{root}/changes")
        self.base = BucketStore(spark, f"{root}/base", keys, buckets)
        self.refused = BatchLog(spark, f"{root}/rejected", merge_every=16)
        self.compact_every = compact_every

    def upsert(self, df: DataFrame, batch_id: int) -> None:
        """Write one batch; its keys need not be unique if ``order`` tells them apart.

        A batch that a base holds already is not written again.
        """
        folded = self.base.version()
        if folded is not None and batch_id <= folded:
            return
        reasons = [F.when(F.col(k).isNull(), f"no {k}") for k in self.keys]
        if REASON in df.columns:
            reasons.insert(0, F.col(REASON))
        columns = [c for c in df.columns if c != REASON]
        df = df.withColumn(REASON, F.coalesce(*reasons).cast("string"))
        self.changes.write(self._with_columns_set(df, columns), batch_id)
        if self.compact_every:
            if len(self._open()) >= self.compact_every:
                self.compact()

    def _open(self) -> list[int]:
        """Complete batches that no base holds yet."""
        folded = self.base.version()
        return [i for i in self.changes.committed() if folded is None or i > folded]

    def read(self) -> DataFrame | None:
        """Current rows; None before the first upsert."""
        resolved = self._resolved()
        return None if resolved is None else resolved.drop(BATCH, COLUMNS_SET)

    def rejected(self) -> DataFrame | None:
        """Dead letters with reason and batch id."""
        folded = self.base.version()
        old = None if folded is None else self.refused.read(below=folded + 1)
        changes = self.changes.read(above=folded)
        new = None if changes is None else dead_letters(changes).drop(COLUMNS_SET)
        if old is None or new is None:
            return new if old is None else _own_batch(old)
        return _own_batch(old).unionByName(new, allowMissingColumns=True)

    def compact(self) -> None:
        """Fold all complete batches into the base. Readers use it once it is complete."""
        ids = self._open()
        if not ids:
            return
        changes = self.changes.read(above=self.base.version())
        # Every fold adds its own dead letters; each row tells its batch, the directory the fold.
        letters = dead_letters(changes).drop(COLUMNS_SET).withColumnRenamed(BATCH, "folded")
        if not letters.isEmpty():
            self.refused.write(letters, ids[-1])
        changes = good_records(changes)
        touched = self.base.touched(changes)
        old = self.base.read(only=touched)
        # Each batch key is one row before rows meet the base's, so no key crowds a task.
        rows = changes if self.merge_columns else self._newest(changes)
        if old is not None:
            rows = rows.unionByName(self._as_change(old), allowMissingColumns=True)
        rows = self._newest(self.base.spread(rows)).drop(BATCH, COLUMNS_SET)
        self.base.replace(rows, ids[-1], touched, spread=False)
        versions = self.base.committed()
        for folded in self.changes.committed():
            if len(versions) > 1 and folded <= versions[-2]:
                self.changes.drop(folded)

    def _as_change(self, base: DataFrame) -> DataFrame:
        """Rows of the base as those of a batch before all others."""
        base = self._with_columns_set(base, base.columns)
        return base.withColumn(BATCH, F.lit(-1).cast("bigint"))

    def _with_columns_set(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        if not self.merge_columns:
            return df
        return df.withColumn(COLUMNS_SET, F.array(*[F.lit(c) for c in columns]))

    def _resolved(self) -> DataFrame | None:
        """The base without the keys that changed since, and those keys' current rows.

        The join only carries keys. While few have changed since the last compaction, the
        optimiser broadcasts them and the base is neither shuffled nor sorted.
        """
        changes = self.changes.read(above=self.base.version())
        base = self.base.read()
        if base is None:
            return None if changes is None else self._newest(good_records(changes))
        if changes is None:
            return base
        changes = good_records(changes)
        touched = changes.select(*self.keys).distinct()
        if self.merge_columns:
            before = self._as_change(base.join(touched, self.keys, "left_semi"))
            changes = changes.unionByName(before, allowMissingColumns=True)
        untouched = base.join(touched, self.keys, "left_anti")
        newest = self._newest(changes).drop(BATCH, COLUMNS_SET)
        return untouched.unionByName(newest, allowMissingColumns=True)

    def _newest(self, rows: DataFrame) -> DataFrame:
        if self.merge_columns:
            return self._latest_columns(rows)
        return latest_per_key(rows, self.keys, self.rank)

    def _latest_columns(self, rows: DataFrame) -> DataFrame:
        names = [c for c in rows.columns if c not in (*self.keys, BATCH, COLUMNS_SET)]
        # A boxed value keeps a null that was written apart from a column that was not.
        latest = [
            F.max_by(
                F.struct(F.col(c).alias("v")),
                F.when(F.array_contains(COLUMNS_SET, c), F.struct(*self.rank)),
            ).alias(c)
            for c in names
        ]
        return rows.groupBy(*self.keys).agg(*latest).select(
            *self.keys, *[F.col(c)["v"].alias(c) for c in names]
        )


def _own_batch(letters: DataFrame) -> DataFrame:
    return letters.drop(BATCH).withColumnRenamed("folded", BATCH)
