"""An append table on plain parquet with one directory per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch_id"


class BatchLog:
    """Rows written under the id of the batch that produced them.

    A complete batch is never written again, so a replay changes nothing and readers never see its
    rows vanish. A batch counts once its directory has Spark's ``_SUCCESS`` marker, so a batch cut
    short by a lost driver is unseen and written anew.

    With ``merge_every`` that many batches are merged into one run, that many runs of a level into
    one of the next: the number of directories grows with the logarithm of the batches and a row is
    rewritten once a level. Ids must then ascend. What a run replaces is hidden at once and removed by
    the merge after, so that readers of the moment can finish.
    """

    def __init__(self, spark: SparkSession, root: str, merge_every: int | None = None):
        if merge_every is not None and merge_every < 2:
            raise ValueError("merge_every must be at least 2")
        self.spark, self.root, self.merge_every = spark, root.rstrip("/"), merge_every

    def path(self, batch_id: int) -> str:
        return f"{self.root}/{BATCH}={batch_id}"

    def write(self, df: DataFrame, batch_id: int, sort: Sequence[str] = ()) -> None:
        if self.has(batch_id):
            return
        if self.merge_every:
            self._merge()
        if sort:
            df = df.sortWithinPartitions(*sort)
        df.write.mode("overwrite").parquet(self.path(batch_id))

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _marked(self, pattern: str) -> list[str]:
        """Names of the directories that fit ``pattern`` and are complete."""
        found, files = self._files(f"{self.root}/{pattern}/_SUCCESS")
        return [s.getPath().getParent().getName() for s in files.globStatus(found) or []]

    def _runs(self) -> list[tuple[int, int, int]]:
        """``first, last, level`` of all complete runs, also of those that others hide."""
        names = [name.split("-") for name in self._marked("merged-*")]
        return sorted((int(first), int(last), int(level)) for _, level, first, last in names)

    def _run_path(self, run: tuple[int, int, int]) -> str:
        return f"{self.root}/merged-{run[2]}-{run[0]}-{run[1]}"

    def _sources(self) -> tuple[list[tuple[int, int, int]], list[int]]:
        """The runs and single batches that hold the rows."""
        runs = self._runs()
        inside = lambda a, b: b[0] <= a[0] and a[1] <= b[1] and b[2] > a[2]
        runs = [r for r in runs if not any(inside(r, other) for other in runs)]
        ids = sorted(int(name.split("=", 1)[1]) for name in self._marked(f"{BATCH}=*"))
        return runs, [i for i in ids if not any(first <= i <= last for first, last, _ in runs)]

    def has(self, batch_id: int) -> bool:
        """Whether a batch is complete."""
        marker, files = self._files(f"{self.path(batch_id)}/_SUCCESS")
        return files.exists(marker) or any(
            first <= batch_id <= last for first, last, _ in self._runs()
        )

    def drop(self, batch_id: int) -> None:
        """Remove a batch that nothing reads any more."""
        self._delete(self.path(batch_id))

    def _delete(self, path: str) -> None:
        where, files = self._files(path)
        files.delete(where, True)

    def committed(self) -> list[int]:
        """Ids of complete batches that are not merged, in order, from a listing of marker files."""
        return self._sources()[1]

    def read(
        self, above: int | None = None, below: int | None = None, only: int | None = None
    ) -> DataFrame | None:
        """The chosen batches with their ``batch_id``; None if there are none yet.

        Columns that only some batches have are null in the others.
        """
        low = only if only is not None else None if above is None else above + 1
        high = only if only is not None else None if below is None else below - 1

        def chosen(first: int, last: int) -> bool:
            return (low is None or last >= low) and (high is None or first <= high)

        runs, ids = self._sources()
        return self._rows([r for r in runs if chosen(r[0], r[1])],
                          [i for i in ids if chosen(i, i)], low, high)

    def _rows(self, runs, ids, low: int | None = None, high: int | None = None) -> DataFrame | None:
        rows = None
        if ids:
            reader = self.spark.read.options(basePath=self.root, mergeSchema=len(ids) > 1)
            rows = reader.parquet(*[self.path(i) for i in ids])
            rows = rows.withColumn(BATCH, rows[BATCH].cast("bigint"))
        if runs:
            reader = self.spark.read.option("mergeSchema", len(runs) > 1)
            merged = reader.parquet(*[self._run_path(r) for r in runs])
            if low is not None:
                merged = merged.where(F.col(BATCH) >= low)
            if high is not None:
                merged = merged.where(F.col(BATCH) <= high)
            rows = merged if rows is None else rows.unionByName(merged, allowMissingColumns=True)
        return rows

    def _merge(self) -> None:
        runs, ids = self._sources()
        if len(ids) < self.merge_every:
            return
        self._remove_hidden(runs)
        self._write_run([], ids, 1)
        level = 1
        while True:
            same = [r for r in self._sources()[0] if r[2] == level]
            if len(same) < self.merge_every:
                return
            level += 1
            self._write_run(same, [], level)

    def _write_run(self, runs: list[tuple[int, int, int]], ids: list[int], level: int) -> None:
        first, last = min([r[0] for r in runs] + ids), max([r[1] for r in runs] + ids)
        rows = self._rows(runs, ids)
        rows.write.mode("overwrite").parquet(self._run_path((first, last, level)))

    def _remove_hidden(self, runs: list[tuple[int, int, int]]) -> None:
        for name in self._marked(f"{BATCH}=*"):
            batch_id = int(name.split("=", 1)[1])
            if any(first <= batch_id <= last for first, last, _ in runs):
                self.drop(batch_id)
        for run in self._runs():
            if run not in runs:
                self._delete(self._run_path(run))
