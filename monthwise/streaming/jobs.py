"""Streams to keyed tables.

Each job keeps its state in tables under one root in the shared folder, written per batch id.
A restart from the checkpoint repeats at most the last batch and writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from monthwise.config import WINDOW_MONTHS
from monthwise.functions.text import record_key
from monthwise.operators.features import sliding_windows
from monthwise.operators.forecast import Mode, Scaler, forecast_records, forecast_windows
from monthwise.operators.models import Scorer
from monthwise.operators.quality import REASON
from monthwise.sinks.batch_log import BATCH, BatchLog
from monthwise.sinks.bucket_store import BucketStore
from monthwise.sinks.jdbc import DatabaseTable
from monthwise.sinks.keyed_table import KeyedTable
from monthwise.sources.dropdir import MALFORMED, SOURCE_FILE, read_csv_files, refused_files


def run_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Start ``handle(batch, batch_id)`` on a stream: on a cadence, or once over all there is."""
    writer = (
        stream.writeStream.outputMode("append")
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


class MonthJob:
    """Closed months in; subclasses make something of the windows that they complete.

    ``months`` logs every closed month. ``tails`` holds the latest 16 months of every series, all the
    history the next windows can need, in hash buckets of the series. A batch reads and rewrites only the
    buckets of the series that closed a month, however many series there are and however long the stream
    has run.
    """

    def __init__(
        self, spark: SparkSession, root: str, series: Sequence[str] = (), buckets: int = 16
    ):
        self.series = list(series)
        self.checkpoint = f"{root}/checkpoint"
        self.months = BatchLog(spark, f"{root}/months", merge_every=16)
        self.tails = BucketStore(spark, f"{root}/tails", self.series, buckets)

    def emit(self, history: DataFrame, batch_id: int) -> None:
        """Use ``series..., month, sales, is_new``: the new months with those before them."""
        raise NotImplementedError

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        done = self.tails.version()
        if done is not None and batch_id <= done:
            return
        self.months.write(batch, batch_id)
        new = self.months.read(only=batch_id).drop(BATCH)
        touched = self.tails.touched(new)
        if not touched:
            return
        history = new.withColumn("is_new", F.lit(True))
        tail = self.tails.read(only=touched)
        if tail is not None:
            history = history.unionByName(tail.withColumn("is_new", F.lit(False)))
        own = Window.partitionBy(*self.series)
        # A bucket holds other series too, which have nothing to emit.
        grown = history.withColumn("grows", F.max("is_new").over(own)).filter("grows")
        self.emit(grown.drop("grows"), batch_id)

        latest = own.orderBy(F.col("month").desc())
        kept = self.tails.spread(history).withColumn("rank", F.row_number().over(latest))
        kept = kept.filter(F.col("rank") < WINDOW_MONTHS).drop("rank", "is_new")
        self.tails.replace(kept, batch_id, touched, spread=False)

    def start(self, closed: DataFrame, every: str | None = None) -> StreamingQuery:
        return run_batches(closed, self.handle, self.checkpoint, every)


class WindowJob(MonthJob):
    """Each completed 17-month window, once, to ``write(windows, batch_id)``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        write: Callable[[DataFrame, int], None],
        series: Sequence[str] = (),
        buckets: int = 16,
    ):
        super().__init__(spark, root, series, buckets)
        self.write = write

    def emit(self, history: DataFrame, batch_id: int) -> None:
        windows = sliding_windows(history, self.series, carry=["is_new"])
        self.write(windows.filter("is_new").drop("is_new"), batch_id)


class ForecastJob(MonthJob):
    """A keyed table of actual and forecast months in ``results``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        scorer: Scorer,
        mode: Mode,
        series: Sequence[str] = (),
        scaler: Scaler | None = None,
        buckets: int = 16,
        compact_every: int = 16,
    ):
        super().__init__(spark, root, series, buckets)
        self.scorer, self.mode, self.scaler = scorer, mode, scaler
        self.results = KeyedTable(
            spark, f"{root}/results", [*self.series, "date"], order=["window_end"],
            compact_every=compact_every, buckets=buckets,
        )

    def emit(self, history: DataFrame, batch_id: int) -> None:
        windows = forecast_windows(
            history, self.scorer, self.mode, self.series, self.scaler, carry=["is_new"]
        )
        self.results.upsert(forecast_records(windows.filter("is_new"), self.series), batch_id)


class PersistJob:
    """Checked raw records in, keyed table and dead letters out.

    ``columns`` are the record's own fields. The key is the hash of them, so a record that is
    delivered twice, even in two files, is one row. Good and bad records are parsed and written
    in the same single pass.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        columns: Sequence[str],
        key: str = "postgres_pk",
        compact_every: int | None = None,
        buckets: int = 16,
    ):
        self.columns, self.key = list(columns), key
        self.checkpoint = f"{root}/checkpoint"
        self.table = KeyedTable(
            spark, f"{root}/table", [key], compact_every=compact_every, buckets=buckets
        )

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        self.table.upsert(batch.withColumn(self.key, record_key(batch, self.columns)), batch_id)

    def records(self) -> DataFrame | None:
        """Current records; None before the first batch."""
        rows = self.table.read()
        return None if rows is None else rows.select(self.key, *self.columns)

    def rejected(self) -> DataFrame | None:
        return self.table.rejected()

    def start(self, checked: DataFrame, every: str | None = None) -> StreamingQuery:
        if REASON not in checked.columns:
            raise ValueError("records must have gone through type_records or parse_messages")
        return run_batches(checked, self.handle, self.checkpoint, every)


class CsvJob:
    """New CSV files in; each batch's rows, matched by column name, to ``use(rows, batch_id)``.

    The headers of a batch's files are read by tasks, and columns go by the names there, whatever their order and
    number: see :func:`monthwise.sources.dropdir.read_csv_files` for ``schema``, ``key`` and the options. A file that can't be
    read, or breaks off, goes to ``quarantine`` with the reason and doesn't hold up the others. ``use`` may see
    a batch again and has to write it by its id.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        use: Callable[[DataFrame, int], None],
        schema: StructType | None = None,
        key: str | None = None,
        **options: str,
    ):
        self.spark, self.use, self.schema, self.key, self.options = spark, use, schema, key, options
        self.checkpoint = f"{root}/checkpoint"
        self.quarantine = BatchLog(spark, f"{root}/quarantine", merge_every=16)

    def handle(self, files: DataFrame, batch_id: int) -> None:
        """``files``: the paths of one batch, as many as the stream was told to take at most."""
        paths = [row["path"] for row in files.collect()]
        try:
            refused = self._read(paths, batch_id)
        except Exception:
            # Some file breaks off: find out which.
            broken = self._broken(paths)
            if not broken:
                raise
            refused = self._read([p for p in paths if p not in broken], batch_id) | broken
        if refused:
            self.quarantine.write(refused_files(self.spark, refused), batch_id)

    def _read(self, paths: list[str], batch_id: int) -> dict[str, str]:
        rows, refused = read_csv_files(self.spark, paths, self.schema, key=self.key, **self.options)
        if rows is not None:
            self.use(rows, batch_id)
        return refused

    def _broken(self, paths: list[str]) -> dict[str, str]:
        """The files that can't be read to their end, found by halves: a few bad ones cost a few reads."""
        try:
            self.spark.read.text(paths).write.format("noop").mode("overwrite").save()
        except Exception as problem:
            if len(paths) > 1:
                half = len(paths) // 2
                return self._broken(paths[:half]) | self._broken(paths[half:])
            return {paths[0]: "unreadable file: " + str(problem).strip().splitlines()[0][:200]}
        return {}

    def start(self, files: DataFrame, every: str | None = None) -> StreamingQuery:
        return run_batches(files, self.handle, self.checkpoint, every)


class CsvPersistJob(CsvJob):
    """New CSV files in, keyed raw table out, with lists of refused lines and files; ``table`` may be one of
    a database.

    A record is kept as it was written; only a line that doesn't fit the header of its file is a dead
    letter. Its key is the hash of the columns of its file in the order of their names, so it depends
    neither on their order nor on files read beside it.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: str = "postgres_pk",
        compact_every: int | None = None,
        buckets: int = 16,
        table: KeyedTable | DatabaseTable | None = None,
        **options: str,
    ):
        super().__init__(spark, root, self.persist, key=key, **options)
        self.table = table or KeyedTable(
            spark, f"{root}/table", [key], compact_every=compact_every, buckets=buckets
        )

    def persist(self, rows: DataFrame, batch_id: int) -> None:
        reason = F.when(F.col(MALFORMED).isNotNull(), "malformed line")
        self.table.upsert(rows.withColumn(REASON, reason), batch_id)

    def records(self) -> DataFrame | None:
        """Current records; None before the first batch."""
        rows = self.table.read()
        return None if rows is None else rows.drop(MALFORMED, SOURCE_FILE)

    def rejected(self) -> DataFrame | None:
        return self.table.rejected()
